"""Joins that check sizes: broadcasts of proven size, and lookups that hot keys can't stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platemark.session import written

#: A looked-up table of at most so many rows is broadcast.
SMALL = 50_000
#: Hashes of repeated keys that are broadcast at most; each takes 67 bytes (measured), so all of them 34 MB.
REPEATED = 500_000
#: A key is hot from so many rows, or a thousandth of all rows, whichever is more; it is then spread over SALTS tasks.
HOT_ROWS, SALTS = 200_000, 32


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_or_shuffled(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """``broadcast(df)`` if it really has at most ``max_rows`` rows, else ``df`` as it is.

    The count stops at ``max_rows + 1`` rows, so a large table costs little.
    Beyond the bound the join is left to the planner, which shuffles it.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lookup(child: DataFrame, parent: DataFrame, on: list[str], spread_by: str, parent_rows: int | None = None, how: str = "left") -> DataFrame:
    """``child`` left join ``parent``, which is unique in ``on``; ``how`` may also be left_anti.

    A small parent (counted, not assumed; ``parent_rows`` is a bound the caller
    knows already) is broadcast, so a hot key moves nothing. Beyond that bound
    keys that hold more than a thousandth of the child's rows (a thousand keys
    at most) are salted on both sides, by a hash of the column ``spread_by``,
    so no task gets a hot key whole. Children of no more rows than a hot key
    needs are joined without looking for one.
    """
    if (parent.limit(SMALL + 1).count() if parent_rows is None else parent_rows) <= SMALL:
        return child.join(F.broadcast(parent), on, how)
    total = child.count()
    if total <= HOT_ROWS:
        return child.join(parent, on, how)
    limit = max(HOT_ROWS, total // 1000)
    hot = written(child.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > limit).select(*on, F.lit(SALTS).alias("salts")), "hot")
    if hot.isEmpty():
        return child.join(parent, on, how)
    salts = F.coalesce("salts", F.lit(1))
    salted = child.join(F.broadcast(hot), on, "left").withColumn("salt", F.pmod(F.xxhash64(spread_by), salts).cast("int")).drop("salts")
    copies = parent.join(F.broadcast(hot), on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts.cast("int") - 1))).drop("salts")
    return salted.join(copies, [*on, "salt"], how).drop("salt")


def without_repeats(df: DataFrame, key: str) -> tuple[DataFrame | None, DataFrame]:
    """``df`` in two parts: rows whose ``key`` occurs once, and the rest, which holds all rows of every repeated key.

    Only hashes of the keys are shuffled. Keys that share their hash with
    another count as repeated, which the caller's exact treatment of the rest
    makes harmless. The hashes that repeat are written to the shared folder
    and, if they are few (counted), broadcast; else the first part is None and
    all rows are the rest.
    """
    mark, code = unused(df, "repeated"), unused(df, "hash")
    hashes = df.select(F.xxhash64(key).alias(code)).groupBy(code).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(code)
    repeated = written(hashes, "repeated")
    if repeated.count() > REPEATED:
        return None, df
    marked = df.withColumn(code, F.xxhash64(key)).join(F.broadcast(repeated.withColumn(mark, F.lit(True))), code, "left")
    return marked.filter(F.col(mark).isNull()).drop(mark, code), marked.filter(F.col(mark)).drop(mark, code)
