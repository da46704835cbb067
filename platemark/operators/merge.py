"""Merging of sources, upserts, plans of synchronisation, snapshots and their hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable_code(code: Column) -> Column:
    """Not blank and no UNKNOWN code."""
    c = F.upper(F.trim(code))
    return F.coalesce((c != "") & ~c.startswith("UNKNOWN"), F.lit(False))


def filled(value: Column) -> Column:
    return F.coalesce(F.trim(value) != "", F.lit(False))


def priority_merge(df: DataFrame, key: str, order: list[Column], code: str, description: str, others: list[str]) -> DataFrame:
    """One row per key, folded over its rows in ``order`` (a total order).

    Rows with neither a usable code nor a description don't contribute. The
    code is the first usable one, the description the first that isn't blank
    ('' if none), the other columns those of the last contributing row. All of
    it are mergeable aggregates, combined before the shuffle.
    """
    has_code, has_text = usable_code(F.col(code)), filled(F.col(description))
    place = F.struct(*order)
    return (
        df.filter(has_code | has_text)
        .groupBy(key)
        .agg(
            F.coalesce(F.min_by(F.trim(code), F.when(has_code, place)), F.lit("")).alias(code),
            F.coalesce(F.min_by(F.trim(description), F.when(has_text, place)), F.lit("")).alias(description),
            F.max_by(F.struct(*others), place).alias("last"),
        )
        .select(key, code, description, "last.*")
    )


def upsert(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; in rows of both a new value wins wherever it isn't null. Both are unique in ``key``."""
    columns = [c for c in base.columns if c != key]
    b, n = base.alias("b"), new.alias("n")
    joined = b.join(n, F.col(f"b.{key}") == F.col(f"n.{key}"), "full_outer")
    return joined.select(*[F.coalesce(F.col(f"n.{c}"), F.col(f"b.{c}")).alias(c) for c in [key, *columns]]).select(*base.columns)


def replace_partition(base: DataFrame, new: DataFrame, partition: str) -> DataFrame:
    """The base without the partitions that ``new`` has, and ``new``."""
    return base.join(new.select(partition).distinct(), partition, "left_anti").unionByName(new.select(*base.columns))


def sync_plan(present: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """(key, action): remove what is present and not to be kept, copy what is to be kept and not present."""
    p, k = present.select(key).filter(F.col(key).isNotNull()).distinct(), keep.select(key).filter(F.col(key).isNotNull()).distinct()
    return p.join(k, key, "left_anti").withColumn("action", F.lit("remove")).unionByName(k.join(p, key, "left_anti").withColumn("action", F.lit("copy")))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(key, change) of keys whose value differs between two snapshots: added, removed or changed."""
    a, b = before.select(key, F.col(value).alias("old"), F.lit(True).alias("was")), after.select(key, F.col(value).alias("new"), F.lit(True).alias("is"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return a.join(b, key, "full_outer").select(key, change.alias("change")).filter(F.col("change").isNotNull())


def canonical_hash(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(by, n_rows, digest): a hash of each group's rows as a multiset, whatever their order.

    A row's text gives each value with its length, and null by another letter,
    so different rows have different texts. The digest is the sums of four
    parts, 60 bits each, of the rows' SHA-256, exact and mergeable, so no
    group is gathered to be sorted.
    """
    value = lambda c: F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("s"), F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")))
    hashed = df.select(*by, F.sha2(F.concat(*[value(c) for c in columns]), 256).alias("h"))
    parts = hashed.select(*by, *[F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("long").alias(f"h{i}") for i in range(4)])
    sums = [F.sum(F.col(f"h{i}").cast("decimal(38,0)")).cast("string") for i in range(4)]
    return parts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", *sums).alias("digest"))


def sorted_union(a: Column, b: Column) -> Column:
    """Distinct elements of two arrays, in order; null arrays are empty."""
    none = F.expr("cast(array() as array<string>)")
    return F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))


def get_one(df: DataFrame, key: str, value: object) -> DataFrame:
    """The row of one key, as a table; raises if there is none."""
    found = df.filter(F.col(key) == F.lit(value)).limit(1)
    if found.isEmpty():
        raise KeyError(f"no {key} {value!r}")
    return found
