"""Order-dependent operators: ordinals, segments, ids, folds of events, pages of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from platemark.operators.running import Running, running
from platemark.session import cut, tasks


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """Numbers all rows from 1 in ``order`` (a total order) without bringing them together.

    Rows are range-partitioned and sorted; a row's number is its place in the
    partition plus the rows of the partitions before, which is one small row
    per partition.
    """
    placed = cut(df.repartitionByRange(tasks(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = sizes.withColumn("_ahead", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return placed.withColumn("_part", part).join(F.broadcast(ahead), "_part").withColumn(name, place + F.col("_ahead") + 1).drop("_id", "_part", "_ahead")


def segments(df: DataFrame, keys: list[str], place: str, hit: Column, least: int) -> DataFrame:
    """(keys, first, last, length): runs of consecutive places that hit, of ``least`` or more, ends included.

    A place occurs once per key; missing places end a run. One pass: a run's
    rows share the difference of place and rank.
    """
    hits = df.filter(hit).select(*keys, place)
    run = F.col(place) - F.row_number().over(W.partitionBy(*keys).orderBy(place))
    out = hits.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("length"))
    return out.filter(F.col("length") >= least).drop("_run")


def content_extent(df: DataFrame, keys: list[str], place: str, hit: Column, size: int, head: float, foot: float) -> DataFrame:
    """(keys, top, bottom): the places that hit, with margins of the axis before and after, clipped; the whole axis if none hits."""
    low, high = F.min(F.when(hit, F.col(place))), F.max(F.when(hit, F.col(place)))
    out = df.groupBy(*keys).agg(low.alias("lo"), high.alias("hi"))
    top = F.coalesce(F.greatest(F.lit(0), F.col("lo") - int(size * head)), F.lit(0))
    bottom = F.coalesce(F.least(F.lit(size), F.col("hi") + int(size * foot)), F.lit(size))
    return out.select(*keys, top.alias("top"), bottom.alias("bottom"))


def allocate_ids(df: DataFrame, order: list[Column], prefix: str, base: int) -> DataFrame:
    """Adds ``allocated``: PREFIX-%06d, counting on from ``base`` in ``order``."""
    return with_ordinal(df, order).withColumn("allocated", F.format_string(f"{prefix}-%06d", F.col("ordinal") + base)).drop("ordinal")


def last_states(events: DataFrame, key: str, place: list[Column], effects: dict[str, dict[str, str]], event: str) -> DataFrame:
    """State of each entity after all its events, with the number of its versions.

    ``effects`` maps an event to the fields it sets; a field keeps what the
    last event that sets it gave it. Unknown events raise. A fold of
    last-non-null maxima, combined before the shuffle.
    """
    fields = sorted({f for e in effects.values() for f in e})
    order = F.struct(*place)
    known = F.col(event).isin(list(effects))
    checked = events.withColumn("_e", F.when(known, F.col(event)).otherwise(F.raise_error(F.concat(F.lit("unknown event "), F.coalesce(F.col(event), F.lit("null"))))))
    sets = {f: F.coalesce(*[F.when(F.col("_e") == e, v[f]) for e, v in effects.items() if f in v]) for f in fields}
    return checked.groupBy(key).agg(
        *[F.max_by(c, F.when(c.isNotNull(), order)).alias(f) for f, c in sets.items()], F.count(F.lit(1)).alias("current_version"),
    )


def versions(events: DataFrame, key: str, place: list[str], effects: dict[str, dict[str, str]], event: str) -> DataFrame:
    """Every event as a version: version_no from 1, and the fields as they stand after it. A hot key is cut into chunks."""
    fields = sorted({f for e in effects.values() for f in e})
    sets = {f: F.coalesce(*[F.when(F.col(event) == e, v[f]) for e, v in effects.items() if f in v]) for f in fields}
    return running(events, [key], place, Running(number="version_no", last=sets))


def page_of(df: DataFrame, order: list[Column], offset: int, size: int) -> DataFrame:
    """One page of an ordered result."""
    return df.orderBy(*order).offset(offset).limit(size)
