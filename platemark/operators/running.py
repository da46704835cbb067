"""Running values along an order within a key, also where one key holds a large part of all rows.

A window would bring a key's rows into one task. Where some key is that hot
(counted), rows are cut into chunks by key and place instead, values run within
each chunk, and what the chunks before have come to is added: one small row for
each chunk of a key that has several.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from platemark.operators import sizing
from platemark.session import cut, tasks


@dataclass(frozen=True)
class Running:
    """Columns to add: ``number`` counts rows from 1, ``sums`` adds up to the row, ``last`` keeps the last value that
    isn't null up to the row, ``before`` is the value of the row before."""

    number: str | None = None
    sums: dict[str, Column] = field(default_factory=dict)
    last: dict[str, Column] = field(default_factory=dict)
    before: dict[str, Column] = field(default_factory=dict)


def running(df: DataFrame, keys: list[str], place: list[str], what: Running) -> DataFrame:
    """``df`` with the columns of ``what``, along the columns ``place`` (a total order, ascending) within ``keys``. Null keys are a key."""
    if df.count() <= sizing.HOT_ROWS or (df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) <= sizing.HOT_ROWS:
        return _within(df, keys, place, what)
    chunk, nth, p = sizing.unused(df, "chunk"), sizing.unused(df, "nth_of_chunk"), "c_"
    while any(c.lower().startswith(p) for c in df.columns):
        p = f"_{p}"
    chunked = cut(df.repartitionByRange(tasks(df.sparkSession), *keys, *place).withColumn(chunk, F.spark_partition_id()))
    local = _within(chunked, [*keys, chunk], place, what, nth)
    carried = _carried(chunked, keys, chunk, place, what, p)
    same = F.col(chunk) == F.col(f"{p}chunk")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"{p}k{i}"))
    out = local.join(F.broadcast(carried), same, "left")
    number = {what.number: F.col(what.number) + F.coalesce(f"{p}number", F.lit(0))} if what.number else {}
    sums = {n: F.coalesce(F.col(n) + F.col(f"{p}v_{n}"), F.col(n), F.col(f"{p}v_{n}")) for n in what.sums}
    later = {n: F.coalesce(F.col(n), F.col(f"{p}v_{n}")) for n in what.last}
    before = {n: F.when(F.col(nth) == 1, F.col(f"{p}v_{n}")).otherwise(F.col(n)) for n in what.before}
    return out.withColumns(number | sums | later | before).drop(chunk, nth, *carried.columns)


def _within(df: DataFrame, keys: list[str], place: list[str], what: Running, nth: str | None = None) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*place)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    columns = {n: F.sum(c).over(upto) for n, c in what.sums.items()} | {n: F.last(c, ignorenulls=True).over(upto) for n, c in what.last.items()} | {n: F.lag(c).over(w) for n, c in what.before.items()}
    if what.number:
        columns[what.number] = F.row_number().over(w).cast("long")
    if nth:
        columns[nth] = F.row_number().over(w)
    return df.select("*", *[c.alias(n) for n, c in columns.items()])


def _carried(chunked: DataFrame, keys: list[str], chunk: str, place: list[str], what: Running, p: str) -> DataFrame:
    """What the chunks before each chunk come to; only of keys in several chunks, which are two for each chunk at most."""
    order = F.struct(*place)
    parts = [F.count(F.lit(1)).alias(f"{p}number")]
    parts += [F.sum(c).alias(f"{p}v_{n}") for n, c in what.sums.items()]
    parts += [F.max_by(c, F.when(c.isNotNull(), order)).alias(f"{p}v_{n}") for n, c in what.last.items()]
    # A null of the row before is a value: it is wrapped, so it isn't passed over.
    parts += [F.max_by(F.struct(c.alias("v")), order).alias(f"{p}v_{n}") for n, c in what.before.items()]
    named = [F.col(k).alias(f"{p}k{i}") for i, k in enumerate(keys)]
    by = [f"{p}k{i}" for i in range(len(keys))]
    of_chunk = chunked.groupBy(*named, F.col(chunk).alias(f"{p}chunk")).agg(*parts)
    of_chunk = of_chunk.withColumn(f"{p}chunks", F.count(F.lit(1)).over(W.partitionBy(*by))).filter(F.col(f"{p}chunks") > 1)
    along = W.partitionBy(*by).orderBy(f"{p}chunk")
    ahead = along.rowsBetween(W.unboundedPreceding, -1)
    columns = [F.sum(f"{p}number").over(ahead).alias(f"{p}number")]
    columns += [F.sum(f"{p}v_{n}").over(ahead).alias(f"{p}v_{n}") for n in what.sums]
    columns += [F.last(f"{p}v_{n}", ignorenulls=True).over(ahead).alias(f"{p}v_{n}") for n in what.last]
    columns += [F.lag(f"{p}v_{n}").over(along)["v"].alias(f"{p}v_{n}") for n in what.before]
    return of_chunk.select(*by, f"{p}chunk", *columns)
