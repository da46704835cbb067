"""Integrity rules as findings: (rule, entity, key). A table is valid if it has none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platemark.operators.running import Running, running
from platemark.operators.sizing import HOT_ROWS, lookup
from platemark.session import written


@dataclass(frozen=True)
class Rule:
    """``condition`` is SQL that is true where the rule is broken; MATCHES(a, 'pattern') is rendered for the engine."""

    rule: str
    table: str
    key: str
    condition: str

    def sql(self, matches: str) -> str:
        return self.condition.replace("MATCHES(", f"{matches}(")


def broken(df: DataFrame, r: Rule) -> DataFrame:
    return df.filter(F.expr(r.sql("regexp_like"))).select(F.lit(r.rule).alias("rule"), F.lit(r.table).alias("entity"), F.col(r.key).cast("string").alias("key"))


def _against_repeated(df: DataFrame, rows: DataFrame, repeated: DataFrame, columns: list[str], spread_by: str) -> DataFrame:
    """``rows`` of ``df`` beside their repeated key; of a table in which no key can be hot without a look at sizes."""
    if df.count() <= HOT_ROWS:
        return rows.join(repeated, columns)
    return lookup(rows, written(repeated, "repeated"), columns, spread_by=spread_by)


def extra_occurrences(df: DataFrame, rule: str, table: str, key: str, columns: list[str], row: str) -> DataFrame:
    """A finding for every row but the first (by ``row``) of rows equal in ``columns``, none of them null.

    Counts and first rows come from one aggregation, written once where the
    table is large; rows are then held against the repeated keys only, safe against a hot key.
    """
    rows = df.dropna(subset=columns).select(F.col(key).cast("string").alias("key"), F.col(row).alias("row"), *columns)
    repeated = rows.groupBy(*columns).agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    held = _against_repeated(df, rows, repeated, columns, "row")
    return held.filter("row > first_row").select(F.lit(rule).alias("rule"), F.lit(table).alias("entity"), "key")


def repeated_occurrences(df: DataFrame, rule: str, table: str, key: str, columns: list[str], row: str) -> DataFrame:
    """Count - 1 findings for rows equal in ``columns``, none of them null, whatever ``row`` is: equal, null or unique.

    The first by ``row``, then ``key``, is let off. Rows equal in all of these
    are counted before the shuffle, so a hot key is one row for each place.
    """
    rows = df.dropna(subset=columns).select(F.struct(F.col(row).alias("row"), F.col(key).cast("string").alias("key")).alias("at"), *columns)
    counted = rows.groupBy("at", *columns).agg(F.count(F.lit(1)).alias("n"))
    repeated = counted.groupBy(*columns).agg(F.min("at").alias("first_at"), F.sum("n").alias("rows")).filter("rows > 1").drop("rows")
    held = _against_repeated(df, counted, repeated, columns, "at").filter("first_at IS NOT NULL")
    extra = held.withColumn("extra", F.col("n") - F.when(F.col("at") == F.col("first_at"), 1).otherwise(0)).filter("extra > 0")
    return extra.select(F.lit(rule).alias("rule"), F.lit(table).alias("entity"), F.col("at.key").alias("key"), F.explode(F.sequence(F.lit(1), F.col("extra").cast("int")))).drop("col")


def missing_fields(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field) for every one of ``columns`` that is null or ''."""
    absent = F.filter(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), c) for c in columns]), lambda c: c.isNotNull())
    return df.select(F.col(key).alias("key"), F.explode(absent).alias("field"))


def unordered(df: DataFrame, ordinal: str, keys: list[str], partition: str) -> DataFrame:
    """Rows (by ``ordinal``, within ``partition``) whose keys are smaller than those of the row before. A hot partition is cut into chunks."""
    rows = running(df, [partition], [ordinal], Running(before={"_before": F.struct(*keys)}))
    return rows.filter(F.col("_before").isNotNull() & (F.struct(*keys) < F.col("_before"))).drop("_before")


def required_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required fields that the schema lacks."""
    have = set(df.columns)
    return [c for c in required if c not in have]
