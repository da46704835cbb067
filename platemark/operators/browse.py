"""Search, order and pages of a library of records; quizzes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platemark.functions.text import humanize_label
from platemark.operators.sequence import with_ordinal
from platemark.operators.sizing import small_or_shuffled


def search(df: DataFrame, query: str, mode: str = "all") -> DataFrame:
    """Records whose code, readable description or p{page}-{filename} holds the query (lower case, trimmed); '' finds all.

    ``mode`` ok or warning keeps that status, any other keeps all. ``df`` has
    code, description, page, filename, status.
    """
    q = query.strip().lower()
    if mode in ("ok", "warning"):
        df = df.filter(F.col("status") == mode)
    if not q:
        return df
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    name = F.concat(F.lit("p"), F.coalesce(F.col("page").cast("string"), F.lit("null")), F.lit("-"), F.lower(text("filename")))
    return df.filter(F.lower(text("code")).contains(q) | F.lower(humanize_label(text("description"))).contains(q) | name.contains(q))


def library_order(collation: str | None = None) -> list[Column]:
    """Most confident first, then page, then filename (by ``collation`` if given, else by bytes), then row."""
    name = F.col("filename") if collation is None else F.collate("filename", collation)
    return [F.desc(F.coalesce("confidence", F.lit(0.0))), F.asc_nulls_last("page"), name.asc_nulls_last(), F.asc("row_id")]


def quiz(df: DataFrame, legend: DataFrame, options: int = 4, seed: str = "quiz") -> DataFrame:
    """For each coded record its right code and up to ``options - 1`` other codes, in one fixed shuffled order.

    Codes stand on a ring in the order of a seeded hash; the wrong options are
    the next codes on the ring, so every question takes an equi-join on ring
    places instead of a pairing of all codes. With fewer codes there are fewer
    options.
    """
    key = lambda *c: F.sha2(F.concat_ws("|", F.lit(seed), *c), 256)
    ring = with_ordinal(legend.select("code").distinct(), [key(F.col("code"))], "place")
    total = ring.agg(F.count(F.lit(1)).alias("total"))
    answers = df.join(small_or_shuffled(ring), "code").crossJoin(F.broadcast(total))
    steps = F.sequence(F.lit(0), F.least(F.lit(options - 1), F.col("total") - 1).cast("int"))
    asked = answers.select("row_id", F.col("code").alias("answer"), "total", "place", F.explode(steps).alias("step"))
    at = asked.withColumn("place", F.pmod(F.col("place") - 1 + F.col("step"), F.col("total")) + 1)
    return at.join(small_or_shuffled(ring), "place").select("row_id", "answer", F.col("code").alias("option"), (F.col("code") == F.col("answer")).alias("correct"))
