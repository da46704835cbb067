"""Streams: late events within a watermark, counts per window, and lifecycle states as they stand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.operators.sequence import last_states
from platemark.session import remove_at_exit, shared_path


def windowed_counts(events: DataFrame, at: str, key: str, window: str, late: str) -> DataFrame:
    """(window_start, key, n) of a stream; events later than ``late`` are left out."""
    stamped = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    counts = stamped.groupBy(F.window("_at", window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), key, "n")


def running_states(events: DataFrame, key: str, place: list[Column], effects: dict[str, dict[str, str]], event: str) -> DataFrame:
    """The batch fold over a stream (output mode update or complete): each entity's state after the events so far.

    The fold takes maxima by event order, so events may arrive in any order.
    """
    return last_states(events, key, place, effects, event)


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, a folder or a single file, as a stream of its files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())
    return reader.parquet(path)


def drained(stream: DataFrame, name: str) -> DataFrame:
    """The result of an aggregating stream after all that is there now: every batch replaces the table, the state is kept in the shared folder."""
    spark = stream.sparkSession
    state, out = shared_path(spark, f"{name}-state"), shared_path(spark, name)
    for path in (state, out):
        remove_at_exit(spark, path)
    query = stream.writeStream.outputMode("complete").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
    query.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
