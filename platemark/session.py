"""Session builder and the few settings the library depends on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str = "local[8]", app: str = "platemark", **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` wins over them. Only a local one has a fixed number of shuffle partitions."""
    conf = CONF | ({"spark.sql.shuffle.partitions": "8"} if master.startswith("local") else {}) | extra
    return SparkSession.builder.master(master).appName(app).config(map=conf).getOrCreate()


def tasks(spark: SparkSession) -> int:
    """Tasks for a step that should use all cores: the session's shuffle partitions, or its cores if they are more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that has no such setting (tests, a laptop) makes a
    temporary folder of this machine, and remembers it; on a cluster executors
    wouldn't see one, so there a missing setting is an error.
    """
    key = "spark.checkpoint.dir"
    named = spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {key} to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="platemark-")
        spark.conf.set(key, named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder: the lineage ends there and survives lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for ``name`` under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Deletes ``path`` when the driver ends: what reads it may run until then."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def remove() -> None:
        try:
            files.delete(place, True)
        except Exception:  # noqa: BLE001 - the JVM is gone; nothing is left to do
            pass

    atexit.register(remove)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written once into the shared folder: its lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def local_view(path: str) -> str:
    """``file:///x`` as ``/x``; makes the parent folder."""
    plain = path[len("file:"):] if path.startswith("file:") else path
    plain = "/" + plain.lstrip("/")
    os.makedirs(os.path.dirname(plain), exist_ok=True)
    return plain


def run_time() -> str:
    """The run's time in ISO 8601, UTC; PLATEMARK_TIME fixes it, so that runs can be repeated to the byte."""
    return os.environ.get("PLATEMARK_TIME") or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
