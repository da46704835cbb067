"""Readers and writers of the formats the engine meets: JSON tables and documents, CSV, binary files, PNG headers, manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place))


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str, required: bool = False, lines: bool = False) -> DataFrame:
    """A JSON array (or several files of them; with ``lines`` an object on each line) as rows of ``schema``; missing files are empty tables unless ``required``."""
    paths = [p for p in ([path] if isinstance(path, str) else path) if required or _exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(paths, multiLine=not lines)


def read_document(spark: SparkSession, path: str, rows: str, row_schema: T.StructType, header: T.StructType | None = None) -> DataFrame:
    """A JSON object with an array of rows in it: the rows, with the header's fields beside them."""
    head = list(header.fields) if header else []
    df = spark.read.schema(T.StructType([*head, T.StructField(rows, T.ArrayType(row_schema))])).json(path, multiLine=True)
    return df.select(*[f.name for f in head], F.explode(rows).alias("_row")).select(*[f.name for f in head], "_row.*")


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, lists: tuple[str, ...] = ()) -> DataFrame:
    """A CSV table with a header, cast to ``schema``; a value that can't be cast fails the read.

    Columns named in ``lists`` hold lists of strings written with single quotes.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name in lists else f.dataType) for f in schema.fields])
    df = spark.read.csv(path, header=True, schema=raw, mode="FAILFAST")
    return df.withColumns({c: F.from_json(F.replace(c, F.lit("'"), F.lit('"')), "array<string>") for c in lists}) if lists else df


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256, width, height) of files; width and height from the header of PNG files, else null. Files of no bytes aren't read by Spark."""
    df = spark.read.format("binaryFile").load(path)
    number = lambda at: F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int")
    png = F.hex(F.substring("content", 1, 8)) == "89504E470D0A1A0A"
    return df.select("path", "length", F.sha2("content", 256).alias("sha256"), F.when(png, number(17)).alias("width"), F.when(png, number(21)).alias("height"))


def with_existence(df: DataFrame, files: DataFrame, name: str) -> DataFrame:
    """Adds ``exists``: is there a file whose last path element is the row's ``name``?"""
    there = files.select(F.element_at(F.split("path", "/"), -1).alias(name)).distinct().withColumn("exists", F.lit(True))
    return df.join(there, name, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def fill_blanks(df: DataFrame, *columns: str) -> DataFrame:
    """Null as '' in the named columns."""
    return df.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, as many files as the data has partitions; an empty table replaces what was there."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays and structs as JSON text."""
    nested = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType)}
    (df.withColumns(nested) if nested else df).write.mode("overwrite").csv(path, header=True)


def write_json_array(df: DataFrame, path: str, order: list[str], most: int = 100_000) -> None:
    """One JSON array, indented, in ``order``: a document that people read, of at most ``most`` rows; larger tables go to ``write_json``."""
    rows = df.orderBy(*order).limit(most + 1).select(F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"})).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no document")
    body = ",\n".join("  " + r[0].replace("\n", "\n  ") for r in rows)
    write_bytes(df.sparkSession, path, (f"[\n{body}\n]\n" if rows else "[]\n").encode())


def write_manifest(spark: SparkSession, path: str, **facts: object) -> None:
    """One run's facts as readable JSON: a few lines, on whatever file system the path is."""
    write_bytes(spark, path, (json.dumps(facts, indent=2, ensure_ascii=False, sort_keys=True) + "\n").encode())


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, on whatever file system the path is; one that is there is replaced."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    for at in range(0, len(content), 8_000_000):
        out.write(bytearray(content[at : at + 8_000_000]))
    out.close()


def read_config(spark: SparkSession, path: str) -> dict:
    """A configuration: one JSON object of a few lines."""
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(found, dict):
        raise ValueError(f"{path} is no JSON object")
    return found


def create_if_absent(spark: SparkSession, path: str, document: dict) -> bool:
    """Writes a document where there is none yet; tells whether it did."""
    if _exists(spark, path):
        return False
    write_bytes(spark, path, (json.dumps(document, indent=2, ensure_ascii=False) + "\n").encode())
    return True


def container_problems(spark: SparkSession, path: str, expected: str) -> DataFrame:
    """(path, problem) of JSON files that aren't the ``expected`` container, 'list' or 'object'."""
    first = F.substring(F.regexp_replace("value", r"^[\s\x{feff}]+", ""), 1, 1)
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), first.alias("first"))
    return files.filter(F.col("first") != {"list": "[", "object": "{"}[expected]).select("path", F.lit(f"expected {expected}").alias("problem"))


def missing_sources(wanted: DataFrame, files: DataFrame, name: str) -> DataFrame:
    """Rows whose file isn't there: a publication that copies all must find none."""
    return with_existence(wanted, files, name).filter(~F.col("exists")).drop("exists")
