import json
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platemark.operators.matching import Weights
from platemark.operators.sequence import last_states
from platemark.sources import images, io
from platemark.streaming import lifecycle

ROW = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_json_tables_and_documents(spark, tmp_path):
    one, two, doc = tmp_path / "1.json", tmp_path / "2.json", tmp_path / "d.json"
    one.write_text(json.dumps([{"a": 1, "b": "x"}, {"a": 2}]))
    two.write_text(json.dumps([{"b": "ü"}]))
    doc.write_text(json.dumps({"version": "1", "cells": [{"a": 5}, {"b": "q"}]}))
    assert sorted(map(tuple, io.read_json(spark, [str(one), str(two), str(tmp_path / "none.json")], ROW).collect()), key=str) == [(1, "x"), (2, None), (None, "ü")]
    assert io.read_json(spark, str(tmp_path / "none.json"), ROW).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        io.read_json(spark, str(tmp_path / "none.json"), ROW, required=True).count()
    got = io.read_document(spark, str(doc), "cells", ROW, T.StructType([T.StructField("version", T.StringType())]))
    assert sorted(map(tuple, got.collect()), key=str) == [("1", 5, None), ("1", None, "q")]


def test_csv_round_trip(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("tags", T.ArrayType(T.StringType()))])
    (tmp_path / "t.csv").write_text("n,tags\n1,[]\n2,\"['a', 'b']\"\n")
    df = io.read_csv(spark, str(tmp_path / "t.csv"), schema, ("tags",))
    assert [tuple(r) for r in df.orderBy("n").collect()] == [(1, []), (2, ["a", "b"])]
    io.write_csv(df, str(tmp_path / "out"))
    assert [r.tags for r in io.read_csv(spark, str(tmp_path / "out"), schema, ("tags",)).orderBy("n").collect()] == [[], ["a", "b"]]
    (tmp_path / "bad.csv").write_text("n,tags\nx,[]\n")
    with pytest.raises(Exception, match="(?i)csv|cast|failfast|malformed|FAILED_READ"):
        io.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_files_and_png_headers(spark, tmp_path):
    import hashlib

    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 6736, 9536) + b"rest"
    (tmp_path / "p.png").write_bytes(png)
    (tmp_path / "t.txt").write_bytes(b"t")
    files = io.read_files(spark, str(tmp_path))
    got = {r.path.split("/")[-1]: (r.sha256, r.width, r.height) for r in files.collect()}
    assert got == {"p.png": (hashlib.sha256(png).hexdigest(), 6736, 9536), "t.txt": (hashlib.sha256(b"t").hexdigest(), None, None)}
    wanted = spark.createDataFrame([("p.png",), ("q.png",)], "filename string")
    assert [r.filename for r in io.missing_sources(wanted, files, "filename").collect()] == ["q.png"]


def test_sinks_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], ROW)
    io.write_json(io.fill_blanks(df, "b"), str(tmp_path / "j"))
    assert [tuple(r) for r in spark.read.schema(ROW).json(str(tmp_path / "j")).collect()] == [(1, "")]
    io.write_json(df.limit(0), str(tmp_path / "j"))
    assert spark.read.schema(ROW).json(str(tmp_path / "j")).count() == 0
    io.write_manifest(spark, f"file://{tmp_path}/m/run.json", rows=3, name="ü")
    assert json.loads((tmp_path / "m" / "run.json").read_text()) == {"name": "ü", "rows": 3}


def test_documents_and_configurations(spark, tmp_path):
    df = spark.createDataFrame([(2, "ü\n"), (1, None)], ROW)
    io.write_json_array(df, str(tmp_path / "a.json"), ["a"])
    text = (tmp_path / "a.json").read_text()
    assert json.loads(text) == [{"a": 1, "b": None}, {"a": 2, "b": "ü\n"}] and text.startswith("[\n  {\n    ")
    io.write_json_array(df.limit(0), str(tmp_path / "e.json"), ["a"])
    assert json.loads((tmp_path / "e.json").read_text()) == []
    with pytest.raises(ValueError, match="no document"):
        io.write_json_array(df, str(tmp_path / "b.json"), ["a"], most=1)
    assert io.create_if_absent(spark, str(tmp_path / "c.json"), {"weights": {"iou": 0.5, "ocr_bonus": 0}, "top_k": 3})
    assert not io.create_if_absent(spark, str(tmp_path / "c.json"), {})
    config = io.read_config(spark, str(tmp_path / "c.json"))
    assert config["top_k"] == 3 and Weights.of(config) == Weights(overlap=0.5, text_bonus=0.0) and Weights.of({}) == Weights()
    with pytest.raises(ValueError, match="no JSON object"):
        io.read_config(spark, str(tmp_path / "e.json"))
    assert [(r.path.split("/")[-1], r.problem) for r in io.container_problems(spark, str(tmp_path), "list").collect()] == [("c.json", "expected list")]
    assert io.container_problems(spark, str(tmp_path / "c.json"), "object").count() == 0


def test_images(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert [tuple(r) for r in images.map_images(files, lambda p, c: [{"n": len(c)}], "n int").collect()] == [(3,)]
    pixels = spark.createDataFrame([("p", 0, 10), ("p", 0, 255), ("p", 1, 255)], "page string, y int, value int")
    assert sorted((r.y, r.ink, r.density) for r in images.ink_profile(pixels, ["page"], "y").collect()) == [(0, 1, 0.5), (1, 0, 0.0)]


def test_streams_equal_batches(spark, tmp_path):
    rows = [(1, 1, "edit", "2024-01-01 00:01:00"), (1, 2, "approve", "2024-01-01 00:02:00"), (2, 3, "edit", "2024-01-01 00:11:00")]
    effects = {"edit": {"s": "draft"}, "approve": {"s": "approved"}}
    source = str(tmp_path / "in")
    df = spark.createDataFrame(rows, "k int, n int, e string, t string").withColumn("t", F.to_timestamp("t"))
    df.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for name, out, mode in (("states", lifecycle.running_states(stream, "k", [F.col("n")], effects, "e"), "complete"), ("counts", lifecycle.windowed_counts(stream, "t", "e", "10 minutes", "1 hour"), "complete")):
        q = out.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert sorted(map(tuple, spark.table("states").collect())) == sorted(map(tuple, last_states(df, "k", [F.col("n")], effects, "e").collect()))
    assert sorted((r.e, r.n) for r in spark.table("counts").collect()) == [("approve", 1), ("edit", 1), ("edit", 1)]
