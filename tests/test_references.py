import random

import pytest
from pyspark.sql import functions as F

from platemark.operators import sizing
from platemark.operators.references import Reference, failing_references, utc_time


def child(spark, rows):
    return spark.createDataFrame(rows, "row_id long, a string, b string, created_at string, kind string")


def parent(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, created_at string, deleted_at string")


def found(df):
    return sorted((r.row_id, r.kind) for r in df.collect())


def test_kinds_in_order(spark):
    p = parent(spark, [("K1", "x", "2024-01-01T00:00:00Z", None), ("k2", "x", "2024-01-01T00:00:00Z", "2024-02-01"), ("k3", "x", "2025-01-01T00:00:00Z", None), ("k3", "y", "2024-06-01T00:00:00+02:00", None), ("k4", "x", None, None), (None, None, None, None)])
    rows = [
        (1, " k1\t", None, "2024-01-01T00:00:00Z", "x"), (2, "K2", None, "2023-01-01T00:00:00Z", "x"), (3, "k3", None, "2024-05-31 21:59:59", "x"), (4, "k3", None, "2024-05-31 22:00:00", "x"),
        (5, "k9", None, None, "x"), (6, "  ", None, None, "x"), (7, None, None, None, "x"), (8, "k4", None, "1999-01-01T00:00:00Z", "x"), (9, "k3", None, "not a time", "x"), (5, "k9", None, None, "x"),
    ]
    ref = Reference("a", ("a",), p, ("a",), utc_time("created_at"), F.col("deleted_at").isNotNull())
    assert found(failing_references(child(spark, rows), "row_id", utc_time("created_at"), [ref])) == [(2, "deleted"), (3, "late"), (5, "missing"), (5, "missing")]


@pytest.mark.parametrize("small", [0, 50_000])
def test_match_semantics(spark, monkeypatch, small):
    monkeypatch.setattr(sizing, "SMALL", small)
    p = parent(spark, [("1", "2", None, None), ("3", None, None, None)])
    rows = [(1, "1", "2", None, ""), (2, "1", "9", None, ""), (3, "1", None, None, ""), (4, "9", None, None, ""), (5, None, None, None, ""), (6, "3", None, None, "")]
    of = lambda match: found(failing_references(child(spark, rows), "row_id", F.lit(None).cast("timestamp"), [Reference("ab", ("a", "b"), p, ("a", "b"), match=match)]))
    assert of("simple") == [(2, "missing")]
    assert of("partial") == [(2, "missing"), (4, "missing")]
    assert of("full") == [(2, "missing"), (3, "partial_key"), (4, "partial_key"), (6, "partial_key")]


@pytest.mark.parametrize("small", [0, 50_000])
@pytest.mark.parametrize("match", ["simple", "partial", "full"])
def test_three_columns_with_nulls_equal_brute_force(spark, monkeypatch, match, small):
    monkeypatch.setattr(sizing, "SMALL", small)
    rng = random.Random(match)
    value = lambda: rng.choice([None, None, " ", "1", "2", " X", "x"])
    rows = [(i, value(), value(), value(), rng.choice([None, 1, 5])) for i in range(150)]
    parents = [(value(), value(), value(), rng.choice([None, 1, 3, 9]), rng.random() < 0.4) for _ in range(40)]
    p = spark.createDataFrame(parents, "a string, b string, c string, at long, gone boolean")
    norm = lambda v: (v or "").strip().lower() or None
    for timed in (False, True):
        ref = Reference("abc", ("a", "b", "c"), p, ("a", "b", "c"), F.timestamp_seconds("at") if timed else None, F.col("gone") if timed else None, match)
        got = found(failing_references(spark.createDataFrame(rows, "row_id long, a string, b string, c string, at long"), "row_id", F.timestamp_seconds("at"), [ref]))
        expected = []
        for i, *keys, at in rows:
            keys = [norm(k) for k in keys]
            nulls = keys.count(None)
            if nulls == 3 or (nulls and match == "simple"):
                continue
            if nulls and match == "full":
                expected.append((i, "partial_key"))
                continue
            met = [q for q in parents if all(k is None or norm(v) == k for k, v in zip(keys, q[:3], strict=True))]
            born = [q[3] for q in met if q[3] is not None]
            if not met:
                expected.append((i, "missing"))
            elif timed and all(q[4] for q in met):
                expected.append((i, "deleted"))
            elif timed and born and at is not None and min(born) > at:
                expected.append((i, "late"))
        assert got == sorted(expected)


def test_empty_tables(spark):
    ref = Reference("a", ("a",), parent(spark, []), ("a",))
    assert found(failing_references(child(spark, []), "row_id", F.lit(None).cast("timestamp"), [ref])) == []
    assert found(failing_references(child(spark, [(1, "k", None, None, "")]), "row_id", F.lit(None).cast("timestamp"), [ref])) == [(1, "missing")]


def test_times(spark):
    texts = ["2024-03-03T06:33:27Z", "2024-03-03T12:03:27+0530", "2024-03-03 06:33:27", "2024-03-03T01:33:27.000-05:00", "2024-03-03", "soon", None]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "s string").select(F.unix_seconds(utc_time("s")).alias("t")).collect()]
    assert got == [1709447607] * 4 + [1709424000, None, None]


def test_hot_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr(sizing, "SMALL", 2)
    monkeypatch.setattr(sizing, "HOT_ROWS", 50)
    rows = [(i, "hot" if i % 3 else f"k{i}", None, None, "") for i in range(600)]
    p = parent(spark, [("hot", None, None, None)] + [(f"k{i}", None, None, None) for i in range(0, 300, 3)])
    got = found(failing_references(child(spark, rows), "row_id", F.lit(None).cast("timestamp"), [Reference("a", ("a",), p, ("a",))]))
    assert got == [(i, "missing") for i in range(300, 600, 3)]
