import random

import pytest
from pyspark.sql import functions as F

from platemark.operators import legend, sequence, sizing, validate
from platemark.operators.running import Running, running


def made(spark, n=400):
    r = random.Random(8)
    rows = [(r.choice(["hot"] * 6 + ["a", "b", None]), i, r.choice([None, None, "x", "y"]), r.randrange(9)) for i in range(n)]
    r.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, i int, s string, v int").repartition(3)


@pytest.mark.parametrize("hot", [0, 200_000])
def test_running_values_equal_a_plain_loop(spark, monkeypatch, hot):
    monkeypatch.setattr(sizing, "HOT_ROWS", hot)
    rows, df = made(spark)
    got = running(df, ["k"], ["i"], Running("n", {"total": F.col("v")}, {"kept": F.col("s")}, {"prior": F.col("s"), "pair": F.struct("v", "i")}))
    expected, state = {}, {}
    for k, i, s, v in sorted(rows, key=lambda r: r[1]):
        n, total, kept, prior, pair = state.get(k, (0, 0, None, None, None))
        expected[i] = (k, n + 1, total + v, s if s is not None else kept, prior, pair)
        state[k] = (n + 1, total + v, s if s is not None else kept, s, (v, i))
    assert {r.i: (r.k, r.n, r.total, r.kept, r.prior, r.pair and tuple(r.pair)) for r in got.collect()} == expected
    assert set(got.columns) == {"k", "i", "s", "v", "n", "total", "kept", "prior", "pair"}
    clash = df.withColumns({"chunk": F.lit(7), "c_number": F.col("v"), "_c_x": F.lit("q"), "nth_of_chunk": F.lit(2)})
    got = running(clash, ["k"], ["i"], Running("n", before={"prior": F.col("s")})).collect()
    assert {r.i: (r.k, r.n, r.prior) for r in got} == {i: (e[0], e[1], e[4]) for i, e in expected.items()} and {(r.chunk, r.nth_of_chunk, r._c_x, r.c_number == r.v) for r in got} == {(7, 2, "q", True)}


def test_operators_over_a_hot_key(spark, monkeypatch):
    _, df = made(spark)
    effects = {"x": {"state": "one"}, "y": {"state": "two", "other": "set"}}
    lines = df.select(F.lit(1).alias("block"), "i", F.when(F.col("s") == "x", F.concat(F.lit("R"), F.col("v").cast("string"))).otherwise(F.concat(F.lit("some words "), F.col("i").cast("string"))).alias("line"))
    run = lambda: [
        sorted(map(str, sequence.versions(df, "k", ["i"], effects, "s").select("i", "version_no", "state", "other").collect())),
        sorted(r.i for r in validate.unordered(df, "i", ["v"], "k").collect()),
        sorted(map(str, legend.parse(lines, "block", "i", "line").collect())),
    ]
    plain = run()
    monkeypatch.setattr(sizing, "HOT_ROWS", 50)
    assert run() == plain and all(plain)
