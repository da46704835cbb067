import random

import pytest
from pyspark.sql import functions as F

from platemark.llm import topn


def make(spark, rows, parts=5):
    return spark.createDataFrame(rows, "g string, score double, tie string, top int, local_bound string, Group_Bound string").repartition(parts)


ORDER = [("score", False), ("tie", True)]


def expected(rows):
    out = []
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g and r[1] is not None and r[1] == r[1] and r[3] is not None and r[3] > 0]
        mine.sort(key=lambda r: (-r[1], r[2] is None, r[2] or ""))
        out += [(g, i, r[2]) for i, r in enumerate(mine[: mine[0][3] if mine else 0], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.g, r.rank_no, r.tie) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bounds", [1, 20_000])
def test_equals_brute_force(spark, monkeypatch, seed, bounds):
    monkeypatch.setattr(topn, "BOUNDS", bounds)
    rng = random.Random(seed)
    tops = {"a": 3, "b": 1, "c": 0, "d": None, None: 2}
    rows = [(g := rng.choice(["a", "a", "a", "b", "c", "d", None]), rng.choice([None, float("nan"), 0.5, 0.5, rng.random(), -1.0]), f"t{i:03d}", tops[g], "x", "y") for i in range(300)]
    assert found(topn.top_n_per_group(make(spark, rows), ["g"], "score", ORDER, "top")) == expected(rows)


def test_empty_repeated_and_null_ties(spark):
    row = ("a", 1.0, "t", 2, "x", "y")
    assert found(topn.top_n_per_group(make(spark, [row] * 5), ["g"], "score", ORDER, "top")) == [("a", 1, "t"), ("a", 2, "t")]
    assert found(topn.top_n_per_group(make(spark, [row]).limit(0), ["g"], "score", ORDER, "top")) == []
    assert found(topn.top_n_per_group(make(spark, [("a", 1.0, None, 1, "", ""), ("a", 1.0, "z", 1, "", "")]), ["g"], "score", ORDER, "top")) == [("a", 1, "z")]


def test_only_the_order_may_begin_with_the_score(spark):
    with pytest.raises(ValueError, match="score"):
        topn.top_n_per_group(make(spark, []), ["g"], "score", ORDER[::-1], "top")


def test_a_hot_group_is_pruned_before_it_moves(spark):
    df = spark.range(0, 60_000, numPartitions=6).select(F.lit("hot").alias("g"), (F.col("id") % 1000 / 1000).alias("score"), F.format_string("%06d", "id").alias("tie"), F.lit(4).alias("top"))
    bounds = topn.group_bounds(df, ["g"], ORDER, "top")
    assert [(r.g, r.bound.w0, r.partitions) for r in bounds.collect()] == [("hot", pytest.approx(0.999), 6)]
    assert topn.within_bounds(df, ["g"], ORDER, bounds).count() == 60  # 60,000 before
    assert found(topn.top_n_per_group(df, ["g"], "score", ORDER, "top")) == [("hot", i + 1, f"{999 + 1000 * i:06d}") for i in range(4)]


def test_equal_scores_are_pruned_by_the_next_columns(spark):
    df = spark.range(0, 30_000, numPartitions=6).select(F.lit("hot").alias("g"), F.lit(0.5).alias("score"), F.when(F.col("id") % 7 > 0, F.col("id") / 10).alias("next"), F.lit("t").alias("tie"), F.lit(3).alias("top"))
    order = [("score", False), ("next", True), ("tie", True)]
    assert topn.within_bounds(df, ["g"], order, topn.group_bounds(df, ["g"], order, "top")).count() == 3
    assert sorted(r.next for r in topn.top_n_per_group(df, ["g"], "score", order, "top").collect()) == [0.1, 0.2, 0.3]


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_bounds_do_not_depend_on_batches(spark, batch):
    rng = random.Random(batch)
    rows = [(rng.choice(["a", "b", None]), float(rng.randrange(50)), "t", 3) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, score double, tie string, top int").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r.g: r.bound.w0 for r in topn.group_bounds(df, ["g"], ORDER, "top").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {g: sorted((r[1] for r in rows if r[0] == g), reverse=True)[2] for g in ("a", "b", None)}


def test_missing_numbers_come_last(spark):
    nan = float("nan")
    rows = [("a", 1.0, v, str(i), 2) for i, v in enumerate([None, nan, 5.0, None, nan, float("inf")])]
    df = spark.createDataFrame(rows, "g string, score double, d double, tie string, top int").repartition(3)
    for up, expected in ((True, ["2", "5"]), (False, ["1", "4"])):
        got = topn.top_n_per_group(df, ["g"], "score", [("score", False), ("d", up), ("tie", True)], "top")
        assert [r.tie for r in got.orderBy("rank_no").collect()] == expected


def test_only_known_groups(spark):
    df = make(spark, [("a", 1.0, "t", 1, "", ""), ("b", 1.0, "t", 1, "", "")])
    known = spark.createDataFrame([("b", 1), ("b", 2)], "g string, score int")
    assert found(topn.top_n_per_group(df, ["g"], "score", ORDER, "top", known=("g", known))) == [("b", 1, "t")]


def test_later_delivery_replaces_the_score(spark):
    g = "named_struct('iou', 0.5D, 'center_distance', 0.1D)"
    rows = spark.sql(f"""SELECT id AS candidate_assignment_id, 'r' AS run_id, 'f' AS filename, ref AS reference_position_id, score AS match_score, {g} AS geometry_agreement, CAST(at AS timestamp) AS ingested_at FROM VALUES
      ('a', 'p1', 0.9D, '2024-01-01'), ('a', 'p1', CAST(null AS double), '2024-01-02'), ('b', 'p2', 0.1D, null), ('b', 'p2', 0.8D, '2024-01-01'), ('c', 'p0', 0.8D, '2024-01-01'), ('c', 'p0', 0.8D, '2024-01-01') AS t(id, ref, score, at)""")
    manifest = spark.createDataFrame([("r", "2024-01-01T00:00:00Z", 9), ("r", "2024-01-01T02:00:00+01:00", 2), (None, None, 1)], "run_id string, run_at string, top_k int")
    signs = spark.createDataFrame([("f",), ("f",), (None,)], "filename string")
    assert [(r.rank_no, r.candidate_assignment_id) for r in topn.best_candidates(rows, manifest, signs).orderBy("rank_no").collect()] == [(1, "c"), (2, "b")]
    assert topn.best_candidates(rows, manifest.limit(0), signs).count() == 0
