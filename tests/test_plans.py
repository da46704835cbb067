"""Plans: what is read, how tables meet, and that results don't depend on the partitioning."""

import pytest
from helpers import FOLDER, rows

from platemark.operators import sizing
from platemark.plans import catalog

ONE_ROW_JOINS = {"bag_and_distinct_union", "match_summary", "code_not_in_dictionary", "quiz_options"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_pairing_of_whole_tables(spark, name):
    text = plan(catalog.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert name in ONE_ROW_JOINS or "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name,column", [("match_topk", "warnings"), ("publish_records", "padded_x"), ("dup_groups", "author"), ("p3_found", "geometry"), ("canonical_hash", "geometry_agreement"), ("lifecycle_fold", "props")])
def test_columns_that_are_not_needed_are_not_read(spark, name, column):
    schemas = [line.split("ReadSchema: ", 1)[1] for line in plan(catalog.queries()[name](spark, FOLDER)).splitlines() if "ReadSchema: " in line]
    assert schemas and not any(column in s for s in schemas)


def test_filters_reach_the_scan(spark):
    text = plan(catalog.queries()["priority_merge"](spark, FOLDER))
    assert "PushedFilters: [" in text and "In(label_source" in text


def test_ranks_are_cut_before_the_shuffle(spark):
    assert plan(catalog.queries()["match_topk"](spark, FOLDER)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["match_topk", "nms_greedy", "nearest_box", "merge_boxes_fixpoint", "priority_merge", "positional_zip", "canonical_hash", "legend_parse", "version_snapshots", "p2_found", "p3_found"])
def test_partitioning_changes_nothing(spark, name):
    query = catalog.queries()[name]
    first = rows(query(spark, FOLDER))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows(query(spark, FOLDER)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_keys_that_repeat_are_told_from_the_others(spark, monkeypatch, most):
    monkeypatch.setattr(sizing, "REPEATED", most)
    rows = [("a", 1, "x", True), ("b", 2, "x", None), ("a", 3, "x", True), (None, 4, "x", True), (None, 5, "x", True), ("c", 6, "x", False)]
    once, rest = sizing.without_repeats(spark.createDataFrame(rows, "k string, v int, hash string, repeated boolean").repartition(3), "k")
    assert rest.columns == ["k", "v", "hash", "repeated"]
    if most:
        assert sorted(r.v for r in once.collect()) == [2, 6] and sorted(r.v for r in rest.collect()) == [1, 3, 4, 5]
    else:
        assert once is None and rest.count() == 6
    assert sizing.without_repeats(spark.createDataFrame([], "k string, v int"), "k")[1].count() == 0
