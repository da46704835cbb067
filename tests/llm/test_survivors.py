import random

import pytest
from pyspark.sql import functions as F

from platemark.llm import survivors as s

SCHEMA = "mapping_id long, filename string, code string, description string, label_source string, updated_at timestamp_ntz, page int, first_id int, k int"
SOURCES = [("a", 50), ("b", 20), ("c", 20), ("d", 5)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "mapping_id long, filename string, code string, description string, label_source string, at long, page int").selectExpr("mapping_id", "filename", "code", "description", "label_source", "CAST(timestamp_seconds(at) AS timestamp_ntz) AS updated_at", "page", "1 AS first_id", "2 AS k", "3 AS n", "4 AS mask")
    return df, s.best_labels(df, spark.createDataFrame(SOURCES, "label_source string, trust int"))


def expected(rows):
    import re

    trust, groups = dict(SOURCES), {}
    for r in rows:
        name = (r[1] or "").lower().replace("%20", " ").replace("\\", "/").split("/")[-1]
        m = re.match(r"\s*page[\s_-]*0*([0-9]+)[\s_-]+([a-z]+)[\s_-]+0*([0-9]+)([a-z]?)(?![a-z0-9])", name)
        if m:
            groups.setdefault(m.groups(), []).append(r)
    good = lambda v: v is not None and re.search("[a-z0-9]", v.lower()) and v.strip().lower() not in s.STAND_INS and not re.match(s.NUMBERED_UNKNOWN, v.strip().lower())
    best = lambda g, i: min((-trust.get(r[4], -1), -(r[5] if r[5] is not None else -1), r[0]) for r in g if good(r[i]))[2] if any(good(r[i]) for r in g) else 0
    return sorted((min(r[0] for r in g), best(g, 2), best(g, 3)) for g in groups.values() if len(g) > 1)


def found(df):
    return sorted((r.first_id, r.code_id, r.description_id) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    writings = ["page1_sign_{}.png", "PAGE1_SIGN_{}.PNG", "./page1_sign_00{}.jpeg", "page%201%20sign%20{}.png", "D:\\scans\\page1_sign_{}.png", "page1_sign_{} (2).png", "page1_sign_{}_copy.png", " page1-sign-{}\n", "page1_sign_{}b.png"]
    values = ["R1", "K2.1", "", " ", None, "TBD", "unknown", "UNKNOWN_7", "-", "n/a", "Na435"]
    rows = [(i, rng.choice(writings).format(rng.randrange(6)), rng.choice(values), rng.choice(values), rng.choice(["a", "b", "c", "d", "zzz", None]), rng.choice([None, 1, 1, 2, 3]), rng.choice([1, None, 9])) for i in range(1, 160)]
    rows += [(500, None, "R1", "x", "a", 1, 1), (501, "nothing", "R1", "x", "a", 1, 1), (502, "", "R1", "x", "a", 1, 1)]
    assert found(run(spark, rows)[1]) == expected(rows)


def test_more_complete_does_not_beat_the_smaller_id(spark):
    rows = [(5, "page1_sign_1.png", "R5", None, "a", 1, 1), (9, "page1_sign_1.png", "R9", "text", "a", 1, 1)]
    assert found(run(spark, rows)[1]) == [(5, 5, 9)]


def test_repeated_rows_single_rows_and_empty_tables(spark):
    row = (1, "page1_sign_1.png", "R1", "x", "a", 1, 1)
    df, _ = run(spark, [row, row, (2, "page1_sign_2.png", "R1", "x", "a", 1, 1)])
    sources = spark.createDataFrame(SOURCES, "label_source string, trust int")
    assert found(s.best_labels(df, sources)) == [(1, 1, 1)]
    assert found(s.best_labels(df.limit(0), sources)) == []
    assert found(s.best_labels(df, sources.limit(0))) == [(1, 1, 1)]


def test_long_values_and_hot_groups(spark):
    df = spark.range(1, 3000).select(
        F.col("id").alias("mapping_id"), F.lit("page1_sign_1.png").alias("filename"), F.repeat(F.lit("x"), 5000).alias("code"), F.lit(None).cast("string").alias("description"),
        F.lit("a").alias("label_source"), F.expr("CAST(timestamp_seconds(id % 7) AS timestamp_ntz)").alias("updated_at"))
    assert found(s.best_labels(df, spark.createDataFrame(SOURCES, "label_source string, trust int"))) == [(1, 6, 0)]


def layered(records, fields, policy, completeness):
    """By definition, of candidates (mask, trust, at, id, values): field -> (id, value, layer)."""
    at = lambda r: -1 if r[2] is None else r[2]
    rank = lambda r: tuple({"trust": r[1], "recency": at(r), "id": -r[3], "completeness": r[0].bit_count()}[p] for p in policy)
    first = {}
    for r in records:
        if (r[0], r[1]) not in first or rank(r) > rank(first[r[0], r[1]]):
            first[r[0], r[1]] = r

    def dominates(a, b):
        full = a[0] & b[0] == b[0] if completeness == "fields" else a[0].bit_count() >= b[0].bit_count()
        better = (a[0] != b[0] if completeness == "fields" else a[0].bit_count() > b[0].bit_count()) or a[1] > b[1] or at(a) > at(b) or a[3] < b[3]
        return full and a[1] >= b[1] and at(a) >= at(b) and a[3] <= b[3] and better

    left, layers = list(first.values()), []
    while left:
        layers.append([r for r in left if not any(dominates(o, r) for o in left)])
        left = [r for r in left if r not in layers[-1]]
    out = {}
    for i in range(fields):
        for n, layer in enumerate(layers, 1):
            offering = [r for r in layer if r[0] >> i & 1]
            if offering:
                best = max(offering, key=rank)
                out[i] = (best[3], best[4][i], n)
                break
        else:
            out[i] = (0, None, None)
    return out


@pytest.mark.parametrize("completeness", ["fields", "count"])
@pytest.mark.parametrize("policy", [s.POLICY, ("completeness", "recency", "trust", "id"), ("id", "recency", "completeness", "trust")])
def test_layers_equal_their_definition(spark, policy, completeness):
    rng = random.Random(str(policy) + completeness)
    rows = [(f"g{rng.randrange(40)}", *[rng.choice([None, f"x{i}"]) for _ in range(3)], rng.randrange(4), rng.choice([None, 1, 2, 3]), i) for i in range(1, 260)]
    df = spark.createDataFrame(rows, "g string, a string, b string, c string, trust int, at long, id long")
    fields = {c: F.col(c).isNotNull() for c in "abc"}
    got = {r.g: r for r in s.skyline_survivors(df, "g", fields, "trust", "at", "id", policy, completeness).collect()}
    deepest = 0
    for g in {r[0] for r in rows}:
        records = [(sum(1 << i for i in range(3) if r[1 + i] is not None), r[4], r[5], r[6], r[1:4]) for r in rows if r[0] == g]
        expected = layered(records, 3, policy, completeness)
        assert [(got[g][f"{c}_id"], got[g][c], got[g][f"{c}_layer"]) for c in "abc"] == [expected[i] for i in range(3)]
        deepest = max([deepest, *[e[2] or 0 for e in expected.values()]])
    assert deepest == 1 if completeness == "fields" else deepest > 1 or policy[0] == "id"


def test_a_field_the_skyline_lacks_comes_from_the_next_layer(spark):
    rows = [("g", "A1", None, 9, 5, 1), ("g", None, "B2", 7, 4, 2), ("g", None, "B3", 3, 9, 3)]
    df = spark.createDataFrame(rows, "g string, a string, b string, trust int, at long, id long")
    fields = {c: F.col(c).isNotNull() for c in "ab"}
    r = s.skyline_survivors(df.filter("id < 3"), "g", fields, "trust", "at", "id", completeness="count").first()
    assert (r.a_id, r.a_layer, r.b_id, r.b_layer) == (1, 1, 2, 2)
    r = s.skyline_survivors(df, "g", fields, "trust", "at", "id", completeness="count").first()
    assert (r.b_id, r.b_layer) == (3, 1)  # the later record is on the skyline
    r = s.skyline_survivors(df, "g", fields, "trust", "at", "id", completeness="fields").first()
    assert (r.b_id, r.b_layer) == (2, 1)


def test_stand_ins_are_a_parameter(spark):
    rows = [(1, "page1_sign_1.png", "missing", "x", "a", 1, 1), (2, "page1_sign_1.png", "R1", "x", "b", 1, 1)]
    df, plain = run(spark, rows)
    assert found(plain) == [(1, 1, 1)]
    assert found(s.best_labels(df, spark.createDataFrame(SOURCES, "label_source string, trust int"), stand_ins=("missing",))) == [(1, 2, 1)]
