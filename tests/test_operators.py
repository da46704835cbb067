import random
import re

import pytest
from pyspark.sql import functions as F

from platemark.functions import geometry as g
from platemark.functions import text
from platemark.operators import browse, legend, merge, sequence, validate
from platemark.plans import sequence_queries


def one(spark, expr, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()]).select(expr.alias("v")).first().v


def test_touching_and_flat_boxes(spark):
    box = lambda *v: tuple(F.lit(x) for x in v)
    assert one(spark, g.iou(box(0, 0, 10, 10), box(10, 0, 10, 10))) == 0.0
    assert one(spark, g.area_ratio(box(0, 0, 0, 10), box(0, 0, 5, 5))) == 0.0
    assert one(spark, g.iou(box(0, 0, 10, 10), box(0, 0, 10, 10))) == 1.0
    assert one(spark, g.aspect(F.lit(0), F.lit(4))) is None


@pytest.mark.parametrize("raw,title", [("stopSign2 ahead", "Stop Sign 2 Ahead"), ("Stop/yield", "Stop/Yield"), ("", ""), ("über  uns", "Über Uns")])
def test_title(spark, raw, title):
    assert one(spark, text.humanize_title(F.col("s")), s=raw) == title


@pytest.mark.parametrize("raw,label", [("NO parking2hours", "No Parking 2 Hours"), ("STOP/YIELD SIGN", "Stop/yield Sign"), ("aB", "A B")])
def test_label(spark, raw, label):
    assert one(spark, text.humanize_label(F.col("s")), s=raw) == label


@pytest.mark.parametrize("raw,line", [("is a big", "isabig"), ("S t o p", "Stop"), ("a\u00a0\u00a0bc", "a bc"), ("R 1 . 1,R2&R3  x", "R 1.1, R2 & R3 x"), ("", ""), ("  ", "")])
def test_lines(spark, raw, line):
    assert one(spark, text.normalize_line(F.col("s")), s=raw) == line


@pytest.mark.parametrize("raw,ok", [("Stop", True), ("ab", False), ("abc 1234", False), ("123", False), ("", False)])
def test_descriptions(spark, raw, ok):
    assert one(spark, text.valid_description(F.col("s")), s=raw) is ok


def test_legend_lines(spark):
    lines = [(1, 1, "R1, R2 Stop here"), (1, 2, "R3"), (1, 3, "12"), (1, 4, "Give way"), (1, 5, "Not for R9"), (1, 6, "R1&R4 Stop"), (2, 1, "Lost line"), (2, 2, " "), (2, 3, None)]
    got = sorted((r.block, r.code, r.description) for r in legend.parse(spark.createDataFrame(lines, "b int, n int, t string"), "b", "n", "t").drop("line_no").withColumnRenamed("b", "block").collect())
    assert got == [(1, "R1", "& R4 Stop"), (1, "R1", "Stop here"), (1, "R2", "Stop here"), (1, "R3", "Give way")]


def test_priority_merge_takes_each_field_from_its_source(spark):
    rows = [("f", 1, "UNKNOWN_1", "first text", "clean", 1), ("f", 2, "R1", " ", "complete", 2), ("f", 3, "R2", "second", "all", 3), ("f", 4, "unknown", None, "all", 4), ("g", 1, None, "", "clean", 1)]
    df = spark.createDataFrame(rows, "k string, p int, code string, description string, source string, page int")
    got = merge.priority_merge(df, "k", [F.col("p")], "code", "description", ["source", "page"]).collect()
    assert [tuple(r) for r in got] == [("f", "R1", "first text", "all", 3)]


def test_upsert_and_plans(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", None)], "k int, v string, w string")
    assert sorted(tuple(r) for r in merge.upsert(base, new, "k").collect()) == [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]
    assert sorted(tuple(r) for r in merge.replace_partition(base, new, "k").collect()) == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]
    assert sorted(tuple(r) for r in merge.sync_plan(base, new, "k").collect()) == [(1, "remove"), (3, "copy")]
    assert sorted(tuple(r) for r in merge.snapshot_diff(base, new, "k", "v").collect()) == [(1, "removed"), (2, "changed"), (3, "added")]


def test_digest_ignores_order_and_partitions_but_not_rows(spark):
    df = spark.createDataFrame([(i % 2, f"v{i}") for i in range(50)], "g int, v string")
    digest = lambda d: sorted(tuple(r) for r in merge.canonical_hash(d, ["v"], ["g"]).collect())
    assert digest(df) == digest(df.orderBy(F.desc("v")).repartition(7))
    assert digest(df) != digest(df.filter("v <> 'v3'"))
    texts = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("~", "c"), ("n", "c"), ("", "c"), ("a", None), (None, "a"), ("ab", ""), ("a", "b")]
    one = lambda r: merge.canonical_hash(spark.createDataFrame([(1, *r)], "g int, v string, w string"), ["v", "w"], ["g"]).first().digest
    assert len({one(r) for r in texts}) == len(texts)


@pytest.mark.parametrize("parts", [1, 5])
def test_ordinals(spark, parts):
    df = spark.createDataFrame([(v,) for v in "hgfedcba" * 1], "v string").repartition(parts)
    assert sorted((r.ordinal, r.v) for r in sequence.with_ordinal(df, [F.col("v")]).collect()) == list(enumerate("abcdefgh", 1))
    assert sequence.with_ordinal(df.limit(0), [F.col("v")]).count() == 0


def test_segments_reach_the_end(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0, 1, 1, 1, 0, 1, 0, 1, 1])], "k string, i int, v int")
    assert sorted((r["first"], r["last"], r["length"]) for r in sequence.segments(df, ["k"], "i", F.col("v") > 0, 2).collect()) == [(1, 3, 3), (7, 8, 2)]


def test_unknown_events_raise(spark):
    df = spark.createDataFrame([(1, 1, "edit"), (1, 2, "explode")], "k int, n int, e string")
    with pytest.raises(Exception, match="unknown event"):
        sequence.last_states(df, "k", [F.col("n")], {"edit": {"s": "draft"}}, "e").collect()


def test_extra_occurrences(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "a"), (6, "b")], "row int, k string")
    assert sorted(r.key for r in validate.extra_occurrences(df, "r", "t", "row", ["k"], "row").collect()) == ["2", "5"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_repeated_occurrences_at_one_time(spark, monkeypatch, broadcast):
    from platemark.operators import sizing

    monkeypatch.setattr(sizing, "SMALL", 50_000 if broadcast else 0)
    monkeypatch.setattr(sizing, "HOT_ROWS", 1)
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", None), ("b", 5), ("c", 1), (None, 1), (None, 1)], "k string, t int")
    assert sorted(r.key for r in validate.repeated_occurrences(df, "r", "t", "k", ["k"], "t").collect()) == ["a", "a", "a", "b", "b"]
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (5, "a"), (6, "b")], "row int, k string")
    assert sorted(r.key for r in validate.repeated_occurrences(rows, "r", "t", "row", ["k"], "row").collect()) == ["2", "5"]


def test_fallback_labels_without_a_page(spark, tmp_path):
    rows = [(1, None, "p_12.png", "", None), (2, None, "x.png", "R1", "Stop"), (3, 4, None, None, ""), (4, None, None, None, "Stop")]
    spark.createDataFrame(rows, "mapping_id int, page int, filename string, code string, description string").write.parquet(str(tmp_path / "sign_mappings_clean.parquet"))
    got = sorted(tuple(r) for r in sequence_queries.fallback_labels(spark, str(tmp_path)).collect())
    assert got == [(1, "Pnull-12", "Extracted sign (unlabeled)"), (2, "R1", "Stop"), (3, "P4-UNK", "Extracted sign (unlabeled)"), (4, "Pnull-UNK", "Stop")]


def plain_labels(t):
    """The rules of labels in plain Python; blanks and words of the second are those of its browser."""
    title = re.sub(r"([A-Za-z])(\d)", r"\1 \2", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", t))
    title = re.sub(r"\s+", " ", title).strip().title()
    ui = re.sub(r"([0-9])([A-Za-z])", r"\1 \2", re.sub(r"([A-Za-z])([0-9])", r"\1 \2", re.sub(r"([a-z])([A-Z])", r"\1 \2", t)))
    ui = re.sub(r"(?a:\b)([A-Z]{2,})(?a:\b)", lambda m: m[1].lower(), re.sub(r"(?ai)sign\b", "sign", ui))
    blank = "[\\t-\\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+"
    label = " ".join(w[:1].upper() + w[1:] for w in re.sub(blank, " ", ui).strip(" ").split(" "))
    letters, digits = sum(c.isalpha() for c in t), sum(c.isdigit() for c in t)
    return title, label, re.sub(r"[^A-Za-z0-9_.-]", "_", t), letters >= 3 and digits <= letters


def test_labels_of_all_texts(spark, tmp_path):
    fixed = ["R–3", "Ｒ３．１", "eine grüne Laterne", "SIGNé signé SIGN", "PM–271", "straße ßa", "ΟΔΟΣ ΣΑΣ", "a\u00a0\u2003b", "R²³¹abc", "漢abc", "e\u0301cole", "A٣", "\u3000x\ufeff", "ⅷ ⓐb", "x\x1fy", "İstanbul", ""]
    at = random.Random(7)
    texts = fixed + ["".join(at.choice("abZSIGNsign  09_-.éÉßΣσ–·Ｒ３\u00a0²①漢\u0301٣") for _ in range(at.randrange(14))) for _ in range(400)]
    spark.createDataFrame(list(enumerate(texts)), "row_id int, code string").write.parquet(str(tmp_path / "page_4_signs.parquet"))
    got = {r.row_id: (r.title, r.label, r.safe_name, r.valid_description) for r in sequence_queries.labels(spark, str(tmp_path)).collect()}
    assert [(t, got.get(i)) for i, t in enumerate(texts) if got.get(i) != plain_labels(t)] == []


def test_quiz_with_few_codes(spark):
    df = spark.createDataFrame([(1, "A"), (2, "Z")], "row_id int, code string")
    got = sorted((r.row_id, r.option, r.correct) for r in browse.quiz(df, spark.createDataFrame([("A",), ("B",), ("B",)], "code string")).collect())
    assert got == [(1, "A", True), (1, "B", False)]


def test_collation_order(spark):
    df = spark.createDataFrame([(1, "b.png", 1, 1.0), (2, "B.png", 1, 1.0), (3, "a.png", 1, None)], "row_id int, filename string, page int, confidence double")
    assert [r.row_id for r in df.orderBy(*browse.library_order("UNICODE")).collect()] == [1, 2, 3]
    assert [r.row_id for r in df.orderBy(*browse.library_order()).collect()] == [2, 1, 3]


def test_small_helpers(spark, monkeypatch):
    from platemark.operators import grid
    from platemark.session import run_time

    monkeypatch.setenv("PLATEMARK_TIME", "2024-01-01T00:00:00Z")
    assert run_time() == "2024-01-01T00:00:00Z"
    blocks = spark.createDataFrame([(1, 10.0, 200.0, "a" * 21), (2, 10.0, 200.0, "short"), (3, 1400.0, 200.0, "a" * 30), (4, 10.0, 150.0, "a" * 30)], "id int, x0 double, y0 double, text string")
    assert [r.id for r in legend.body_blocks(blocks).collect()] == [1]
    regions = spark.createDataFrame([("a", 2, 1, [5, 5], [3]), ("b", 2, 1, [5], [3]), ("c", 1, 2, [0], [1, 2]), ("d", 0, 0, [], [])], "name string, columns int, rows int, column_widths array<int>, row_heights array<int>")
    assert sorted(tuple(r) for r in grid.invalid_regions(regions, ["name"]).collect()) == [("b", "column_widths"), ("c", "not_positive")]
    assert [r.v for r in spark.range(4, 6).select(grid.page_type(F.col("id")).alias("v")).collect()] == ["standard", "legend"]
    assert one(spark, merge.sorted_union(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("b"), F.lit("c")))) == ["a", "b", "c"]
    assert merge.get_one(regions, "name", "b").first().columns == 2
    with pytest.raises(KeyError):
        merge.get_one(regions, "name", "zz")
