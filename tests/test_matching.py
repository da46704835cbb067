import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from platemark.functions import geometry as g
from platemark.operators import matching
from platemark.plans import box_queries, catalog

FOLDER = "/root/testdata/sf0.01"
CROP = "filename string, page int, code string, norm_x double, norm_y double, norm_w double, norm_h double"
REF = "reference_position_id string, page int, edition string, official_code string, ref_x double, ref_y double, ref_w double, ref_h double"


@pytest.mark.parametrize("part", [7, 2000])
def test_contenders_lose_no_pair_of_the_best(spark, monkeypatch, part):
    from pyspark.sql import functions as F

    monkeypatch.setattr(matching, "PART", part)
    at = random.Random(part)
    value = lambda: at.choice([at.random(), 0.1, 0.2, 0.0]) if at.random() > 0.03 else None
    box = lambda: [value() for _ in range(4)]
    crops = spark.createDataFrame([(f"f{i}.png", at.choice([1, 2, 9, None]), at.choice(["R1", " R2 ", "", None]), *box()) for i in range(60)], CROP)
    refs = spark.createDataFrame([(f"RP-{i}", at.choice([1, 1, 2, 3]), at.choice("abc"), at.choice(["R1", "R2", None]), *box()) for i in range(90)], REF)
    scored = lambda pairs: matching.scored(pairs, g.box("norm_x", "norm_y", "norm_w", "norm_h"), g.box("ref_x", "ref_y", "ref_w", "ref_h"), F.col("code"), F.col("official_code"))
    best = lambda pairs: rows(matching.ranked(scored(pairs), ["filename"], 3, "reference_position_id"))
    assert best(matching.contenders(crops, refs, "page", "filename", 3)) == best(crops.join(refs, "page"))


@pytest.mark.parametrize("part", [7, 2000])
def test_contenders_of_each_edition_lose_no_pair_and_few_others_leave(spark, monkeypatch, part):
    monkeypatch.setattr(matching, "PART", part)
    at = random.Random(part)
    value = lambda: at.choice([at.random(), 0.1, 0.2, 0.0]) if at.random() > 0.03 else None
    box = lambda: [value() for _ in range(4)]
    crops = spark.createDataFrame([(f"f{i}.png", at.choice([1, 2, 9, None]), at.choice(["R1", " R2 ", "", None]), *box()) for i in range(60)], CROP)
    refs = spark.createDataFrame([(f"RP-{i}", at.choice([1, 1, 2, 3]), at.choice(["a", "a", "b", "c", None]), at.choice(["R1", "R2", "", None]), *box()) for i in range(300)], REF)
    scored = lambda pairs: matching.scored(pairs, g.box("norm_x", "norm_y", "norm_w", "norm_h"), g.box("ref_x", "ref_y", "ref_w", "ref_h"), F.col("code"), F.col("official_code"))
    best = lambda pairs: rows(matching.ranked(scored(pairs), ["edition", "filename"], 3, "reference_position_id"))
    met = matching.contenders(crops, refs, "page", "filename", 3, per="edition")
    pairs = crops.join(refs, "page")
    assert best(met) == best(pairs)
    assert met.count() < pairs.count() / 2


def test_page_match_sorts_only_contenders(spark):
    """Pairs of a page are scored in blocks; they aren't all handed to the ranking, which sorts."""
    plan = catalog.queries()["page_match"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan


def test_page_match_all_knows_every_edition_and_ranks_per_crop(spark):
    got = catalog.queries()["page_match_all"](spark, FOLDER)
    page_of = {r.filename: r.page for r in box_queries._instances(spark, FOLDER).collect()}
    refs = {r.reference_position_id: r for r in box_queries._references(spark, FOLDER).collect()}
    n = {}
    for r in refs.values():
        n[r.page_number] = n.get(r.page_number, 0) + 1
    ranks = {}
    for r in got.collect():
        assert refs[r.reference_position_id].page_number == page_of[r.filename]
        ranks.setdefault(r.filename, []).append(r["rank"])
    assert {f: sorted(v) for f, v in ranks.items()} == {f: list(range(1, min(3, n[p]) + 1)) for f, p in page_of.items() if n.get(p)}
    run = {r.edition_id.strip().lower() for r in spark.read.parquet(f"{FOLDER}/reference_matcher_run_manifest.parquet").collect() if r.edition_id}
    assert {refs[r.reference_position_id].edition for r in got.collect()} - run
