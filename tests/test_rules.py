"""Rules over planted cases: what the tables of TESTDATA.md may not hold."""

import pytest
from helpers import FOLDER, rows

from platemark.operators import sizing, validate
from platemark.plans import catalog
from platemark.plans import rule_queries as rules

SIDES = "named_struct('norm_x', {}D, 'norm_y', 0.2D, 'norm_w', 0.1D, 'norm_h', 0.1D)"


@pytest.fixture
def folder(spark, tmp_path):
    def write(name, sql):
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")

    write("manual_editions", "SELECT 'E1' AS edition_id")
    write("manual_pages", "SELECT * FROM VALUES ('P1', 'E1', 1), ('P2', 'e9', 2), (null, null, null) AS t(page_id, edition_id, page_number)")
    write("reference_cells", f"""SELECT row_id, id AS reference_cell_id, page AS page_id, 'E1' AS edition_id, number AS page_number, geometry, named_struct('history', history) AS provenance FROM VALUES
      (1L, 'C1', 'P1', 1, {SIDES.format(0.1)}, array(named_struct('event_type', 'create'), null)), (2L, 'C2', ' p1 ', 2, {SIDES.format(0.1)}, array()), (3L, 'C3', 'P1', 1, {SIDES.format(0.1000001)}, null),
      (4L, 'c1', 'P1', null, {SIDES.format(0.5)}, null), (5L, null, 'P7', 1, null, null) AS t(row_id, id, page, number, geometry, history)""")
    write("page_4_signs", """SELECT * FROM VALUES (1L, 'page4_sign_1.png', 4, 1, 1, 5, 5), (2L, 'page_3_sign_1.png', 4, 1, 1, 5, 5), (3L, 'sign.png', 4, 1, 1, 5, 6), (4L, null, null, 1, 1, 5, 5), (5L, 'page99999999999_x', 4, 9, 9, 9, 9)
      AS t(row_id, filename, page, x, y, w, h)""")
    write("reference_positions", """SELECT row_id, cast(row_id AS string) AS reference_position_id, cell AS reference_cell_id, version AS current_version, 'E1' AS edition_id, 'P1' AS page_id, 1 AS page_number
      FROM VALUES (1L, 'C1 ', 2), (2L, 'C1', 1), (3L, 'C2', 1), (4L, 'zz', 1), (5L, null, null) AS t(row_id, cell, version)""")
    write("reference_matcher_run_manifest", """SELECT run_id, 'x' AS matcher_version, cast(null AS string) AS contract_version, 't' AS run_at, ' ' AS edition_id, cast(null AS int) AS sample_limit, 3 AS top_k,
      named_struct('reference_positions', 'p', 'reference_cells', 'c') AS inputs, 'o' AS output_file FROM VALUES ('r1'), (null) AS t(run_id)""")
    write("candidate_assignments", "SELECT * FROM VALUES ('a', 'r1', '1'), ('b', 'r2', '9'), ('c', 'r2', null) AS t(candidate_assignment_id, run_id, reference_position_id)")
    return str(tmp_path)


def found(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_geometry_duplicates(spark, folder):
    """Cells 1 to 3 share a page and a box to six decimals (one page is written differently, so it is another); crops 1 and 2 their box."""
    assert found(rules.geometry_duplicates(spark, folder), "rule", "key") == [("cell_geometry_duplicate", "3"), ("crop_geometry_duplicate", "2")]


def test_page_numbers(spark, folder):
    got = rules.page_number_mismatch(spark, folder).collect()
    assert sorted((r.entity, r.row_id, r.page_number, r.should_be) for r in got if r.page_number is not None) == [("page_4_signs", 2, 4, 3), ("reference_cells", 2, 2, 1)]
    assert [(r.entity, r.row_id) for r in got if r.page_number is None] == [("reference_cells", 4)]


def test_versions(spark, folder):
    assert found(rules.version_rules(spark, folder), "row_id", "rule") == [(2, "version_mismatch"), (3, "history_missing"), (4, "history_missing"), (4, "versions_missing"), (5, "history_missing"), (5, "versions_missing")]


def test_unknown_references(spark, folder):
    got = {(r.rule, r.key, r.kind) for r in rules.unknown_references(spark, folder).collect()}
    assert {g for g in got if g[0].startswith(("page", "candidate"))} == {("page_edition", "P2", "missing"), ("page_edition", None, "absent"), ("candidate_position", "b", "missing"), ("candidate_position", "c", "absent"), ("candidate_run", "b", "missing"), ("candidate_run", "c", "missing")}
    assert {g for g in got if g[0].startswith("position")} == {("position_cell", "4", "missing"), ("position_cell", "5", "absent")}
    assert {g for g in got if g[0].startswith("cell")} == {("cell_page", "5", "missing"), ("cell_edition_page", "2", "missing"), ("cell_edition_page", "4", "absent")}


def test_provenance(spark, folder):
    assert found(rules.candidate_provenance(spark, folder), "run_id", "field", "n_candidates") == [("r1", "contract_version", 1), ("r1", "edition_id", 1), ("r1", "sample_limit", 1), ("r2", "manifest", 2)]


def test_large_tables_are_checked_for_repeats_in_the_same_way(spark, monkeypatch):
    small = [rows(q(spark, FOLDER)) for q in (rules.dup_keys, rules.dup_occurrences, rules.geometry_duplicates)]
    monkeypatch.setattr(validate, "HOT_ROWS", 0)
    monkeypatch.setattr(sizing, "HOT_ROWS", 3)
    monkeypatch.setattr(sizing, "SMALL", 2)
    assert [rows(q(spark, FOLDER)) for q in (rules.dup_keys, rules.dup_occurrences, rules.geometry_duplicates)] == small


@pytest.mark.parametrize("name", ["match_topk", "version_rules", "mirror_mismatch", "unknown_references", "publish_records", "p3_found"])
def test_hot_keys_give_the_same(spark, monkeypatch, name):
    query = catalog.queries()[name]
    plain = rows(query(spark, FOLDER))
    monkeypatch.setattr(sizing, "HOT_ROWS", 3)
    monkeypatch.setattr(sizing, "SMALL", 2)
    assert rows(query(spark, FOLDER)) == plain
