"""Queries of the general data problems (2 and 3) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.operators import nested
from platemark.operators import references as refs
from platemark.sources.tables import table


def p2_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Flat rows of both tables, with the sides' values."""
    typed = nested.flatten_cells(table(spark, folder, "reference_cells"), "row_id").withColumn("table_name", F.lit("reference_cells"))
    raw = nested.flatten_payloads(table(spark, folder, "reference_cells_raw"), "raw_id", "payload").withColumn("table_name", F.lit("reference_cells_raw"))
    return typed.unionByName(raw).select("table_name", "record_id", "cell_no", "child", "child_no", "label", "value")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_flat(spark, folder).drop("value")


def p2_box_sides(spark: SparkSession, folder: str) -> DataFrame:
    """Sides of typed cells, linked to their cell, with their values."""
    flat = nested.flatten_cells(table(spark, folder, "reference_cells"), "row_id")
    return flat.filter(F.col("child").isin("margin", "padding")).select("record_id", F.col("child").alias("box"), F.col("label").alias("side"), "value")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda name: table(spark, folder, name)
    return refs.registry_failures(t("reference_cells"), t("reference_positions"), t("manual_pages"), t("manual_editions"))


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    """Failing references per table, field, kind and month."""
    return p3_found(spark, folder).groupBy("table_name", "ref_field", "kind", "month_key").agg(F.count(F.lit(1)).alias("n_rows"))


def p3_composite(spark: SparkSession, folder: str) -> DataFrame:
    """Cells whose (edition_id, page_number) is held against the pages with match partial: each null mask on the columns it has."""
    pages = table(spark, folder, "manual_pages")
    pair = refs.Reference("edition_page", ("edition_id", "page_number"), pages, ("edition_id", "page_number"), match="partial")
    cells = table(spark, folder, "reference_cells")
    return refs.failing_references(cells, "row_id", refs.utc_time("created_at"), [pair]).select("row_id", "ref_field", "kind")


CELL_KEY = ("edition_id", "page_id", "reference_cell_id")


def _cell_references(match: str):  # noqa: ANN202
    """Positions whose (edition_id, page_id, reference_cell_id) is held against the cells, by null mask."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        ref = refs.Reference("cell", CELL_KEY, table(spark, folder, "reference_cells"), CELL_KEY, match=match)
        found = refs.failing_references(table(spark, folder, "reference_positions"), "row_id", refs.utc_time("created_at"), [ref])
        return found.select("row_id", "ref_field", "kind")

    return query


p3_simple, p3_partial, p3_full = (_cell_references(m) for m in ("simple", "partial", "full"))


def _key(c: str) -> str:
    return f"nullif(lower(trim({c}, chr(32) || chr(9) || chr(10) || chr(13))), '')"


def _time(c: str) -> str:
    iso = f"regexp_replace(trim({c}), '([+-][0-9][0-9])([0-9][0-9])$', '\\1:\\2')"
    return f"CASE WHEN regexp_matches({iso}, '(Z|[+-][0-9][0-9]:[0-9][0-9])$') THEN CAST({iso} AS TIMESTAMPTZ) ELSE CAST({iso} || 'Z' AS TIMESTAMPTZ) END"


P2_SIDES_SQL = " UNION ALL ".join(
    f"SELECT row_id AS record_id, '{box}' AS box, '{side}' AS side, geometry.{box}.{side} AS value FROM reference_cells WHERE geometry.{box}.{side} IS NOT NULL"
    for box in nested.BOXES for side in nested.SIDES
)
_NUMERIC = nested.NUMERIC.pattern


def _strict(c: str) -> str:
    """Complete JSON by the strict grammar: neither stray commas nor words that aren't JSON, outside strings."""
    bare = f"regexp_replace({c}, '\"(?:[^\"\\\\]|\\\\.)*\"', '\"\"', 'g')"
    return f"json_valid({c}) AND NOT regexp_matches({bare}, '(?i)nan|inf|,\\s*[\\]}}]')"


def _member(of: str, path: str) -> str:
    """A member's text; '' where it is missing, null, an object or a list."""
    return f"CASE WHEN json_type({of}, '{path}') IN ('OBJECT', 'ARRAY') THEN '' ELSE coalesce(json_extract_string({of}, '{path}'), '') END"


_SIDES = ", ".join(f"({i}, '{side}')" for i, side in enumerate(nested.SIDES))
P2_SQL = f"""
WITH RECURSIVE quoted AS (
  SELECT raw_id, payload AS j FROM reference_cells_raw WHERE {_strict('payload')}
  UNION ALL
  SELECT raw_id, t FROM (SELECT raw_id, json_extract_string(j, '$') AS t FROM quoted WHERE json_type(j) = 'VARCHAR') AS u WHERE {_strict('t')}),
wrapped AS (
  SELECT raw_id, CAST(j AS JSON) AS v, '' AS name, 0 AS depth FROM quoted WHERE json_type(j) IN ('OBJECT', 'ARRAY')
  UNION ALL
  SELECT w.raw_id, e.value, e.key, w.depth + 1 FROM wrapped AS w, LATERAL (SELECT * FROM json_each(w.v)) AS e
  WHERE json_type(w.v) = 'OBJECT' AND json_type(e.value) IN ('OBJECT', 'ARRAY')),
listed AS (
  SELECT raw_id, v FROM (
    SELECT raw_id, v, row_number() OVER (PARTITION BY raw_id ORDER BY depth) AS n FROM wrapped
    WHERE json_type(v) = 'ARRAY' AND (depth = 0 OR name = 'cells')) AS l WHERE n = 1),
cell AS (
  SELECT raw_id, i AS cell_no, json_extract(v, '$[' || i || ']') AS c
  FROM (SELECT raw_id, v, unnest(range(CAST(json_array_length(v) AS BIGINT))) AS i FROM listed) AS l
  WHERE json_type(v, '$[' || i || ']') <> 'NULL'),
box AS (
  SELECT raw_id, cell_no, child, b FROM (
    SELECT raw_id, cell_no, 'margin' AS child, json_extract(c, '$.geometry.margin') AS b FROM cell
    UNION ALL SELECT raw_id, cell_no, 'padding', json_extract(c, '$.geometry.padding') FROM cell) AS t WHERE b IS NOT NULL),
side AS (
  SELECT raw_id, cell_no, child, s.name AS label,
         CASE json_type(b) WHEN 'OBJECT' THEN json_extract(b, '$.' || s.name) WHEN 'ARRAY' THEN json_extract(b, '$[' || s.i || ']') ELSE b END AS x
  FROM box, (VALUES {_SIDES}) AS s(i, name)),
history AS (SELECT raw_id, cell_no, json_extract(c, '$.provenance.history') AS h FROM cell),
entry AS (
  SELECT raw_id, cell_no, i AS child_no, json_extract(h, '$[' || i || ']') AS e
  FROM (SELECT raw_id, cell_no, h, unnest(range(CAST(json_array_length(h) AS BIGINT))) AS i FROM history WHERE json_type(h) = 'ARRAY') AS l
  UNION ALL SELECT raw_id, cell_no, 0, h FROM history WHERE json_type(h) <> 'ARRAY'),
typed_entry AS (
  SELECT row_id, i AS child_no, provenance.history[i + 1] AS e
  FROM (SELECT row_id, provenance, unnest(range(len(provenance.history))) AS i FROM reference_cells) AS l),
flat AS (
  SELECT 'reference_cells_raw' AS table_name, raw_id AS record_id, cell_no, 'cell' AS child, 0 AS child_no, {_member('c', '$.approval_state')} AS label, CAST(NULL AS DOUBLE) AS value FROM cell
  UNION ALL SELECT 'reference_cells_raw', raw_id, cell_no, child, 0, label, CAST(trim(json_extract_string(x, '$')) AS DOUBLE) FROM side
    WHERE json_type(x) NOT IN ('OBJECT', 'ARRAY', 'NULL', 'BOOLEAN') AND regexp_full_match(trim(json_extract_string(x, '$')), '{_NUMERIC}')
  UNION ALL SELECT 'reference_cells_raw', raw_id, cell_no, 'history', child_no, {_member('e', '$.event_type')}, NULL FROM entry WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT 'reference_cells', row_id, 0, 'cell', 0, coalesce(approval_state, ''), NULL FROM reference_cells
  {' '.join(f"UNION ALL SELECT 'reference_cells', row_id, 0, '{box}', 0, '{side}', geometry.{box}.{side} FROM reference_cells WHERE geometry.{box}.{side} IS NOT NULL AND NOT isnan(geometry.{box}.{side})" for box in nested.BOXES for side in nested.SIDES)}
  UNION ALL SELECT 'reference_cells', row_id, 0, 'history', child_no, coalesce(e.event_type, ''), NULL FROM typed_entry WHERE e IS NOT NULL)
SELECT table_name, record_id, CAST(cell_no AS INTEGER) AS cell_no, child, CAST(child_no AS INTEGER) AS child_no, label"""
P2_FOUND_SQL, P2_FLAT_SQL = f"{P2_SQL} FROM flat", f"{P2_SQL}, value FROM flat"
P3_BASE = f"""
WITH page AS (SELECT {_key('page_id')} AS k, min({_time('created_at')}) AS born, min(CASE WHEN deleted_at IS NULL THEN 0 ELSE 1 END) AS gone FROM manual_pages GROUP BY 1),
edition AS (SELECT {_key('edition_id')} AS k, min({_time('created_at')}) AS born, min(CASE WHEN deleted_at IS NULL THEN 0 ELSE 1 END) AS gone FROM manual_editions GROUP BY 1),
cell AS (SELECT {_key('reference_cell_id')} AS k, min({_time('created_at')}) AS born, min(CASE WHEN archived THEN 1 ELSE 0 END) AS gone FROM reference_cells WHERE {_key('reference_cell_id')} IS NOT NULL GROUP BY 1),
ref AS (
  SELECT 'reference_cells' AS table_name, row_id, 'page_id' AS ref_field, {_key('page_id')} AS k, {_time('created_at')} AS made FROM reference_cells
  UNION ALL SELECT 'reference_cells', row_id, 'edition_id', {_key('edition_id')}, {_time('created_at')} FROM reference_cells
  UNION ALL SELECT 'reference_positions', row_id, 'reference_cell_id', {_key('reference_cell_id')}, {_time('created_at')} FROM reference_positions),
target AS (SELECT 'page_id' AS f, * FROM page UNION ALL SELECT 'edition_id', * FROM edition UNION ALL SELECT 'reference_cell_id', * FROM cell),
held AS (
  SELECT r.table_name, r.row_id, r.ref_field,
         CASE WHEN t.k IS NULL THEN 'missing' WHEN t.gone = 1 THEN 'deleted' WHEN t.born > r.made THEN 'late' END AS kind,
         strftime(r.made AT TIME ZONE 'UTC', '%Y-%m') AS month_key
  FROM ref AS r LEFT JOIN target AS t ON t.f = r.ref_field AND t.k = r.k WHERE r.k IS NOT NULL)
"""
P3_SQL = P3_BASE + "SELECT table_name, row_id, ref_field, kind, month_key FROM held WHERE kind IS NOT NULL"
P3_REPORT_SQL = P3_BASE + "SELECT table_name, ref_field, kind, month_key, count(*) AS n_rows FROM held WHERE kind IS NOT NULL GROUP BY 1, 2, 3, 4"
P3_COMPOSITE_SQL = f"""
WITH c AS (SELECT row_id, {_key('edition_id')} AS e, page_number AS p FROM reference_cells),
g AS (SELECT DISTINCT {_key('edition_id')} AS e, page_number AS p FROM manual_pages)
SELECT row_id, 'edition_page' AS ref_field, 'missing' AS kind FROM c
WHERE (e IS NOT NULL OR p IS NOT NULL)
  AND NOT EXISTS (SELECT 1 FROM g WHERE (c.e IS NULL OR g.e = c.e) AND (c.p IS NULL OR g.p = c.p))
"""
_P = ("e", "p", "c")
_CELL_KEYS = ", ".join(f"{_key(c)} AS {a}" for c, a in zip(CELL_KEY, _P, strict=True))
_NULLS = " + ".join(f"(CASE WHEN x.{a} IS NULL THEN 1 ELSE 0 END)" for a in _P)
_UNMET = f"NOT EXISTS (SELECT 1 FROM k WHERE {' AND '.join(f'(x.{a} IS NULL OR k.{a} = x.{a})' for a in _P)})"


def _cell_sql(kind: str, broken: str) -> str:
    return f"""WITH x AS (SELECT row_id, {_CELL_KEYS} FROM reference_positions), k AS (SELECT DISTINCT {_CELL_KEYS} FROM reference_cells)
SELECT row_id, 'cell' AS ref_field, {kind} AS kind FROM x WHERE {broken}"""


P3_SIMPLE_SQL = _cell_sql("'missing'", f"{_NULLS} = 0 AND {_UNMET}")
P3_PARTIAL_SQL = _cell_sql("'missing'", f"{_NULLS} < 3 AND {_UNMET}")
P3_FULL_SQL = _cell_sql(f"CASE WHEN {_NULLS} > 0 THEN 'partial_key' ELSE 'missing' END", f"{_NULLS} < 3 AND ({_NULLS} > 0 OR {_UNMET})")


def queries() -> dict:
    return {"p3_simple": p3_simple, "p3_partial": p3_partial, "p3_full": p3_full, "p2_found": p2_found, "p2_flat": p2_flat, "p2_box_sides": p2_box_sides, "p3_found": p3_found, "p3_report": p3_report, "p3_composite": p3_composite}


def oracle_sql() -> dict[str, str]:
    return {"p3_simple": P3_SIMPLE_SQL, "p3_partial": P3_PARTIAL_SQL, "p3_full": P3_FULL_SQL, "p2_found": P2_FOUND_SQL, "p2_flat": P2_FLAT_SQL, "p2_box_sides": P2_SIDES_SQL, "p3_found": P3_SQL, "p3_report": P3_REPORT_SQL, "p3_composite": P3_COMPOSITE_SQL}
