"""Integrity rules over the registry: each query gives findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.operators import validate as v
from platemark.operators.merge import usable_code
from platemark.operators.references import Reference, failing_references, norm_key
from platemark.operators.sizing import lookup, small_or_shuffled
from platemark.plans.box_queries import APPROVED
from platemark.sources.tables import table

# Allowed values and patterns (fixed values).
REFERENCE_STATUS = ["draft", "verified", "disputed", "deprecated"]
APPROVAL_STATE = ["draft", "in_review", "approved", "deprecated", "archived"]
VALIDATION_STATUS = ["pending", "reviewed", "valid", "invalid"]
CATEGORY = ["regulatory", "warning", "guidance", "information", "temporary", "miscellaneous"]
HEX64 = "^[0-9a-f]{64}$"
CODE = "^[A-Z]{1,4}[0-9]{1,3}([.][0-9]{1,2})?$"
CELL_ID = "^RC-[0-9]{6}$"
POSITION_ID = "^RP-[0-9]{6}$"


def _not_in(column: str, values: list[str]) -> str:
    return f"{column} IS NULL OR {column} NOT IN ({', '.join(repr(x) for x in values)})"


def _not_like(column: str, pattern: str) -> str:
    return f"{column} IS NULL OR NOT MATCHES({column}, '{pattern}')"


def _outside(*columns: str) -> str:
    return " OR ".join(f"{c} IS NULL OR {c} < 0 OR {c} > 1" for c in columns)


_CELL, _POSITION = "geometry.norm_{}", "norm_{}"
RULES = [
    v.Rule("edition_id_missing", "manual_editions", "edition_id", "edition_id IS NULL OR edition_id = ''"),
    v.Rule("edition_sha", "manual_editions", "edition_id", _not_like("source_pdf_sha256", HEX64)),
    v.Rule("page_number", "manual_pages", "page_id", "page_number IS NULL OR page_number < 1"),
    v.Rule("page_sha", "manual_pages", "page_id", _not_like("page_image_sha256", HEX64)),
    v.Rule("cell_id", "reference_cells", "row_id", _not_like("reference_cell_id", CELL_ID)),
    v.Rule("cell_geometry", "reference_cells", "row_id", _outside(*[_CELL.format(c) for c in ("x", "y", "w", "h", "cx", "cy")]) + " OR geometry.rotation_deg IS NULL"),
    v.Rule("cell_bounds", "reference_cells", "row_id", "geometry.norm_x + geometry.norm_w > 1 OR geometry.norm_y + geometry.norm_h > 1"),
    v.Rule("cell_provenance", "reference_cells", "row_id", " OR ".join(f"provenance.{c} IS NULL" for c in ("creation_timestamp", "authoring_method", "pipeline_version", "manual_edition", "source_page", "validation_state", "approval_state"))),
    v.Rule("position_id", "reference_positions", "row_id", _not_like("reference_position_id", POSITION_ID)),
    v.Rule("position_code", "reference_positions", "row_id", f"official_code IS NOT NULL AND official_code <> '' AND NOT MATCHES(official_code, '{CODE}')"),
    v.Rule("position_description", "reference_positions", "row_id", "official_code <> '' AND (official_description IS NULL OR official_description = '')"),
    v.Rule("position_category", "reference_positions", "row_id", _not_in("category", CATEGORY)),
    v.Rule("reference_status", "reference_positions", "row_id", _not_in("reference_status", REFERENCE_STATUS)),
    v.Rule("approval_state", "reference_positions", "row_id", _not_in("approval_state", APPROVAL_STATE)),
    v.Rule("validation_status", "reference_positions", "row_id", _not_in("validation_status", VALIDATION_STATUS)),
    v.Rule("position_version", "reference_positions", "row_id", "current_version IS NULL OR current_version < 1"),
    v.Rule("position_geometry", "reference_positions", "row_id", _outside(*[_POSITION.format(c) for c in "xywh"])),
    v.Rule("position_bounds", "reference_positions", "row_id", "norm_x + norm_w > 1 OR norm_y + norm_h > 1"),
    v.Rule("position_confidence", "reference_positions", "row_id", _outside("confidence")),
    v.Rule("sign_confidence", "page_4_signs", "row_id", "confidence IS NULL OR confidence < 0 OR confidence > 100"),
    v.Rule("match_score", "candidate_assignments", "candidate_assignment_id", "match_score < 0 OR match_score > 1"),
    v.Rule("geometry_keys", "candidate_assignments", "candidate_assignment_id", " OR ".join(f"geometry_agreement.{c} IS NULL" for c in ("iou", "center_distance", "center_score", "area_ratio", "geometry_score"))),
    v.Rule("geometry_range", "candidate_assignments", "candidate_assignment_id", " OR ".join(f"geometry_agreement.{c} < 0 OR geometry_agreement.{c} > 1" for c in ("iou", "center_score", "area_ratio"))),
    v.Rule("text_agreement", "candidate_assignments", "candidate_assignment_id", _not_in("ocr_agreement.agreement", ["consistent", "inconsistent", "unavailable"])),
    v.Rule("candidate_status", "candidate_assignments", "candidate_assignment_id", "status IS NULL OR status <> 'candidate'"),
]

#: rule, table, key, columns that must be unique together, place.
UNIQUE = [
    ("edition_duplicate", "manual_editions", "edition_id", ["edition_id"], "edition_id"),
    ("page_duplicate", "manual_pages", "page_id", ["edition_id", "page_number"], "page_id"),
    ("cell_duplicate", "reference_cells", "row_id", ["reference_cell_id"], "row_id"),
    ("cell_grid_duplicate", "reference_cells", "row_id", ["edition_id", "page_id", "grid_row", "grid_col"], "row_id"),
    ("position_duplicate", "reference_positions", "row_id", ["reference_position_id"], "row_id"),
    ("position_grid_duplicate", "reference_positions", "row_id", ["edition_id", "page_id", "grid_row", "grid_col"], "row_id"),
    ("candidate_duplicate", "candidate_assignments", "candidate_assignment_id", ["candidate_assignment_id"], "ingested_at"),
]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def findings_report(spark: SparkSession, folder: str) -> DataFrame:
    """All findings of the row rules, each table's rules over one read of it."""
    parts = []
    for name in dict.fromkeys(r.table for r in RULES):
        rules = [r for r in RULES if r.table == name]
        hits = F.filter(F.array(*[F.when(F.expr(r.sql("regexp_like")), r.rule) for r in rules]), lambda x: x.isNotNull())
        parts.append(table(spark, folder, name).select(F.explode(hits).alias("rule"), F.lit(name).alias("entity"), F.col(rules[0].key).cast("string").alias("key")))
    return _union(parts)


FINDINGS_SQL = " UNION ALL ".join(f"SELECT '{r.rule}' AS rule, '{r.table}' AS entity, CAST({r.key} AS VARCHAR) AS key FROM {r.table} WHERE {r.sql('regexp_matches')}" for r in RULES)


def findings_summary(spark: SparkSession, folder: str) -> DataFrame:
    return findings_report(spark, folder).groupBy("entity", "rule").agg(F.count(F.lit(1)).alias("n_findings"))


def _rules(prefixes: tuple[str, ...]) -> list[v.Rule]:
    return [r for r in RULES if r.rule in prefixes]


def _some(rules: tuple[str, ...]):  # noqa: ANN202
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _union([v.broken(table(spark, folder, r.table), r) for r in _rules(rules)])

    sql = " UNION ALL ".join(f"SELECT '{r.rule}' AS rule, '{r.table}' AS entity, CAST({r.key} AS VARCHAR) AS key FROM {r.table} WHERE {r.sql('regexp_matches')}" for r in _rules(rules))
    return query, sql


enum_violations, ENUM_SQL = _some(("position_category", "reference_status", "approval_state", "validation_status", "text_agreement", "candidate_status"))
range_violations, RANGE_SQL = _some(("cell_geometry", "cell_bounds", "position_geometry", "position_bounds", "match_score", "geometry_range", "page_number", "position_confidence", "sign_confidence"))
regex_violations, REGEX_SQL = _some(("edition_sha", "page_sha", "cell_id", "position_id", "position_code"))


def dup_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A finding for each extra occurrence of a key; candidates delivered at one time count as one occurrence, in ``dup_occurrences`` each for itself."""
    return _union([v.extra_occurrences(table(spark, folder, t), rule, t, key, columns, row) for rule, t, key, columns, row in UNIQUE])


def dup_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    """A finding for each extra occurrence of a key, also of rows delivered at one time."""
    return _union([v.repeated_occurrences(table(spark, folder, t), rule, t, key, columns, row) for rule, t, key, columns, row in UNIQUE])


DUP_OCCURRENCES_SQL = " UNION ALL ".join(
    f"""SELECT '{rule}' AS rule, '{t}' AS entity, CAST({key} AS VARCHAR) AS key FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(columns)} ORDER BY {row} NULLS FIRST, CAST({key} AS VARCHAR) NULLS FIRST) AS occurrence FROM {t}
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in columns)}) AS d{i} WHERE occurrence > 1"""
    for i, (rule, t, key, columns, row) in enumerate(UNIQUE)
)
DUP_KEYS_SQL = " UNION ALL ".join(
    f"""SELECT '{rule}' AS rule, '{t}' AS entity, CAST({key} AS VARCHAR) AS key FROM (SELECT *, min({row}) OVER (PARTITION BY {', '.join(columns)}) AS first_row FROM {t}
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in columns)}) AS d{i} WHERE {row} > first_row"""
    for i, (rule, t, key, columns, row) in enumerate(UNIQUE)
)


def geometry_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of one page with the same box to six decimals, and crops of one page with the same box, but the first."""
    r6 = lambda c: F.floor(F.col(f"geometry.norm_{c}") * 1000000.0 + 0.5).alias(f"g{c}")
    cells = table(spark, folder, "reference_cells").select("row_id", "page_id", *[r6(c) for c in "xywh"])
    crops = v.extra_occurrences(table(spark, folder, "page_4_signs"), "crop_geometry_duplicate", "page_4_signs", "row_id", ["page", "x", "y", "w", "h"], "row_id")
    return v.extra_occurrences(cells, "cell_geometry_duplicate", "reference_cells", "row_id", ["page_id", "gx", "gy", "gw", "gh"], "row_id").unionByName(crops)


GEOMETRY_SQL = """SELECT 'crop_geometry_duplicate' AS rule, 'page_4_signs' AS entity, CAST(row_id AS VARCHAR) AS key FROM (
  SELECT row_id, min(row_id) OVER (PARTITION BY page, x, y, w, h) AS first_row FROM page_4_signs WHERE page + x + y + w + h IS NOT NULL) AS s WHERE row_id > first_row
UNION ALL SELECT 'cell_geometry_duplicate' AS rule, 'reference_cells' AS entity, CAST(row_id AS VARCHAR) AS key FROM (
  SELECT row_id, min(row_id) OVER (PARTITION BY page_id, gx, gy, gw, gh) AS first_row FROM (
    SELECT row_id, page_id, floor(geometry.norm_x * 1000000.0 + 0.5) AS gx, floor(geometry.norm_y * 1000000.0 + 0.5) AS gy, floor(geometry.norm_w * 1000000.0 + 0.5) AS gw, floor(geometry.norm_h * 1000000.0 + 0.5) AS gh
    FROM reference_cells WHERE page_id IS NOT NULL) AS g WHERE gx IS NOT NULL AND gy IS NOT NULL AND gw IS NOT NULL AND gh IS NOT NULL) AS d WHERE row_id > first_row"""

# Required fields (fixed values).
FIELDS = ["reference_position_id", "edition_id", "page_id", "reference_cell_id", "official_code", "official_description", "category", "reference_status", "validation_status", "approval_state"]


def missing_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Positions' required fields that are null or ''."""
    return v.missing_fields(table(spark, folder, "reference_positions"), "row_id", FIELDS)


MISSING_SQL = " UNION ALL ".join(f"SELECT row_id AS key, '{c}' AS field FROM reference_positions WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = ''" for c in FIELDS)


def empty_history(spark: SparkSession, folder: str) -> DataFrame:
    """Cells with no entry in their history."""
    c = table(spark, folder, "reference_cells")
    return c.filter(F.coalesce(F.size(F.filter("provenance.history", lambda e: e.isNotNull())), F.lit(0)) <= 0).select("row_id")


EMPTY_HISTORY_SQL = "SELECT row_id FROM reference_cells WHERE coalesce(len(list_filter(provenance.history, lambda e: e IS NOT NULL)), 0) = 0"


def orphan_parents(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that no position refers to."""
    cells = table(spark, folder, "reference_cells").select(norm_key("reference_cell_id").alias("cell")).dropna().distinct()
    used = table(spark, folder, "reference_positions").select(norm_key("reference_cell_id").alias("cell")).dropna().distinct()
    return cells.join(used, "cell", "left_anti")


_K = "nullif(lower(trim({}, chr(32) || chr(9) || chr(10))), '')"
ORPHAN_SQL = f"""SELECT DISTINCT cell FROM (SELECT {_K.format('reference_cell_id')} AS cell FROM reference_cells) AS c
WHERE cell IS NOT NULL AND cell NOT IN (SELECT k FROM (SELECT {_K.format('reference_cell_id')} AS k FROM reference_positions) AS p WHERE k IS NOT NULL)"""


def mirror_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    """Positions whose grid place or box differs from that of their cell (the first row of its id)."""
    r6 = lambda c: F.floor(c * 1000000.0 + 0.5)
    cells = table(spark, folder, "reference_cells").withColumn("cell", norm_key("reference_cell_id")).filter("cell IS NOT NULL")
    fields = ["grid_row", "grid_col", "norm_x", "norm_y", "norm_w", "norm_h"]
    side = lambda c: F.col(c) if c.startswith("grid") else r6(F.col(f"geometry.{c}"))
    first = cells.groupBy("cell").agg(F.min_by(F.struct(*[side(c).alias(f"c_{c}") for c in fields]), "row_id").alias("f")).select("cell", "f.*")
    own = lambda c: F.col(c) if c.startswith("grid") else r6(F.col(c))
    positions = table(spark, folder, "reference_positions").withColumn("cell", norm_key("reference_cell_id")).filter("cell IS NOT NULL").select("row_id", "cell", *[own(c).alias(c) for c in fields])
    joined = lookup(positions, first.withColumn("there", F.lit(True)), ["cell"], spread_by="row_id").filter("there")
    differs = F.filter(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"c_{c}")), c) for c in fields]), lambda x: x.isNotNull())
    return joined.select("row_id", F.explode(differs).alias("field"))


_F6 = lambda c: f"floor({c} * 1000000.0 + 0.5)"
MIRROR_SQL = f"""WITH c AS (SELECT * FROM (SELECT {_K.format('reference_cell_id')} AS cell, grid_row, grid_col, {_F6('geometry.norm_x')} AS norm_x, {_F6('geometry.norm_y')} AS norm_y, {_F6('geometry.norm_w')} AS norm_w, {_F6('geometry.norm_h')} AS norm_h,
  row_number() OVER (PARTITION BY {_K.format('reference_cell_id')} ORDER BY row_id) AS n FROM reference_cells) AS x WHERE n = 1 AND cell IS NOT NULL),
p AS (SELECT row_id, {_K.format('reference_cell_id')} AS cell, grid_row, grid_col, {_F6('norm_x')} AS norm_x, {_F6('norm_y')} AS norm_y, {_F6('norm_w')} AS norm_w, {_F6('norm_h')} AS norm_h FROM reference_positions)
""" + " UNION ALL ".join(f"SELECT p.row_id, '{f}' AS field FROM p JOIN c ON c.cell = p.cell WHERE p.{f} IS DISTINCT FROM c.{f}" for f in ("grid_row", "grid_col", "norm_x", "norm_y", "norm_w", "norm_h"))


def page_number_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    """Cells whose page number is not that of their page, and crops whose page is not that in their filename."""
    pages = table(spark, folder, "manual_pages").select(norm_key("page_id").alias("page"), F.col("page_number").alias("should_be"))
    cells = table(spark, folder, "reference_cells").select("row_id", norm_key("page_id").alias("page"), "page_number")
    of_cells = cells.join(small_or_shuffled(pages), "page").withColumn("entity", F.lit("reference_cells"))
    named = F.nullif(F.regexp_extract(F.lower("filename"), PAGE_OF_FILE, 1), F.lit("")).try_cast("int")
    crops = table(spark, folder, "page_4_signs").select("row_id", F.col("page").alias("page_number"), named.alias("should_be"))
    of_crops = crops.filter("should_be IS NOT NULL").withColumn("entity", F.lit("page_4_signs"))
    wrong = of_cells.drop("page").unionByName(of_crops)
    return wrong.filter(~F.col("page_number").eqNullSafe(F.col("should_be"))).select("entity", "row_id", "page_number", "should_be")


PAGE_OF_FILE = "^page[ _-]*([0-9]+)"
PAGE_NUMBER_SQL = f"""SELECT 'reference_cells' AS entity, c.row_id, c.page_number, p.page_number AS should_be FROM (SELECT row_id, page_number, {_K.format('page_id')} AS page FROM reference_cells) AS c
JOIN (SELECT page_number, {_K.format('page_id')} AS page FROM manual_pages) AS p ON p.page = c.page WHERE c.page_number IS DISTINCT FROM p.page_number
UNION ALL SELECT 'page_4_signs', row_id, page, n FROM (SELECT row_id, page, TRY_CAST(nullif(regexp_extract(lower(filename), '{PAGE_OF_FILE}', 1), '') AS INTEGER) AS n FROM page_4_signs) AS s
WHERE n IS NOT NULL AND page IS DISTINCT FROM n"""

#: rule, table, key of its rows, referring columns, table and columns referred to.
REFERENCES = [
    ("page_edition", "manual_pages", "page_id", ["edition_id"], "manual_editions", ["edition_id"]),
    ("cell_edition", "reference_cells", "row_id", ["edition_id"], "manual_editions", ["edition_id"]),
    ("cell_page", "reference_cells", "row_id", ["page_id"], "manual_pages", ["page_id"]),
    ("cell_edition_page", "reference_cells", "row_id", ["edition_id", "page_number"], "manual_pages", ["edition_id", "page_number"]),
    ("position_edition", "reference_positions", "row_id", ["edition_id"], "manual_editions", ["edition_id"]),
    ("position_page", "reference_positions", "row_id", ["page_id"], "manual_pages", ["page_id"]),
    ("position_edition_page", "reference_positions", "row_id", ["edition_id", "page_number"], "manual_pages", ["edition_id", "page_number"]),
    ("position_cell", "reference_positions", "row_id", ["reference_cell_id"], "reference_cells", ["reference_cell_id"]),
    ("candidate_position", "candidate_assignments", "candidate_assignment_id", ["reference_position_id"], "reference_positions", ["reference_position_id"]),
    ("candidate_run", "candidate_assignments", "candidate_assignment_id", ["run_id"], "reference_matcher_run_manifest", ["run_id"]),
]


def unknown_references(spark: SparkSession, folder: str) -> DataFrame:
    """Every reference of the registry that is not there (absent) or leads nowhere (missing); one read of each table for all its small parents."""
    parts = []
    for name in dict.fromkeys(child for _, child, *_ in REFERENCES):
        mine = [r for r in REFERENCES if r[1] == name]
        rows, key = table(spark, folder, name), mine[0][2]
        found = failing_references(rows, key, F.lit(None).cast("timestamp"), [Reference(rule, tuple(cols), table(spark, folder, to), tuple(to_cols)) for rule, _, _, cols, to, to_cols in mine])
        parts.append(found.select(F.col("ref_field").alias("rule"), F.lit(name).alias("entity"), F.col("row_id").cast("string").alias("key"), "kind"))
        absent = F.filter(F.array(*[F.when(reduce(lambda a, b: a | b, [norm_key(c).isNull() for c in cols]), rule) for rule, _, _, cols, _, _ in mine]), lambda x: x.isNotNull())
        parts.append(rows.select(F.explode(absent).alias("rule"), F.lit(name).alias("entity"), F.col(key).cast("string").alias("key"), F.lit("absent").alias("kind")))
    return _union(parts)


def _key_of(c: str) -> str:
    return _K.format(f"CAST({c} AS VARCHAR)")


UNKNOWN_REFERENCES_SQL = " UNION ALL ".join(
    f"""SELECT '{rule}' AS rule, '{child}' AS entity, CAST(row AS VARCHAR) AS key, CASE WHEN {' OR '.join(f'k{i} IS NULL' for i in range(len(cols)))} THEN 'absent' ELSE 'missing' END AS kind
FROM (SELECT {key} AS row, {', '.join(f'{_key_of(c)} AS k{i}' for i, c in enumerate(cols))} FROM {child}) AS c{n}
WHERE NOT EXISTS (SELECT 1 FROM (SELECT {', '.join(f'{_key_of(c)} AS p{i}' for i, c in enumerate(to_cols))} FROM {to}) AS p WHERE {' AND '.join(f'p{i} = k{i}' for i in range(len(cols)))})"""
    for n, (rule, child, key, cols, to, to_cols) in enumerate(REFERENCES)
)


def version_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Positions without versions, with another number of them than ``current_version`` says, or without history: rows and history entries of their cell."""
    entries = F.coalesce(F.size(F.filter("provenance.history", lambda e: e.isNotNull())), F.lit(0))
    cells = table(spark, folder, "reference_cells").select(norm_key("reference_cell_id").alias("cell"), F.greatest(entries, F.lit(0)).alias("entries")).filter("cell IS NOT NULL")
    cells = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("versions"), F.sum("entries").alias("history"))
    positions = table(spark, folder, "reference_positions").select("row_id", norm_key("reference_cell_id").alias("cell"), "current_version")
    held = lookup(positions, cells, ["cell"], spread_by="row_id")
    rules = F.array(
        F.when(F.col("versions").isNull(), "versions_missing"),
        F.when(F.col("versions").isNotNull() & ~F.col("versions").eqNullSafe(F.col("current_version").cast("bigint")), "version_mismatch"),
        F.when(F.coalesce("history", F.lit(0)) == 0, "history_missing"),
    )
    return held.select("row_id", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("rule"))


VERSION_RULES_SQL = f"""WITH c AS (SELECT cell, count(*) AS versions, sum(entries) AS history FROM (SELECT {_K.format('reference_cell_id')} AS cell,
    coalesce(len(list_filter(provenance.history, lambda e: e IS NOT NULL)), 0) AS entries FROM reference_cells) AS x WHERE cell IS NOT NULL GROUP BY cell),
h AS (SELECT p.row_id, p.current_version, c.versions, c.history FROM (SELECT row_id, current_version, {_K.format('reference_cell_id')} AS cell FROM reference_positions) AS p LEFT JOIN c ON c.cell = p.cell)
SELECT row_id, 'versions_missing' AS rule FROM h WHERE versions IS NULL
UNION ALL SELECT row_id, 'version_mismatch' FROM h WHERE versions IS NOT NULL AND versions IS DISTINCT FROM current_version
UNION ALL SELECT row_id, 'history_missing' FROM h WHERE coalesce(history, 0) = 0"""


def candidate_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """What is not known about the runs of candidates: (run_id, field, n_candidates); field 'manifest' where a run has none."""
    said = {f: F.max(F.nullif(F.trim(F.col(f).cast("string")), F.lit(""))).alias(f"m{i}") for i, f in enumerate(PROVENANCE)}
    runs = table(spark, folder, "reference_matcher_run_manifest").filter("run_id IS NOT NULL").groupBy("run_id").agg(*said.values(), F.lit(True).alias("there"))
    counts = table(spark, folder, "candidate_assignments").groupBy("run_id").agg(F.count(F.lit(1)).alias("n_candidates"))
    lacks = F.array(F.when(F.col("there").isNull(), "manifest"), *[F.when(F.col("there") & F.col(f"m{i}").isNull(), f) for i, f in enumerate(PROVENANCE)])
    return counts.join(runs, "run_id", "left").select("run_id", F.explode(F.filter(lacks, lambda x: x.isNotNull())).alias("field"), "n_candidates")


# Where a run says its candidates come from (fixed values).
PROVENANCE = ["matcher_version", "contract_version", "run_at", "edition_id", "sample_limit", "top_k", "inputs.reference_positions", "inputs.reference_cells", "output_file"]
_SAID = ", ".join(f"max(nullif(trim(CAST({f} AS VARCHAR)), '')) AS m{i}" for i, f in enumerate(PROVENANCE))
CANDIDATE_PROVENANCE_SQL = f"""WITH m AS (SELECT run_id, {_SAID} FROM reference_matcher_run_manifest WHERE run_id IS NOT NULL GROUP BY run_id),
c AS (SELECT run_id, count(*) AS n_candidates FROM candidate_assignments GROUP BY run_id)
SELECT c.run_id, 'manifest' AS field, c.n_candidates FROM c LEFT JOIN m ON m.run_id = c.run_id WHERE m.run_id IS NULL
""" + " ".join(f"UNION ALL SELECT c.run_id, '{f}', c.n_candidates FROM c JOIN m ON m.run_id = c.run_id WHERE m.m{i} IS NULL" for i, f in enumerate(PROVENANCE))


def unapproved_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """References of candidates that are not approved, with the number of their candidates."""
    used = table(spark, folder, "candidate_assignments").groupBy("reference_position_id").agg(F.count(F.lit(1)).alias("n_candidates"))
    approved = table(spark, folder, "reference_positions").filter(APPROVED).select("reference_position_id")
    return used.join(approved, "reference_position_id", "left_anti")


UNAPPROVED_SQL = f"""SELECT reference_position_id, count(*) AS n_candidates FROM candidate_assignments WHERE reference_position_id IS NULL OR reference_position_id NOT IN (SELECT reference_position_id FROM reference_positions WHERE {APPROVED}) GROUP BY reference_position_id"""


def code_not_in_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Usable codes of mappings that the legend lacks; none if the legend is empty."""
    legend = table(spark, folder, "sign_legend").select("code").filter("code IS NOT NULL").distinct()
    codes = table(spark, folder, "sign_mappings_clean").filter(usable_code(F.col("code"))).groupBy(F.trim("code").alias("code")).agg(F.count(F.lit(1)).alias("n_rows"))
    some = legend.agg((F.count(F.lit(1)) > 0).alias("some"))
    return codes.join(legend, "code", "left_anti").crossJoin(F.broadcast(some)).filter("some").drop("some")


NOT_IN_SQL = """SELECT trim(code) AS code, count(*) AS n_rows FROM sign_mappings_clean WHERE trim(code) <> '' AND NOT starts_with(upper(trim(code)), 'UNKNOWN')
  AND trim(code) NOT IN (SELECT code FROM sign_legend WHERE code IS NOT NULL) AND EXISTS (SELECT 1 FROM sign_legend WHERE code IS NOT NULL) GROUP BY 1"""


def ordering_check(spark: SparkSession, folder: str) -> DataFrame:
    """Positions, in stored order within their edition, that come before their predecessor in page, row and column."""
    p = table(spark, folder, "reference_positions").filter("page_number + grid_row + grid_col IS NOT NULL")
    return v.unordered(p, "row_id", ["page_number", "grid_row", "grid_col"], "edition_id").select("row_id")


ORDERING_SQL = """SELECT row_id FROM (SELECT row_id, page_number AS a, grid_row AS b, grid_col AS c, lag(page_number) OVER w AS pa, lag(grid_row) OVER w AS pb, lag(grid_col) OVER w AS pc
  FROM reference_positions WHERE page_number + grid_row + grid_col IS NOT NULL WINDOW w AS (PARTITION BY edition_id ORDER BY row_id)) AS o
WHERE pa IS NOT NULL AND (a < pa OR (a = pa AND (b < pb OR (b = pb AND c < pc))))"""

# Required fields of the stored documents and their records (fixed values).
REQUIRED = {
    "manual_editions": ["edition_id", "source_pdf_path", "source_pdf_filename", "source_pdf_sha256", "publication_date", "status", "created_at", "model_version"],
    "manual_pages": ["page_id", "edition_id", "page_number", "image_width", "image_height", "page_image_path", "page_image_sha256", "render_dpi", "normalization_profile", "created_at"],
    "reference_cells": ["reference_cell_id", "edition_id", "page_id", "page_number", "grid_row", "grid_col", "geometry", "cell_status", "approval_state", "created_at", "updated_at", "provenance", "archived"],
    "reference_positions": [
        "reference_position_id", "edition_id", "page_id", "page_number", "reference_cell_id", "grid_row", "grid_col", "norm_x", "norm_y", "norm_w", "norm_h", "official_code", "official_description", "category",
        "reference_status", "validation_status", "approval_state", "authoring_method", "pipeline_version", "manual_edition", "source_page", "created_at", "updated_at", "current_version", "versions", "history", "archived",
    ],
    "candidate_assignments": ["candidate_assignment_id", "reference_position_id", "extracted_sign_id", "match_score", "geometry_agreement", "ocr_agreement", "provenance", "validation_status", "review_status", "confidence", "audit"],
    "reference_matcher_run_manifest": ["contract_version", "matcher_version", "run_type", "edition_id", "run_at", "sample_limit", "top_k", "inputs", "summary", "candidates"],
}
#: Of those, the fields that the tables of TESTDATA.md don't have.
LACKING = {
    "reference_positions": ["authoring_method", "pipeline_version", "manual_edition", "source_page", "versions", "history"],
    "candidate_assignments": ["extracted_sign_id", "provenance", "validation_status", "review_status", "confidence", "audit"],
    "reference_matcher_run_manifest": ["summary", "candidates"],
}


def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    """(entity, field, in_schema, n_missing): rows without a value of each required field; one read of each table."""
    parts = []
    for name, required in REQUIRED.items():
        df = table(spark, folder, name)
        have = set(df.columns)
        absent = [F.sum(F.col(c).isNull().cast("bigint")) if c in have else F.count(F.lit(1)) for c in required]
        cells = [F.struct(F.lit(name).alias("entity"), F.lit(c).alias("field"), F.lit(c in have).alias("in_schema"), F.coalesce(n, F.lit(0)).alias("n_missing")) for c, n in zip(required, absent, strict=True)]
        parts.append(df.agg(F.array(*cells).alias("fields")).select(F.inline("fields")))
    return _union(parts)


REQUIRED_FIELDS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS entity, '{c}' AS field, {'false' if c in LACKING.get(t, ()) else 'true'} AS in_schema, {'count(*)' if c in LACKING.get(t, ()) else f'count(*) - count({c})'} AS n_missing FROM {t}"
    for t, required in REQUIRED.items() for c in required
)


def schema_check(spark: SparkSession, folder: str) -> DataFrame:
    """Required fields that a table's schema lacks."""
    lacks = [(t, c) for t, required in REQUIRED.items() for c in v.required_columns(table(spark, folder, t), required)]
    return spark.createDataFrame(lacks, "entity string, field string")


SCHEMA_SQL = "SELECT r.entity, r.field FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS entity, '{c}' AS field" for t, required in REQUIRED.items() for c in required) + """) AS r
WHERE NOT EXISTS (SELECT 1 FROM information_schema.columns AS i WHERE i.table_name = r.entity AND i.column_name = r.field)"""


def queries() -> dict:
    named = {f.__name__: f for f in (
        findings_report, findings_summary, dup_keys, dup_occurrences, geometry_duplicates, missing_fields, empty_history, orphan_parents, mirror_mismatch, page_number_mismatch,
        unapproved_candidates, code_not_in_dictionary, ordering_check, schema_check, unknown_references, version_rules, candidate_provenance, required_fields,
    )}
    return named | {"enum_violations": enum_violations, "range_violations": range_violations, "regex_violations": regex_violations}


def oracle_sql() -> dict[str, str]:
    return {
        "findings_report": FINDINGS_SQL, "findings_summary": f"SELECT entity, rule, count(*) AS n_findings FROM ({FINDINGS_SQL}) AS f GROUP BY 1, 2", "dup_keys": DUP_KEYS_SQL, "dup_occurrences": DUP_OCCURRENCES_SQL,
        "geometry_duplicates": GEOMETRY_SQL, "missing_fields": MISSING_SQL, "empty_history": EMPTY_HISTORY_SQL, "orphan_parents": ORPHAN_SQL, "mirror_mismatch": MIRROR_SQL,
        "page_number_mismatch": PAGE_NUMBER_SQL, "unapproved_candidates": UNAPPROVED_SQL, "code_not_in_dictionary": NOT_IN_SQL, "ordering_check": ORDERING_SQL,
        "unknown_references": UNKNOWN_REFERENCES_SQL, "version_rules": VERSION_RULES_SQL, "candidate_provenance": CANDIDATE_PROVENANCE_SQL, "required_fields": REQUIRED_FIELDS_SQL,
        "enum_violations": ENUM_SQL, "range_violations": RANGE_SQL, "regex_violations": REGEX_SQL, "schema_check": SCHEMA_SQL,
    }
