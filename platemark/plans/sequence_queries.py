"""Queries over sequences, events, lines, labels, grids and the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.functions import text
from platemark.functions.geometry import round6
from platemark.operators import browse, grid, legend, sequence
from platemark.plans.curation_queries import PUBLISH_CTE, publish_records
from platemark.sources.tables import table
from platemark.streaming import lifecycle

# --- events -------------------------------------------------------------------

HOURS = 720
#: What lifecycle events set (fixed values); events of the stream stand for them.
EFFECTS = {
    "edit": {"reference_status": "draft", "validation_status": "pending", "approval_state": "draft"},
    "review": {"validation_status": "reviewed", "approval_state": "in_review"},
    "approve": {"reference_status": "verified", "validation_status": "valid", "approval_state": "approved"},
    "deprecate": {"reference_status": "deprecated", "approval_state": "deprecated"},
    "archive": {"approval_state": "archived", "archived": "true"},
}
LIFECYCLE = {"view": "review", "purchase": "approve", "signup": "edit", "click": "deprecate", "error": "archive"}


def _hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each type per hour, the axis being hours since 2024."""
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).cast("long") - 473_352
    return table(spark, folder, "events").groupBy("event_type", hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of three hours or more with three events or more of a type."""
    return sequence.segments(_hourly(spark, folder), ["event_type"], "hour", F.col("n") >= 3, 3)


HOURLY_CTE = "hourly AS (SELECT event_type, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) - 473352 AS hour, count(*) AS n FROM events GROUP BY 1, 2)"
SEGMENTS_SQL = f"""WITH {HOURLY_CTE}, hits AS (SELECT event_type, hour, hour - row_number() OVER (PARTITION BY event_type ORDER BY hour) AS run FROM hourly WHERE n >= 3)
SELECT event_type, min(hour) AS first, max(hour) AS last, count(*) AS length FROM hits GROUP BY event_type, run HAVING count(*) >= 3"""


def content_extent(spark: SparkSession, folder: str) -> DataFrame:
    """Hours between the first and the last busy one of each type, with margins."""
    return sequence.content_extent(_hourly(spark, folder), ["event_type"], "hour", F.col("n") >= 6, HOURS, 0.08, 0.05)


EXTENT_SQL = f"""WITH {HOURLY_CTE}, e AS (SELECT event_type, min(CASE WHEN n >= 6 THEN hour END) AS lo, max(CASE WHEN n >= 6 THEN hour END) AS hi FROM hourly GROUP BY 1)
SELECT event_type, coalesce(greatest(0, lo - {int(HOURS * 0.08)}), 0) AS top, CASE WHEN hi IS NULL THEN {HOURS} ELSE least({HOURS}, hi + {int(HOURS * 0.05)}) END AS bottom FROM e"""


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return _of_lifecycle(table(spark, folder, "events"))


def _of_lifecycle(e: DataFrame) -> DataFrame:
    return e.select("user_id", "ts", "event_id", F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in LIFECYCLE.items()]).alias("event"))


def lifecycle_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Each entity's state after all its events."""
    return sequence.last_states(_log(spark, folder), "user_id", [F.col("ts"), F.col("event_id")], EFFECTS, "event")


def version_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a version with the state after it."""
    out = sequence.versions(_log(spark, folder), "user_id", ["ts", "event_id"], EFFECTS, "event")
    return out.select("user_id", "event_id", "event", "version_no", "approval_state", "archived", "reference_status", "validation_status")


def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each type per hour, counted by a stream that reads the table file by file."""
    events = lifecycle.stream_of(spark, f"{folder}/events.parquet")
    counts = lifecycle.windowed_counts(events, "ts", "event_type", "1 hour", "1 day")
    return lifecycle.drained(counts, "windows").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


STREAM_WINDOWS_SQL = "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2"


def stream_states(spark: SparkSession, folder: str) -> DataFrame:
    """``lifecycle_fold`` by a stream."""
    events = lifecycle.stream_of(spark, f"{folder}/events.parquet")
    return lifecycle.drained(lifecycle.running_states(_of_lifecycle(events), "user_id", [F.col("ts"), F.col("event_id")], EFFECTS, "event"), "states")


def _sets(field: str) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{EFFECTS[v][field]}'" for k, v in LIFECYCLE.items() if field in EFFECTS[v]) + " END"


_FIELDS = ("approval_state", "archived", "reference_status", "validation_status")
LOG_CTE = "log AS (SELECT user_id, ts, event_id, event_type, " + ", ".join(f"{_sets(f)} AS s_{f}" for f in _FIELDS) + " FROM events)"
VERSIONS_CTE = LOG_CTE + """, v AS (SELECT user_id, event_id, CASE event_type """ + " ".join(f"WHEN '{k}' THEN '{e}'" for k, e in LIFECYCLE.items()) + """ END AS event,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version_no, """ + ", ".join(f"last_value(s_{f} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {f}" for f in _FIELDS) + " FROM log)"
VERSIONS_SQL = f"WITH {VERSIONS_CTE} SELECT user_id, event_id, event, version_no, {', '.join(_FIELDS)} FROM v"
LIFECYCLE_SQL = f"WITH {VERSIONS_CTE}, l AS (SELECT user_id, max(version_no) AS current_version FROM v GROUP BY 1) SELECT v.user_id, {', '.join(_FIELDS)}, current_version FROM v JOIN l ON l.user_id = v.user_id AND l.current_version = v.version_no"


def id_allocation(spark: SparkSession, folder: str) -> DataFrame:
    """Ids for all labels, in the order they came."""
    m = table(spark, folder, "sign_mappings_clean").select("mapping_id", "updated_at")
    return sequence.allocate_ids(m, [F.asc_nulls_last("updated_at"), F.col("mapping_id")], "RM", 13).select("mapping_id", "allocated")


ID_SQL = "SELECT mapping_id, 'RM-' || lpad(CAST(13 + row_number() OVER (ORDER BY updated_at ASC NULLS LAST, mapping_id) AS VARCHAR), 6, '0') AS allocated FROM sign_mappings_clean"

# --- lines and labels -----------------------------------------------------------


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """The legend as it is printed: blocks of nine rows, each a line of code (every third with its description) and a line of description."""
    rows = table(spark, folder, "sign_legend")
    r = F.col("legend_row")
    head = rows.select(F.floor(r / 9).alias("block"), (r * 2).alias("line_no"), F.when(r % 3 == 0, F.concat("code", F.lit("  "), "description")).otherwise(F.col("code")).alias("line"))
    body = rows.select(F.floor(r / 9).alias("block"), (r * 2 + 1).alias("line_no"), F.when(r % 3 == 0, F.lit("12 34")).otherwise(F.col("description")).alias("line"))
    return head.unionByName(body)


def legend_parse(spark: SparkSession, folder: str) -> DataFrame:
    return legend.parse(_lines(spark, folder), "block", "line_no", "line")


LEGEND_PARSE_SQL = """SELECT CAST(floor(legend_row / 9.0) AS BIGINT) AS block, legend_row * 2 AS line_no, upper(code) AS code, description FROM sign_legend"""


def legend_line_regex(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of lines made of a code and its description."""
    lines = table(spark, folder, "sign_legend").select("legend_row", F.concat(F.lit("  "), "code", F.lit(" - "), "description").alias("line"))
    return legend.simple_entries(lines, "line", "legend_row")


LINE_REGEX_SQL = r"""SELECT legend_row, regexp_extract(line, '^([A-Z]{1,2}[0-9]{3})\s*[–-]?\s*(.+)$', 1) AS code, trim(regexp_extract(line, '^([A-Z]{1,2}[0-9]{3})\s*[–-]?\s*(.+)$', 2)) AS description
FROM (SELECT legend_row, code || ' - ' || description AS line FROM sign_legend) AS l WHERE regexp_matches(line, '^([A-Z]{1,2}[0-9]{3})\s*[–-]?\s*(.+)$')"""


def codes_of_text(spark: SparkSession, folder: str) -> DataFrame:
    """All codes in what was entered, and the first."""
    s = table(spark, folder, "page_4_signs").filter("code IS NOT NULL")
    found = F.regexp_extract_all(F.upper("code"), F.lit(r"([A-Z]{1,3}[0-9]{1,3}(?:\.[0-9]+)?)"), 1)
    return s.select("row_id", F.size(found).alias("n_codes"), F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("first_code"))


CODES_SQL = r"""SELECT row_id, CAST(len(regexp_extract_all(upper(code), '([A-Z]{1,3}[0-9]{1,3}(?:\.[0-9]+)?)')) AS INTEGER) AS n_codes, coalesce(regexp_extract(upper(code), '([A-Z]{1,3}[0-9]{1,3}(?:\.[0-9]+)?)', 1), '') AS first_code
FROM page_4_signs WHERE code IS NOT NULL"""


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Readable forms of whatever was entered, in any script, and safe names."""
    s = table(spark, folder, "page_4_signs").filter("code IS NOT NULL")
    return s.select(
        "row_id", text.humanize_title(F.col("code")).alias("title"), text.humanize_label(F.col("code")).alias("label"),
        text.safe_filename(F.col("code")).alias("safe_name"), text.valid_description(F.col("code")).alias("valid_description"),
    )


# The engine of the SQL has its own names for the classes of characters; blanks are those of functions/text.py.
_BLANKS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
LABELS_SQL = rf"""WITH a AS (SELECT row_id, code, regexp_replace(code, '([a-z])([A-Z])', '\1 \2', 'g') AS s FROM page_4_signs WHERE code IS NOT NULL),
b AS (SELECT row_id, code, trim(regexp_replace(regexp_replace(s, '([A-Za-z])(\p{{Nd}})', '\1 \2', 'g'), '{_BLANKS}+', ' ', 'g')) AS t,
  regexp_replace(regexp_replace(regexp_replace(s, '([A-Za-z])([0-9])', '\1 \2', 'g'), '([0-9])([A-Za-z])', '\1 \2', 'g'), '(?i)sign\b', 'sign', 'g') AS u FROM a),
c AS (SELECT row_id, code, t, trim(regexp_replace(array_to_string(list_transform(regexp_extract_all(u, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda p: CASE WHEN regexp_matches(p, '^[A-Z]{{2,}}$') THEN lower(p) ELSE p END), ''), '{_BLANKS}+', ' ', 'g')) AS u FROM b),
d AS (SELECT *, length(regexp_replace(code, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(code, '[^\p{{Nd}}\x{{b2}}\x{{b3}}\x{{b9}}\x{{2070}}-\x{{2089}}\x{{2460}}-\x{{2468}}]', '', 'g')) AS digits FROM c)
SELECT row_id, coalesce(array_to_string(list_transform(regexp_extract_all(t, '[{_CASED}]+|[^{_CASED}]+'), lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), ''), '') AS title,
  coalesce(array_to_string(list_transform(string_split(u, ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' '), '') AS label, regexp_replace(code, '[^A-Za-z0-9_.-]', '_', 'g') AS safe_name,
  letters >= 3 AND digits <= letters AS valid_description FROM d"""


def fallback_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Label and description of every mapping; a null page reads Pnull-."""
    label, description = text.fallback_label(F.col("page"), F.col("filename"), F.col("code"), F.col("description"))
    return table(spark, folder, "sign_mappings_clean").select("mapping_id", label.alias("label"), description.alias("description"))


FALLBACK_SQL = """SELECT mapping_id, CASE WHEN coalesce(code, '') <> '' THEN code ELSE 'P' || coalesce(CAST(page AS VARCHAR), 'null') || '-' || CASE WHEN regexp_matches(filename, '_([0-9]+)[.]') THEN regexp_extract(filename, '_([0-9]+)[.]', 1) ELSE 'UNK' END END AS label,
  CASE WHEN coalesce(description, '') <> '' THEN description WHEN coalesce(code, '') <> '' THEN 'Code ' || code ELSE 'Extracted sign (unlabeled)' END AS description FROM sign_mappings_clean"""


def normalized_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all posts, normalised, blank ones left out."""
    d = table(spark, folder, "documents").filter("text IS NOT NULL")
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).filter(F.col("line").rlike(r"[^\s\x{a0}]"))
    return lines.select("doc_id", "line_no", text.normalize_line(F.col("line")).alias("line"))


NORMALIZED_LINES_SQL = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
m AS (SELECT doc_id, line_no, array_to_string(list_transform(regexp_extract_all(replace(line, chr(160), ' '), '(?:[A-Za-z][\s\v]+){2,}[A-Za-z]|(?s:.)'), lambda p: CASE WHEN length(p) > 1 THEN replace(p, ' ', '') ELSE p END), '') AS line FROM l WHERE regexp_matches(line, '[^\s\v\x{a0}]'))
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '[\s\v]*[.][\s\v]*', '.', 'g'), '[\s\v]*,[\s\v]*', ', ', 'g'), '[\s\v]*&[\s\v]*', ' & ', 'g'), '[\s\v]+', ' ', 'g')) AS line FROM m"""

# --- grids ----------------------------------------------------------------------


def _regions(spark: SparkSession, folder: str) -> DataFrame:
    """A region for each page: as many columns and rows as its number gives."""
    p = table(spark, folder, "manual_pages").filter("page_number IS NOT NULL")
    n = F.col("page_number")
    sizes = lambda count, base: F.transform(F.sequence(F.lit(1), count), lambda i: (i * 7 + base) % 40 + 20)
    return p.select(
        "page_id", (n * 3).alias("left"), (n * 5).alias("top"), (n % 4).alias("gap_x"), (n % 3).alias("gap_y"),
        sizes((n % 5 + 1).cast("int"), n).alias("column_widths"), sizes((n % 3 + 1).cast("int"), n).alias("row_heights"),
    )


def grid_cells(spark: SparkSession, folder: str) -> DataFrame:
    return grid.grid_cells(_regions(spark, folder), ["page_id"]).select("page_id", "row_no", "column_no", "x", "y", "w", "h")


def region_report(spark: SparkSession, folder: str) -> DataFrame:
    return grid.region_extent(_regions(spark, folder), ["page_id"])


CELLS_CTE = """p AS (SELECT page_id, page_number AS n FROM manual_pages WHERE page_number IS NOT NULL),
c AS (SELECT page_id, n, i, (i * 7 + n) % 40 + 20 AS w, sum((i * 7 + n) % 40 + 20) OVER (PARTITION BY page_id ORDER BY i) AS upto FROM p, range(1, 6) AS t(i) WHERE i <= n % 5 + 1),
r AS (SELECT page_id, i, (i * 7 + n) % 40 + 20 AS h, sum((i * 7 + n) % 40 + 20) OVER (PARTITION BY page_id ORDER BY i) AS upto FROM p, range(1, 4) AS t(i) WHERE i <= n % 3 + 1)"""
GRID_SQL = f"""WITH {CELLS_CTE} SELECT c.page_id, CAST(r.i - 1 AS INTEGER) AS row_no, CAST(c.i - 1 AS INTEGER) AS column_no, CAST(c.n * 3 + c.upto - c.w + (c.i - 1) * (c.n % 4) AS BIGINT) AS x,
  CAST(c.n * 5 + r.upto - r.h + (r.i - 1) * (c.n % 3) AS BIGINT) AS y, CAST(c.w AS INTEGER) AS w, CAST(r.h AS INTEGER) AS h FROM c JOIN r ON r.page_id = c.page_id"""
REGION_SQL = f"""WITH {CELLS_CTE}, a AS (SELECT page_id, n, count(*) AS k, sum(w) AS s FROM c GROUP BY 1, 2), b AS (SELECT page_id, count(*) AS k, sum(h) AS s FROM r GROUP BY 1)
SELECT a.page_id, CAST(b.k AS INTEGER) AS n_rows, CAST(a.k AS INTEGER) AS n_columns, CAST(a.s + (a.k - 1) * (a.n % 4) AS BIGINT) AS total_width, CAST(b.s + (b.k - 1) * (a.n % 3) AS BIGINT) AS total_height FROM a JOIN b ON b.page_id = a.page_id"""


def region_from_corners(spark: SparkSession, folder: str) -> DataFrame:
    """Cell sizes of a grid of 3 rows and 4 columns laid over each crop."""
    s = table(spark, folder, "page_4_signs")
    return s.select("row_id", grid.cell_size_from_corners(F.col("w"), F.lit(2), F.lit(4)).alias("column_width"), grid.cell_size_from_corners(F.col("h"), F.lit(3), F.lit(3)).alias("row_height"))


CORNERS_SQL = "SELECT row_id, CAST(round_even((w - 6) / 4.0, 0) AS INTEGER) AS column_width, CAST(round_even((h - 6) / 3.0, 0) AS INTEGER) AS row_height FROM page_4_signs"


# Grid of seeded cells: columns, pages, left and top of the first, steps to the next (fixed values).
SEED_COLUMNS, SEED_PAGES, SEED_X, SEED_Y, SEED_STEP_X, SEED_STEP_Y = 4, 5, 0.06, 0.08, 0.20, 0.22
# Events each seeded position goes through, and what its creation sets (fixed values).
SEED_EVENTS = ["create", "review", "approve"]
CREATED = {"create": {"reference_status": "draft", "validation_status": "pending", "approval_state": "draft"}}


def seeded_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Pages in turn, grid places and boxes for new cells, one for each row of the legend."""
    i = F.col("legend_row") - 1
    column, row = F.pmod(i, F.lit(SEED_COLUMNS)), F.floor(F.pmod(i, F.lit(16)) / SEED_COLUMNS)
    return table(spark, folder, "sign_legend").select(
        "legend_row", (F.pmod(i, F.lit(SEED_PAGES)) + 1).alias("page"), (F.floor(i / SEED_COLUMNS) + 1).alias("grid_row"), (column + 1).alias("grid_col"),
        round6(SEED_X + column * SEED_STEP_X).alias("norm_x"), round6(SEED_Y + row * SEED_STEP_Y).alias("norm_y"),
    )


def seeded_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of the positions of seeded cells: created, reviewed, approved."""
    events = table(spark, folder, "sign_legend").select("legend_row", F.posexplode(F.array(*[F.lit(e) for e in SEED_EVENTS])).alias("place", "event"))
    states = sequence.versions(events, "legend_row", ["place"], CREATED | EFFECTS, "event")
    return states.select("legend_row", "version_no", "event", "reference_status", "validation_status", "approval_state")


SEEDED_LIFECYCLE_SQL = """SELECT legend_row, v.* FROM sign_legend, (VALUES (CAST(1 AS BIGINT), 'create', 'draft', 'pending', 'draft'), (2, 'review', 'draft', 'reviewed', 'in_review'), (3, 'approve', 'verified', 'valid', 'approved'))
AS v(version_no, event, reference_status, validation_status, approval_state)"""


SEEDED_SQL = """SELECT legend_row, (legend_row - 1) % 5 + 1 AS page, CAST(floor((legend_row - 1) / 4.0) AS BIGINT) + 1 AS grid_row, (legend_row - 1) % 4 + 1 AS grid_col,
  floor((0.06 + ((legend_row - 1) % 4) * 0.20) * 1000000.0 + 0.5) / 1000000.0 AS norm_x, floor((0.08 + floor(((legend_row - 1) % 16) / 4.0) * 0.22) * 1000000.0 + 0.5) / 1000000.0 AS norm_y FROM sign_legend WHERE legend_row >= 1"""

# --- the library ------------------------------------------------------------------


def _library(spark: SparkSession, folder: str) -> DataFrame:
    status = table(spark, folder, "page_4_signs").select("row_id", "page", "status")
    return publish_records(spark, folder).select("row_id", "filename", "code", "description", "confidence").join(status, "row_id")


def library_search(spark: SparkSession, folder: str) -> DataFrame:
    return browse.search(_library(spark, folder), " Bridge ", "ok").select("row_id", "code", "description")


def library_page(spark: SparkSession, folder: str) -> DataFrame:
    """The third page of 24 of all records."""
    return sequence.page_of(_library(spark, folder), browse.library_order(), 48, 24).select("row_id", "filename", "confidence")


LIBRARY_CTE = f"{PUBLISH_CTE}, lib AS (SELECT p.row_id, p.filename, p.code, p.description, p.confidence, s.page, s.status FROM published AS p JOIN page_4_signs AS s ON s.row_id = p.row_id)"
SEARCH_SQL = f"WITH {LIBRARY_CTE} SELECT row_id, code, description FROM lib WHERE status = 'ok' AND (strpos(lower(code), 'bridge') > 0 OR strpos(lower(description), 'bridge') > 0 OR strpos('p' || coalesce(CAST(page AS VARCHAR), 'null') || '-' || lower(coalesce(filename, '')), 'bridge') > 0)"
PAGE_SQL = f"WITH {LIBRARY_CTE} SELECT row_id, filename, confidence FROM lib ORDER BY confidence DESC, page ASC NULLS LAST, filename ASC NULLS LAST, row_id LIMIT 24 OFFSET 48"


def sample_limit(spark: SparkSession, folder: str) -> DataFrame:
    """The first 24 crops in reading order: the matcher's sample."""
    s = table(spark, folder, "page_4_signs").select("row_id", "page", "y", "x", "filename")
    return s.orderBy(F.asc_nulls_last("page"), "y", "x", "filename", "row_id").limit(24)


SAMPLE_SQL = "SELECT row_id, page, y, x, filename FROM page_4_signs ORDER BY page ASC NULLS LAST, y, x, filename, row_id LIMIT 24"


def quiz_options(spark: SparkSession, folder: str) -> DataFrame:
    ready = publish_records(spark, folder).filter("code <> ''").select("row_id", "code")
    return browse.quiz(ready, table(spark, folder, "sign_legend"))


QUIZ_SQL = f"""WITH {PUBLISH_CTE}, ring AS (SELECT code, row_number() OVER (ORDER BY sha256('quiz|' || code)) AS place FROM (SELECT DISTINCT code FROM sign_legend) AS c), t AS (SELECT count(*) AS total FROM ring)
SELECT p.row_id, p.code AS answer, o.code AS "option", o.code = p.code AS correct FROM published AS p JOIN ring AS a ON a.code = p.code CROSS JOIN t JOIN range(0, 4) AS s(step) ON s.step < t.total
JOIN ring AS o ON o.place = (a.place - 1 + s.step) % t.total + 1 WHERE p.code <> ''"""


def queries() -> dict:
    return {f.__name__: f for f in (
        segments, content_extent, lifecycle_fold, stream_states, stream_windows, version_snapshots, id_allocation, legend_parse, legend_line_regex, codes_of_text, labels, fallback_labels, normalized_lines,
        grid_cells, region_report, region_from_corners, seeded_cells, seeded_lifecycle, library_search, library_page, sample_limit, quiz_options,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "segments": SEGMENTS_SQL, "content_extent": EXTENT_SQL, "lifecycle_fold": LIFECYCLE_SQL, "stream_states": LIFECYCLE_SQL, "stream_windows": STREAM_WINDOWS_SQL, "version_snapshots": VERSIONS_SQL, "id_allocation": ID_SQL,
        "legend_parse": LEGEND_PARSE_SQL, "legend_line_regex": LINE_REGEX_SQL, "codes_of_text": CODES_SQL, "fallback_labels": FALLBACK_SQL, "labels": LABELS_SQL, "normalized_lines": NORMALIZED_LINES_SQL,
        "grid_cells": GRID_SQL, "region_report": REGION_SQL, "region_from_corners": CORNERS_SQL, "seeded_cells": SEEDED_SQL, "seeded_lifecycle": SEEDED_LIFECYCLE_SQL,
        "library_search": SEARCH_SQL, "library_page": PAGE_SQL, "sample_limit": SAMPLE_SQL, "quiz_options": QUIZ_SQL,
    }
