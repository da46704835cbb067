"""Queries over boxes: predicates, adjustments, scoring, matching, greedy reductions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.functions import geometry as g
from platemark.operators import boxes, grid, matching
from platemark.operators.references import norm_key
from platemark.operators.sizing import lookup, small_or_shuffled
from platemark.sources.tables import table

# Size of a page in pixels, and in the queries below thresholds, shares and paddings (fixed values).
PAGE_W, PAGE_H = 6736, 9536
APPROVED = "approval_state = 'approved' AND reference_status = 'verified'"


def _b() -> g.Box:
    return g.box("x", "y", "w", "h")


def signs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "page_4_signs")


def page_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """One size per page number; the last page id wins across editions."""
    pages = table(spark, folder, "manual_pages").filter("page_number IS NOT NULL")
    return matching.last_wins(pages, "page_number", F.col("page_id"), ["image_width", "image_height"])


PAGES_SQL = """page_sizes AS (SELECT page_number, image_width, image_height FROM (
  SELECT page_number, image_width, image_height, row_number() OVER (PARTITION BY page_number ORDER BY page_id DESC) AS n
  FROM manual_pages WHERE page_number IS NOT NULL) AS p WHERE n = 1)"""


def _r6(e: str) -> str:
    return f"(floor(({e}) * 1000000.0 + 0.5) / 1000000.0)"


def _norm(v: str, size: str) -> str:
    return f"CASE WHEN {size} > 0 THEN {_r6(f'CAST({v} AS DOUBLE) / {size}')} END"


def _normalized(spark: SparkSession, folder: str) -> DataFrame:
    sized = signs(spark, folder).join(small_or_shuffled(page_sizes(spark, folder)), F.col("page") == F.col("page_number"))
    nx, ny, nw, nh = g.normalize(_b(), F.col("image_width"), F.col("image_height"))
    return sized.select("row_id", "filename", "page", "code", "confidence", "extracted_at", nx.alias("norm_x"), ny.alias("norm_y"), nw.alias("norm_w"), nh.alias("norm_h"))


def box_normalize(spark: SparkSession, folder: str) -> DataFrame:
    n = _normalized(spark, folder)
    return n.select("row_id", "page", "norm_x", "norm_y", "norm_w", "norm_h", (F.col("confidence") / 100.0).alias("confidence"), F.coalesce(F.trim("code"), F.lit("")).alias("code"))


NORMALIZED_SQL = f"""normalized AS (SELECT s.row_id, s.filename, s.page, s.code, s.confidence, s.extracted_at,
  {_norm('s.x', 'p.image_width')} AS norm_x, {_norm('s.y', 'p.image_height')} AS norm_y,
  {_norm('s.w', 'p.image_width')} AS norm_w, {_norm('s.h', 'p.image_height')} AS norm_h
  FROM page_4_signs AS s JOIN page_sizes AS p ON s.page = p.page_number)"""
BOX_NORMALIZE_SQL = f"WITH {PAGES_SQL}, {NORMALIZED_SQL} SELECT row_id, page, norm_x, norm_y, norm_w, norm_h, confidence / 100.0 AS confidence, coalesce(trim(code), '') AS code FROM normalized"


def box_size_filter(spark: SparkSession, folder: str) -> DataFrame:
    return signs(spark, folder).filter(boxes.fits(_b(), 900, 60000, 20, 4.0)).select("row_id", "w", "h", g.aspect(F.col("w"), F.col("h")).alias("aspect"))


BOX_SIZE_FILTER_SQL = """SELECT row_id, w, h, greatest(CAST(w AS DOUBLE) / h, CAST(h AS DOUBLE) / w) AS aspect FROM page_4_signs
WHERE w > 0 AND h > 0 AND CAST(w AS BIGINT) * h BETWEEN 900 AND 60000 AND w >= 20 AND h >= 20 AND greatest(CAST(w AS DOUBLE) / h, CAST(h AS DOUBLE) / w) <= 4.0"""


def box_fp_filter(spark: SparkSession, folder: str) -> DataFrame:
    return signs(spark, folder).filter(boxes.plausible(_b(), F.lit(PAGE_H), 28, 900, 0.08, 0.04, 4.0)).select("row_id", "x", "y", "w", "h")


BOX_FP_FILTER_SQL = f"""SELECT row_id, x, y, w, h FROM page_4_signs WHERE NOT (
  y < {int(PAGE_H * 0.08)} OR y + h > {int(PAGE_H * 0.96)} OR (w < 33.6 AND h < 33.6) OR CAST(w AS BIGINT) * h < 900
  OR (w < 56 AND h < 56) OR CAST(w AS DOUBLE) / greatest(h, 1) > 4.0 OR CAST(w AS DOUBLE) / greatest(h, 1) < 0.25)"""


def _adjusted(spark: SparkSession, folder: str, b: g.Box) -> DataFrame:
    return signs(spark, folder).select("row_id", *[c.cast("int").alias(n) for c, n in zip(b, ("x", "y", "w", "h"), strict=True)])


def box_clamp(spark: SparkSession, folder: str) -> DataFrame:
    return _adjusted(spark, folder, g.clamp(_b(), F.lit(5000), F.lit(5000)))


def box_pad(spark: SparkSession, folder: str) -> DataFrame:
    return _adjusted(spark, folder, g.pad(_b(), F.lit(PAGE_W), F.lit(PAGE_H), 0.12, 0.18, 0.12, 0.3, 14))


def box_pad_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return _adjusted(spark, folder, g.pad_fixed(_b(), F.lit(PAGE_W), F.lit(PAGE_H), 6))


def box_expand(spark: SparkSession, folder: str) -> DataFrame:
    return _adjusted(spark, folder, g.expand(_b(), F.lit(PAGE_W), F.lit(PAGE_H), 10, 160))


def _sides(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"""SELECT row_id, CAST(x1 AS INTEGER) AS x, CAST(y1 AS INTEGER) AS y, CAST(x2 - x1 AS INTEGER) AS w, CAST(y2 - y1 AS INTEGER) AS h FROM (
  SELECT row_id, {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM page_4_signs) AS s"""


_fixed = lambda n: _sides(f"greatest(0, x - {n})", f"greatest(0, y - {n})", f"least({PAGE_W}, x + w + {n})", f"least({PAGE_H}, y + h + {n})")
_grow = lambda v, r: f"greatest(14, CAST(round_even({v} * {r}, 0) AS INTEGER))"
BOX_CLAMP_SQL = """SELECT row_id, CAST(nx AS INTEGER) AS x, CAST(ny AS INTEGER) AS y, CAST(greatest(1, least(w, 5000 - nx)) AS INTEGER) AS w, CAST(greatest(1, least(h, 5000 - ny)) AS INTEGER) AS h FROM (
  SELECT row_id, w, h, greatest(0, least(x, 4999)) AS nx, greatest(0, least(y, 4999)) AS ny FROM page_4_signs) AS s"""
BOX_PAD_SQL = _sides(f"greatest(0, x - {_grow('w', 0.12)})", f"greatest(0, y - {_grow('h', 0.18)})", f"least({PAGE_W}, x + w + {_grow('w', 0.12)})", f"least({PAGE_H}, y + h + {_grow('h', 0.3)})")


def confidence_score(spark: SparkSession, folder: str) -> DataFrame:
    """Status, warning tags and score of each crop."""
    tags = grid.warning_tags(_b(), F.col("code"))
    out = signs(spark, folder).withColumn("tags", tags)
    status = F.when(F.size("tags") == 0, "ok").otherwise("warning")
    score = grid.confidence(status == "ok", F.size("tags"), F.coalesce(F.trim("code"), F.lit("")) != "", F.lit(True), F.col("w").cast("long") * F.col("h"))
    return out.select("row_id", status.alias("status"), F.concat_ws(",", "tags").alias("tags"), score.alias("score"))


CONFIDENCE_SQL = """WITH t AS (SELECT row_id, w, h, coalesce(trim(code), '') AS code,
  CASE WHEN CAST(w AS BIGINT) * h < 900 THEN 1 ELSE 0 END AS t1, CASE WHEN w < 28 OR h < 28 THEN 1 ELSE 0 END AS t2,
  CASE WHEN h > 0 AND w > 0 AND greatest(CAST(w AS DOUBLE) / h, CAST(h AS DOUBLE) / w) > 4.0 THEN 1 ELSE 0 END AS t3,
  CASE WHEN coalesce(trim(code), '') = '' THEN 1 ELSE 0 END AS t4 FROM page_4_signs)
SELECT row_id, CASE WHEN t1 + t2 + t3 + t4 = 0 THEN 'ok' ELSE 'warning' END AS status,
  concat_ws(',', CASE WHEN t1 = 1 THEN 'small_area' END, CASE WHEN t2 = 1 THEN 'small_side' END, CASE WHEN t3 = 1 THEN 'extreme_aspect' END, CASE WHEN t4 = 1 THEN 'code_missing' END) AS tags,
  CAST(greatest(0, least(100, 100 - CASE WHEN t1 + t2 + t3 + t4 > 0 THEN 20 ELSE 0 END - least(30, 10 * (t1 + t2 + t3 + t4)) - CASE WHEN code = '' THEN 25 ELSE 0 END - CASE WHEN CAST(w AS BIGINT) * h < 10000 THEN 5 ELSE 0 END)) AS DOUBLE) AS score FROM t"""


def refine_retry(spark: SparkSession, folder: str) -> DataFrame:
    """Up to three rounds of: valid? else expand; the box, whether it is valid, and the rounds used."""
    out = signs(spark, folder).select("row_id", "x", "y", "w", "h")
    return grid.refine(out, lambda b: (b[2] >= 60) & (b[3] >= 60), F.lit(PAGE_W), F.lit(PAGE_H), 10, 160, 3)


REFINE_SQL = "WITH r0 AS (SELECT row_id, x, y, w, h, 0 AS retries FROM page_4_signs)" + "".join(
    f""", r{i} AS (SELECT row_id,
  CASE WHEN w >= 60 AND h >= 60 THEN x ELSE greatest(0, x - 10) END AS x, CASE WHEN w >= 60 AND h >= 60 THEN y ELSE greatest(0, y - 10) END AS y,
  CASE WHEN w >= 60 AND h >= 60 THEN w ELSE least({PAGE_W}, x + w + 10) - greatest(0, x - 10) END AS w,
  CASE WHEN w >= 60 AND h >= 60 THEN h ELSE least({PAGE_H}, y + h + 10) - greatest(0, y - 10) END AS h,
  retries + CASE WHEN w >= 60 AND h >= 60 THEN 0 ELSE 1 END AS retries FROM r{i - 1})"""
    for i in (1, 2, 3)
) + " SELECT row_id, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CAST(w AS INTEGER) AS w, CAST(h AS INTEGER) AS h, CAST(retries AS INTEGER) AS retries, w >= 60 AND h >= 60 AS valid FROM r3"

# --- matching -----------------------------------------------------------------



def _rescored(joined: DataFrame) -> DataFrame:
    instance, ref = g.box("norm_x", "norm_y", "norm_w", "norm_h"), g.box("ref_x", "ref_y", "ref_w", "ref_h")
    return matching.scored(joined, instance, ref, F.col("code"), F.col("official_code"))


SCORES = ["iou", "center_distance", "center_score", "area_ratio", "geometry_score", "agreement", "match_score"]


def _instances(spark: SparkSession, folder: str) -> DataFrame:
    """One instance per crop: its latest extraction."""
    columns = ["page", "code", "norm_x", "norm_y", "norm_w", "norm_h"]
    return matching.last_wins(_normalized(spark, folder), "filename", F.struct("extracted_at", "row_id"), columns)


def _references(spark: SparkSession, folder: str) -> DataFrame:
    refs = table(spark, folder, "reference_positions").filter(APPROVED)
    return refs.select(
        "reference_position_id", "page_number", norm_key("edition_id").alias("edition"), "official_code",
        F.col("norm_x").alias("ref_x"), F.col("norm_y").alias("ref_y"), F.col("norm_w").alias("ref_w"), F.col("norm_h").alias("ref_h"),
    )


def match_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The three best approved references of every crop among its candidate pairs, scored anew."""
    pairs = table(spark, folder, "candidate_assignments").select("filename", "reference_position_id").dropna().distinct()
    crops = _instances(spark, folder).withColumn("crop_there", F.lit(True))
    refs = _references(spark, folder).withColumn("ref_there", F.lit(True))
    joined = lookup(pairs, refs, ["reference_position_id"], spread_by="filename").filter("ref_there")
    joined = lookup(joined, crops, ["filename"], spread_by="reference_position_id").filter("crop_there")
    best = matching.ranked(_rescored(joined), ["filename"], 3, "reference_position_id")
    ident = matching.pair_id(F.col("reference_position_id"), matching.instance_id(F.col("filename")))
    return best.select(ident.alias("candidate_assignment_id"), "filename", "reference_position_id", "rank", *SCORES)


def page_match(spark: SparkSession, folder: str) -> DataFrame:
    """The three best references of a crop in each edition that some run was made for, and in no other; ``page_match_all`` knows no editions.

    A crop knows no edition, so it is scored with the references of its page
    number in every edition that has a run: the pairs grow with crops times
    what the sheets of that number hold. Only pairs that may be among an
    edition's best leave the task that scores them.
    """
    editions = table(spark, folder, "reference_matcher_run_manifest").select(norm_key("edition_id").alias("edition")).distinct()
    refs = _references(spark, folder).join(small_or_shuffled(editions), "edition").withColumnRenamed("page_number", "page")
    met = matching.contenders(_instances(spark, folder), refs, "page", "filename", 3, per="edition")
    best = matching.ranked(_rescored(met), ["edition", "filename"], 3, "reference_position_id")
    return best.select("edition", "filename", "reference_position_id", "rank", *SCORES)


def page_match_all(spark: SparkSession, folder: str) -> DataFrame:
    """The three best of all approved references of a crop's page, whatever their edition."""
    refs = _references(spark, folder).withColumnRenamed("page_number", "page")
    met = matching.contenders(_instances(spark, folder), refs, "page", "filename", 3)
    best = matching.ranked(_rescored(met), ["filename"], 3, "reference_position_id")
    return best.select("filename", "reference_position_id", "rank", *SCORES)


def match_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Approved references, crops and ranked candidates, in one row."""
    refs = table(spark, folder, "reference_positions").filter(APPROVED).agg(F.count(F.lit(1)).alias("approved_references"))
    crops = signs(spark, folder).agg(F.countDistinct("filename").alias("crops"))
    ranked = match_topk(spark, folder).agg(F.count(F.lit(1)).alias("candidates"), F.countDistinct("filename").alias("matched_crops"))
    return refs.crossJoin(crops).crossJoin(ranked)


def _iou(a: str, b: str) -> str:
    across = f"(least({a}x + {a}w, {b}x + {b}w) - greatest({a}x, {b}x))"
    down = f"(least({a}y + {a}h, {b}y + {b}h) - greatest({a}y, {b}y))"
    union = f"({a}w * {a}h + {b}w * {b}h - {across} * {down})"
    return f"CASE WHEN {across} > 0 AND {down} > 0 AND {union} > 0 THEN CAST({across} * {down} AS DOUBLE) / {union} ELSE 0.0 END"


_D = "sqrt(((norm_x + norm_w / 2.0) - (ref_x + ref_w / 2.0)) * ((norm_x + norm_w / 2.0) - (ref_x + ref_w / 2.0)) + ((norm_y + norm_h / 2.0) - (ref_y + ref_h / 2.0)) * ((norm_y + norm_h / 2.0) - (ref_y + ref_h / 2.0)))"
_A = "CASE WHEN norm_w * norm_h > 0 AND ref_w * ref_h > 0 THEN least(norm_w * norm_h, ref_w * ref_h) / greatest(norm_w * norm_h, ref_w * ref_h) ELSE 0.0 END"
REFS_SQL = f"""refs AS (SELECT reference_position_id, page_number, nullif(lower(trim(edition_id, chr(32) || chr(9) || chr(10))), '') AS edition, official_code,
  norm_x AS ref_x, norm_y AS ref_y, norm_w AS ref_w, norm_h AS ref_h FROM reference_positions WHERE {APPROVED})"""
INSTANCES_SQL = """instances AS (SELECT filename, page, code, norm_x, norm_y, norm_w, norm_h FROM (
  SELECT *, row_number() OVER (PARTITION BY filename ORDER BY extracted_at DESC NULLS LAST, row_id DESC) AS n FROM normalized) AS i WHERE n = 1)"""
SCORED_SQL = f"""raw AS (SELECT *, {_iou('norm_', 'ref_')} AS o, {_D} AS d, {_A} AS a, coalesce(trim(code), '') AS read_code FROM pairs),
part AS (SELECT *, greatest(0.0, 1.0 - least(1.0, d / {math.sqrt(2.0)!r})) AS c FROM raw),
scored AS (SELECT filename, reference_position_id, {_r6('o')} AS iou, {_r6('d')} AS center_distance, {_r6('c')} AS center_score, {_r6('a')} AS area_ratio,
  {_r6('o * 0.7 + c * 0.2 + a * 0.1')} AS geometry_score,
  CASE WHEN read_code = '' THEN 'unavailable' WHEN read_code = official_code THEN 'consistent' ELSE 'inconsistent' END AS agreement FROM part),
final AS (SELECT *, CASE agreement WHEN 'unavailable' THEN {_r6('geometry_score')} WHEN 'consistent' THEN {_r6('least(1.0, geometry_score + 0.15 * 1.0)')} ELSE {_r6('least(1.0, geometry_score + 0.15 * 0.0)')} END AS match_score FROM scored),
best AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY match_score DESC NULLS LAST, iou DESC NULLS LAST, center_distance ASC NULLS LAST, reference_position_id) AS rank FROM final)"""
MATCH_SQL = f"""WITH {PAGES_SQL}, {NORMALIZED_SQL}, {INSTANCES_SQL}, {REFS_SQL},
pairs AS (SELECT i.*, r.* FROM (SELECT DISTINCT filename, reference_position_id FROM candidate_assignments) AS p JOIN refs AS r ON r.reference_position_id = p.reference_position_id JOIN instances AS i ON i.filename = p.filename),
{SCORED_SQL}"""
_OUT = "filename, reference_position_id, CAST(rank AS INTEGER) AS rank, iou, center_distance, center_score, area_ratio, geometry_score, agreement, match_score"
MATCH_TOPK_SQL = MATCH_SQL + f" SELECT 'CA-' || substr(sha256(reference_position_id || '|ES-' || replace(filename, '.png', '')), 1, 16) AS candidate_assignment_id, {_OUT} FROM best WHERE rank <= 3"
PAGE_MATCH_SQL = f"""WITH {PAGES_SQL}, {NORMALIZED_SQL}, {INSTANCES_SQL}, {REFS_SQL},
editions AS (SELECT DISTINCT nullif(lower(trim(edition_id)), '') AS edition FROM reference_matcher_run_manifest),
pairs AS (SELECT i.*, r.* FROM instances AS i JOIN refs AS r ON r.page_number = i.page JOIN editions AS e ON e.edition = r.edition),
{SCORED_SQL.replace('SELECT filename, reference', 'SELECT edition, filename, reference').replace('PARTITION BY filename', 'PARTITION BY edition, filename')} SELECT edition, {_OUT} FROM best WHERE rank <= 3"""
PAGE_MATCH_ALL_SQL = f"""WITH {PAGES_SQL}, {NORMALIZED_SQL}, {INSTANCES_SQL}, {REFS_SQL},
pairs AS (SELECT i.*, r.* FROM instances AS i JOIN refs AS r ON r.page_number = i.page),
{SCORED_SQL} SELECT {_OUT} FROM best WHERE rank <= 3"""
MATCH_SUMMARY_SQL = MATCH_SQL + f""" SELECT (SELECT count(*) FROM reference_positions WHERE {APPROVED}) AS approved_references, (SELECT count(DISTINCT filename) FROM page_4_signs) AS crops,
  (SELECT count(*) FROM best WHERE rank <= 3) AS candidates, (SELECT count(DISTINCT filename) FROM best) AS matched_crops"""

# --- joins and reductions of boxes on one page --------------------------------

def _boxes(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return signs(spark, folder).select(F.col("row_id").alias("id"), "page", "x", "y", "w", "h", *more)


def iou_threshold_join(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of different crops of a page that overlap by a fifth or more."""
    b = _boxes(spark, folder)
    return boxes.overlapping_pairs(b, b, "page", 0.2, rank="id").select("left_id", "right_id", g.round6(F.col("iou")).alias("iou"))


def nms_greedy(spark: SparkSession, folder: str) -> DataFrame:
    """Crops that survive greedy suppression: larger first, then more confident, then by id."""
    b = _boxes(spark, folder, "confidence")
    order = [-(F.col("w").cast("long") * F.col("h")), -F.coalesce("confidence", F.lit(-1.0)), F.col("id")]
    return boxes.suppress(b, "page", order, 0.55).select("id", "page")


def nearest_box(spark: SparkSession, folder: str) -> DataFrame:
    """For each crop without a code the nearest crop of its page that has one."""
    b = _boxes(spark, folder, "code")
    coded = F.coalesce(F.trim("code"), F.lit("")) != ""
    near = boxes.nearest(b.filter(~coded), b.filter(coded), "page")
    return near.select("left_id", "right_id", g.round6(F.col("distance")).alias("distance"))


def _sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes of reference positions in pixels, by edition and page: one physical sheet per group."""
    p = table(spark, folder, "reference_positions").filter("page_number IS NOT NULL")
    scale = lambda c, size: F.floor(F.col(c) * size + 0.5)
    return p.select(norm_key("edition_id").alias("edition"), "page_number", F.col("reference_position_id").alias("id"),
                    scale("norm_x", PAGE_W).alias("x"), scale("norm_y", PAGE_H).alias("y"), scale("norm_w", PAGE_W).alias("w"), scale("norm_h", PAGE_H).alias("h")).filter("edition IS NOT NULL AND x + y + w + h IS NOT NULL")


def merge_boxes_fixpoint(spark: SparkSession, folder: str) -> DataFrame:
    return boxes.merge_near(_sheet(spark, folder), ["edition", "page_number"], 0.14, 40.0)


def row_bucketing(spark: SparkSession, folder: str) -> DataFrame:
    return boxes.row_buckets(_sheet(spark, folder), ["edition", "page_number"], 40.0)


def coalesce_text_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return boxes.coalesce_boxes(_sheet(spark, folder), ["edition", "page_number"], 25.0)


SHEET_SQL = f"""sheet AS (SELECT * FROM (SELECT nullif(lower(trim(edition_id, chr(32) || chr(9) || chr(10))), '') AS edition, page_number, reference_position_id AS id,
  CAST(floor(norm_x * {PAGE_W} + 0.5) AS DOUBLE) AS x, CAST(floor(norm_y * {PAGE_H} + 0.5) AS DOUBLE) AS y, CAST(floor(norm_w * {PAGE_W} + 0.5) AS DOUBLE) AS w, CAST(floor(norm_h * {PAGE_H} + 0.5) AS DOUBLE) AS h
  FROM reference_positions WHERE page_number IS NOT NULL) AS s WHERE edition IS NOT NULL AND x + y + w + h IS NOT NULL)"""
ROW_BUCKETING_SQL = f"""WITH RECURSIVE {SHEET_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY edition, page_number ORDER BY y, x, id) AS n FROM sheet),
walk AS (SELECT edition, page_number, id, x, n, y AS anchor, 1 AS row_no FROM o WHERE n = 1
  UNION ALL SELECT o.edition, o.page_number, o.id, o.x, o.n, CASE WHEN o.y - walk.anchor > 40 THEN o.y ELSE walk.anchor END,
    CASE WHEN o.y - walk.anchor > 40 THEN walk.row_no + 1 ELSE walk.row_no END
  FROM walk JOIN o ON o.edition = walk.edition AND o.page_number = walk.page_number AND o.n = walk.n + 1)
SELECT edition, page_number, id, row_no, CAST(row_number() OVER (PARTITION BY edition, page_number, row_no ORDER BY x, id) AS INTEGER) AS column_no FROM walk"""
COALESCE_SQL = f"""WITH RECURSIVE {SHEET_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY edition, page_number ORDER BY y, x, w, h) AS n FROM sheet),
walk AS (SELECT edition, page_number, n, x, y, x + w AS r, y + h AS b, 1 AS block_no, 1 AS members FROM o WHERE n = 1
  UNION ALL SELECT o.edition, o.page_number, o.n,
    CASE WHEN o.y <= k.b + 25 AND o.x <= k.r + 25 THEN least(k.x, o.x) ELSE o.x END, CASE WHEN o.y <= k.b + 25 AND o.x <= k.r + 25 THEN least(k.y, o.y) ELSE o.y END,
    CASE WHEN o.y <= k.b + 25 AND o.x <= k.r + 25 THEN greatest(k.r, o.x + o.w) ELSE o.x + o.w END, CASE WHEN o.y <= k.b + 25 AND o.x <= k.r + 25 THEN greatest(k.b, o.y + o.h) ELSE o.y + o.h END,
    CASE WHEN o.y <= k.b + 25 AND o.x <= k.r + 25 THEN k.block_no ELSE k.block_no + 1 END, CASE WHEN o.y <= k.b + 25 AND o.x <= k.r + 25 THEN k.members + 1 ELSE 1 END
  FROM walk AS k JOIN o ON o.edition = k.edition AND o.page_number = k.page_number AND o.n = k.n + 1),
done AS (SELECT *, row_number() OVER (PARTITION BY edition, page_number, block_no ORDER BY n DESC) AS last FROM walk)
SELECT edition, page_number, block_no, x, y, r - x AS w, b - y AS h, members FROM done WHERE last = 1"""
_ACROSS, _DOWN = "least(x + w, b.x + b.w) - greatest(x, b.x)", "least(y + h, b.y + b.h) - greatest(y, b.y)"
_BOTH = f"(CASE WHEN {_ACROSS} > 0 AND {_DOWN} > 0 THEN ({_ACROSS}) * ({_DOWN}) ELSE 0.0 END)"
_SHARE = f"coalesce({_BOTH} / nullif(w * h + b.w * b.h - {_BOTH}, 0), 0.0) >= 0.14"
_APART = "sqrt(((x + w / 2) - (b.x + b.w / 2)) * ((x + w / 2) - (b.x + b.w / 2)) + ((y + h / 2) - (b.y + b.h / 2)) * ((y + h / 2) - (b.y + b.h / 2))) <= 40"
_FIRST_HIT = f"list_position(list_transform(rest, lambda b: {_SHARE} OR {_APART}), true)"
# The running box and those after it; a step takes in the first that is hit, or, with none, goes on to the next box.
MERGE_SQL = f"""WITH RECURSIVE {SHEET_SQL},
q AS (SELECT edition, page_number, list(struct_pack(x := x, y := y, w := w, h := h) ORDER BY y, x, w, h) AS l FROM sheet GROUP BY edition, page_number),
walk AS (
  SELECT *, {_FIRST_HIT} AS k FROM (SELECT edition, page_number, l[1].x AS x, l[1].y AS y, l[1].w AS w, l[1].h AS h, 1 AS members, l[2:] AS rest FROM q) AS s
  UNION ALL
  SELECT *, {_FIRST_HIT} AS k FROM (
    SELECT edition, page_number, CASE WHEN k > 0 THEN least(x, rest[k].x) ELSE rest[1].x END AS x, CASE WHEN k > 0 THEN least(y, rest[k].y) ELSE rest[1].y END AS y,
      CASE WHEN k > 0 THEN greatest(x + w, rest[k].x + rest[k].w) - least(x, rest[k].x) ELSE rest[1].w END AS w, CASE WHEN k > 0 THEN greatest(y + h, rest[k].y + rest[k].h) - least(y, rest[k].y) ELSE rest[1].h END AS h,
      CASE WHEN k > 0 THEN members + 1 ELSE 1 END AS members, CASE WHEN k > 0 THEN list_concat(rest[1:k - 1], rest[k + 1:]) ELSE rest[2:] END AS rest
    FROM walk WHERE k > 0 OR len(rest) > 0) AS s)
SELECT edition, page_number, x, y, w, h, CAST(members AS INTEGER) AS members FROM walk WHERE coalesce(k, 0) = 0"""
IOU_JOIN_SQL = f"""SELECT left_id, right_id, {_r6('iou')} AS iou FROM (
  SELECT a.row_id AS left_id, b.row_id AS right_id, {_iou('a.', 'b.')} AS iou FROM page_4_signs AS a JOIN page_4_signs AS b ON a.page = b.page AND a.row_id < b.row_id
  WHERE a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h) AS p WHERE iou >= 0.2"""
NEAREST_SQL = f"""WITH b AS (SELECT row_id, page, x + w / 2.0 AS cx, y + h / 2.0 AS cy, coalesce(trim(code), '') <> '' AS coded FROM page_4_signs),
d AS (SELECT a.row_id AS left_id, c.row_id AS right_id, sqrt((a.cx - c.cx) * (a.cx - c.cx) + (a.cy - c.cy) * (a.cy - c.cy)) AS distance
  FROM b AS a JOIN b AS c ON a.page = c.page WHERE NOT a.coded AND c.coded),
r AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY distance, right_id) AS n FROM d)
SELECT left_id, right_id, {_r6('distance')} AS distance FROM r WHERE n = 1"""

NMS_SQL = f"""WITH RECURSIVE b AS (SELECT row_id AS id, page, x, y, w, h, row_number() OVER (ORDER BY CAST(w AS BIGINT) * h DESC, coalesce(confidence, -1.0) DESC, row_id) AS n FROM page_4_signs),
pairs AS (SELECT later, earlier FROM (SELECT a.n AS later, c.n AS earlier, {_iou('a.', 'c.')} AS iou FROM b AS a JOIN b AS c ON a.page = c.page AND c.n < a.n
  WHERE a.x < c.x + c.w AND c.x < a.x + a.w AND a.y < c.y + c.h AND c.y < a.y + a.h) AS o WHERE iou >= 0.55),
nb AS (SELECT later, list(earlier) AS e FROM pairs GROUP BY later),
p AS (SELECT n, row_number() OVER (ORDER BY n) AS k FROM (SELECT later AS n FROM pairs UNION SELECT earlier FROM pairs) AS u),
walk AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS kept
  UNION ALL SELECT p.k, CASE WHEN nb.e IS NOT NULL AND list_has_any(nb.e, walk.kept) THEN walk.kept ELSE list_append(walk.kept, p.n) END FROM walk JOIN p ON p.k = walk.k + 1 LEFT JOIN nb ON nb.later = p.n),
survivors AS (SELECT unnest(kept) AS n FROM (SELECT kept FROM walk ORDER BY k DESC LIMIT 1) AS w)
SELECT id, page FROM b WHERE n NOT IN (SELECT n FROM p) OR n IN (SELECT n FROM survivors)"""


def queries() -> dict:
    return {f.__name__: f for f in (
        box_normalize, box_size_filter, box_fp_filter, box_clamp, box_pad, box_pad_fixed, box_expand, confidence_score, refine_retry,
        match_topk, page_match, page_match_all, match_summary, iou_threshold_join, nms_greedy, nearest_box, merge_boxes_fixpoint, row_bucketing, coalesce_text_boxes,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "box_normalize": BOX_NORMALIZE_SQL, "box_size_filter": BOX_SIZE_FILTER_SQL, "box_fp_filter": BOX_FP_FILTER_SQL, "box_clamp": BOX_CLAMP_SQL,
        "box_pad": BOX_PAD_SQL, "box_pad_fixed": _fixed(6), "box_expand": _fixed(10), "confidence_score": CONFIDENCE_SQL, "refine_retry": REFINE_SQL,
        "match_topk": MATCH_TOPK_SQL, "page_match": PAGE_MATCH_SQL, "page_match_all": PAGE_MATCH_ALL_SQL, "match_summary": MATCH_SUMMARY_SQL,
        "iou_threshold_join": IOU_JOIN_SQL, "nms_greedy": NMS_SQL, "nearest_box": NEAREST_SQL, "merge_boxes_fixpoint": MERGE_SQL, "row_bucketing": ROW_BUCKETING_SQL, "coalesce_text_boxes": COALESCE_SQL,
    }
