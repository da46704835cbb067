"""Queries of the training-data problems and, where SQL can state one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from platemark.llm import canonical, encode, leak, split, survivors, topn
from platemark.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_records(spark, folder).select("first_id", "code_id", "description_id")


def p1_records(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving records themselves."""
    return survivors.best_labels(table(spark, folder, "sign_mappings_clean"), table(spark, folder, "label_sources"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.map_to_canonical(table(spark, folder, "page_4_signs"), "row_id", "code", table(spark, folder, "sign_legend"), "code", "description")


def p4_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Entries that mean nothing of the list, with the number of their rows."""
    rows = table(spark, folder, "page_4_signs").select("row_id", "code")
    none = p4_found(spark, folder).filter("legend_code = ''").select("row_id")
    return rows.join(none, "row_id", "left_semi").groupBy("code").agg(F.count(F.lit(1)).alias("n_rows"))


def p4_steps(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows each step of the mapping decided."""
    signs, legend = table(spark, folder, "page_4_signs"), table(spark, folder, "sign_legend")
    return canonical.map_to_canonical(signs, "row_id", "code", legend, "code", "description", with_step=True).groupBy("step").agg(F.count(F.lit(1)).alias("n_rows"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda name: table(spark, folder, name)
    return topn.best_candidates(t("candidate_assignments"), t("reference_matcher_run_manifest"), t("page_4_signs"))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode_corpus(table(spark, folder, "documents"), "doc_id", "text")


def p7_passages(spark: SparkSession, folder: str) -> DataFrame:
    """The passages themselves, as spans of words to be removed."""
    return leak.leaked_passages(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "item_text")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leak.leaks(p7_passages(spark, folder), "doc_id", "item_id")


def p7_items(spark: SparkSession, folder: str) -> DataFrame:
    """Which items leaked, and into how many documents."""
    return p7_found(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))


def p8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_oversized(table(spark, folder, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_pieces(spark, folder).filter("piece_no = 0").select("doc_id")


def p8_cuts(spark: SparkSession, folder: str) -> DataFrame:
    """Where each piece ends, the depth of the valley there and its rank among those of the window."""
    return p8_pieces(spark, folder).select("doc_id", "piece_no", "end_char", "cut", F.round("depth", 6).alias("depth"), "depth_rank", "n_boundaries")


def p8_broken(spark: SparkSession, folder: str) -> DataFrame:
    """One row: how many pieces break a promise of the splitting; all are 0."""
    order = W.partitionBy("doc_id").orderBy("piece_no")
    pieces = p8_pieces(spark, folder).join(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id")
    pieces = pieces.withColumns({"before": F.lag("end_char").over(order), "after": F.lead("start_char").over(order)})
    natural = F.col("cut").isin("paragraph", "line", "sentence")
    promises = {
        "n_over_limit": F.col("n_tokens") > split.LIMIT,
        "n_gaps": F.coalesce(F.col("start_char") >= F.col("before"), F.col("start_char") != 0),
        "n_unfinished": F.col("after").isNull() & (F.col("end_char") != F.col("n_chars")),
        "n_overlap_wrong": F.col("before").isNotNull() & ~F.col("n_shared").between(split.OVERLAP, split.OVERLAP + 3),
        "n_text_wrong": F.length("text") != F.col("end_char") - F.col("start_char"),
        "n_not_deepest": F.when(natural, F.col("depth_rank") != 1).otherwise(F.col("depth_rank").isNotNull()),
    }
    return pieces.agg(*[F.coalesce(F.sum(F.coalesce(p, F.lit(True)).cast("bigint")), F.lit(0)).alias(n) for n, p in promises.items()])


P8_BROKEN_SQL = "SELECT " + ", ".join(f"CAST(0 AS BIGINT) AS {n}" for n in ("n_over_limit", "n_gaps", "n_unfinished", "n_overlap_wrong", "n_text_wrong", "n_not_deepest"))
P1_BASE = r"""
WITH named AS (
  SELECT mapping_id, code, description, label_source, updated_at,
         regexp_replace(replace(replace(lower(filename), '%20', ' '), chr(92), '/'), '^(.|\n)*/', '') AS f
  FROM sign_mappings_clean),
crops AS (
  SELECT n.mapping_id, n.code, n.description, n.updated_at, coalesce(s.trust, -2147483648) AS trust,
         regexp_extract(f, '^\s*page[\s_-]*0*([0-9]+)[\s_-]+([a-z]+)[\s_-]+0*([0-9]+)([a-z]?)(?:[^a-z0-9]|$)', 1) || '/' ||
         regexp_extract(f, '^\s*page[\s_-]*0*([0-9]+)[\s_-]+([a-z]+)[\s_-]+0*([0-9]+)([a-z]?)(?:[^a-z0-9]|$)', 2) || '/' ||
         regexp_extract(f, '^\s*page[\s_-]*0*([0-9]+)[\s_-]+([a-z]+)[\s_-]+0*([0-9]+)([a-z]?)(?:[^a-z0-9]|$)', 3) || '/' ||
         regexp_extract(f, '^\s*page[\s_-]*0*([0-9]+)[\s_-]+([a-z]+)[\s_-]+0*([0-9]+)([a-z]?)(?:[^a-z0-9]|$)', 4) AS crop,
         coalesce(regexp_matches(code, '[A-Za-z0-9]') AND lower(trim(code)) NOT IN ('unknown', 'tbd', 'n/a', 'none', 'no description')
           AND NOT regexp_matches(lower(trim(code)), '^unknown[ _-]*[0-9]+$'), false) AS has_code,
         coalesce(regexp_matches(description, '[A-Za-z0-9]') AND lower(trim(description)) NOT IN ('unknown', 'tbd', 'n/a', 'none', 'no description'), false) AS has_description
  FROM named AS n LEFT JOIN label_sources AS s ON n.label_source = s.label_source),
g AS (SELECT crop, min(mapping_id) AS first_id, count(*) AS n FROM crops WHERE crop <> '///' GROUP BY crop HAVING count(*) >= 2),
c AS (SELECT crop, mapping_id, row_number() OVER (PARTITION BY crop ORDER BY trust DESC, updated_at DESC NULLS LAST, mapping_id) AS r FROM crops WHERE has_code),
d AS (SELECT crop, mapping_id, row_number() OVER (PARTITION BY crop ORDER BY trust DESC, updated_at DESC NULLS LAST, mapping_id) AS r FROM crops WHERE has_description)
"""
P1_SQL = P1_BASE + """
SELECT g.first_id, coalesce(c.mapping_id, 0) AS code_id, coalesce(d.mapping_id, 0) AS description_id
FROM g LEFT JOIN c ON c.crop = g.crop AND c.r = 1 LEFT JOIN d ON d.crop = g.crop AND d.r = 1
"""
P1_RECORDS_SQL = P1_BASE + """
SELECT g.crop, g.first_id, g.n, coalesce(c.mapping_id, 0) AS code_id, mc.code, coalesce(d.mapping_id, 0) AS description_id, md.description
FROM g LEFT JOIN c ON c.crop = g.crop AND c.r = 1 LEFT JOIN d ON d.crop = g.crop AND d.r = 1
LEFT JOIN sign_mappings_clean AS mc ON mc.mapping_id = c.mapping_id LEFT JOIN sign_mappings_clean AS md ON md.mapping_id = d.mapping_id
"""
P5_SQL = """
WITH latest AS (
  SELECT * FROM (
    SELECT candidate_assignment_id, run_id, filename, reference_position_id, match_score,
           geometry_agreement.iou AS iou, geometry_agreement.center_distance AS center_distance,
           row_number() OVER (PARTITION BY candidate_assignment_id ORDER BY ingested_at DESC NULLS LAST,
             match_score DESC NULLS LAST, geometry_agreement.iou DESC NULLS LAST) AS n
    FROM candidate_assignments WHERE candidate_assignment_id IS NOT NULL) AS d
  WHERE n = 1 AND match_score IS NOT NULL),
lim AS (
  SELECT run_id, top_k FROM (
    SELECT run_id, top_k, row_number() OVER (PARTITION BY run_id ORDER BY run_at DESC, top_k DESC) AS n
    FROM reference_matcher_run_manifest) AS m WHERE n = 1),
ranked AS (
  SELECT l.run_id, l.filename, l.candidate_assignment_id, k.top_k,
         row_number() OVER (PARTITION BY l.run_id, l.filename ORDER BY l.match_score DESC, l.iou DESC NULLS LAST,
           l.center_distance ASC NULLS LAST, l.reference_position_id ASC NULLS LAST, l.candidate_assignment_id ASC) AS rank_no
  FROM latest AS l JOIN lim AS k ON l.run_id = k.run_id)
SELECT run_id, filename, CAST(rank_no AS INTEGER) AS rank_no, candidate_assignment_id
FROM ranked WHERE rank_no <= top_k AND filename IN (SELECT filename FROM page_4_signs WHERE filename IS NOT NULL)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found, "p1_records": p1_records,
        "p4_found": p4_found, "p4_unmatched": p4_unmatched, "p4_steps": p4_steps,
        "p5_found": p5_found,
        "p6_ids": p6_ids,
        "p7_found": p7_found, "p7_passages": p7_passages, "p7_items": p7_items,
        "p8_found": p8_found, "p8_pieces": p8_pieces, "p8_cuts": p8_cuts, "p8_broken": p8_broken,
    }


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p1_records": P1_RECORDS_SQL, "p5_found": P5_SQL, "p8_broken": P8_BROKEN_SQL}
