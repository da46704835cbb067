"""Queries that merge, publish, upsert, compare and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.functions import text
from platemark.functions.geometry import round6
from platemark.operators import matching, merge, sequence
from platemark.operators.sizing import lookup, small_or_shuffled
from platemark.sources.tables import table

PRIORITY = {"clean": 1, "complete": 2, "all": 3}


def priority_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Three sources of labels, in order of priority, folded by filename."""
    m = table(spark, folder, "sign_mappings_clean").filter(F.col("label_source").isin(list(PRIORITY)))
    rank = F.coalesce(*[F.when(F.col("label_source") == s, p) for s, p in PRIORITY.items()])
    return merge.priority_merge(m, "filename", [rank, F.col("mapping_id")], "code", "description", ["page", "label_source", "confidence"])


MERGE_CTE = """src AS (SELECT filename, page, label_source, confidence, mapping_id, trim(code) AS code, trim(description) AS description,
  CASE label_source WHEN 'clean' THEN 1 WHEN 'complete' THEN 2 ELSE 3 END AS p,
  coalesce(trim(code) <> '' AND NOT starts_with(upper(trim(code)), 'UNKNOWN'), false) AS has_code, coalesce(trim(description) <> '', false) AS has_text
  FROM sign_mappings_clean WHERE label_source IN ('clean', 'complete', 'all')),
c AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY p DESC, mapping_id DESC) AS n_last,
  row_number() OVER (PARTITION BY filename, has_code ORDER BY p, mapping_id) AS n_code, row_number() OVER (PARTITION BY filename, has_text ORDER BY p, mapping_id) AS n_text
  FROM src WHERE has_code OR has_text),
merged AS (SELECT filename, coalesce(max(CASE WHEN has_code AND n_code = 1 THEN code END), '') AS code, coalesce(max(CASE WHEN has_text AND n_text = 1 THEN description END), '') AS description,
  max(CASE WHEN n_last = 1 THEN page END) AS page, max(CASE WHEN n_last = 1 THEN label_source END) AS label_source, max(CASE WHEN n_last = 1 THEN confidence END) AS confidence FROM c GROUP BY filename)"""
PRIORITY_MERGE_SQL = f"WITH {MERGE_CTE} SELECT filename, code, description, page, label_source, confidence FROM merged"


def last_wins_legend(spark: SparkSession, folder: str) -> DataFrame:
    return matching.last_wins(table(spark, folder, "sign_legend"), "code", F.col("legend_row"), ["description"])


LEGEND_CTE = "legend AS (SELECT code, description FROM (SELECT code, description, row_number() OVER (PARTITION BY code ORDER BY legend_row DESC) AS n FROM sign_legend) AS l WHERE n = 1)"


def _content(df: DataFrame) -> DataFrame:
    return df.withColumn("sha256", F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page", "x", "y", "w", "h")]), 256))


def publish_records(spark: SparkSession, folder: str) -> DataFrame:
    """Crops with merged labels, legend wording first, and links between crops of the same content."""
    signs = _content(table(spark, folder, "page_4_signs").select("row_id", "filename", "page", "code", "confidence", "x", "y", "w", "h"))
    labels = priority_merge(spark, folder).select("filename", F.col("code").alias("m_code"), F.col("description").alias("m_text"), F.col("label_source").alias("m_source"))
    joined = lookup(signs, labels, ["filename"], spread_by="row_id")
    code = F.coalesce(F.nullif(F.col("m_code"), F.lit("")), F.nullif(F.trim("code"), F.lit("")), F.lit(""))
    legend = small_or_shuffled(last_wins_legend(spark, folder)).select(F.col("code").alias("final_code"), F.col("description").alias("l_text"))
    named = joined.withColumn("final_code", code).join(legend, "final_code", "left")
    groups = signs.groupBy("sha256").agg(F.min("filename").alias("canonical"), F.count(F.lit(1)).alias("duplicate_group_size"))
    linked = lookup(named, groups.filter("duplicate_group_size > 1"), ["sha256"], spread_by="row_id")
    return linked.select(
        "row_id", "filename", F.col("final_code").alias("code"),
        F.coalesce(F.nullif(F.col("l_text"), F.lit("")), F.nullif(F.col("m_text"), F.lit("")), F.lit("")).alias("description"),
        F.coalesce(F.nullif(F.col("confidence"), F.lit(0.0)), F.lit(0.0)).alias("confidence"), F.coalesce("m_source", F.lit("")).alias("label_source"),
        "sha256", F.coalesce("duplicate_group_size", F.lit(1)).alias("duplicate_group_size"),
        F.when(F.col("canonical").isNull() | (F.col("canonical") == F.col("filename")), "").otherwise(F.col("canonical")).alias("duplicate_of"),
    )


PUBLISH_CTE = f"""{MERGE_CTE}, {LEGEND_CTE},
signs AS (SELECT row_id, filename, code, confidence, sha256(coalesce(CAST(page AS VARCHAR), '') || '|' || coalesce(CAST(x AS VARCHAR), '') || '|' || coalesce(CAST(y AS VARCHAR), '') || '|' || coalesce(CAST(w AS VARCHAR), '') || '|' || coalesce(CAST(h AS VARCHAR), '')) AS sha256 FROM page_4_signs),
g AS (SELECT sha256, min(filename) AS canonical, count(*) AS n FROM signs GROUP BY sha256),
named AS (SELECT s.*, coalesce(nullif(m.code, ''), nullif(trim(s.code), ''), '') AS final_code, m.description AS m_text, m.label_source AS m_source FROM signs AS s LEFT JOIN merged AS m ON m.filename = s.filename),
published AS (SELECT d.row_id, d.filename, d.final_code AS code, coalesce(nullif(l.description, ''), nullif(d.m_text, ''), '') AS description, coalesce(d.confidence, 0.0) AS confidence,
  coalesce(d.m_source, '') AS label_source, d.sha256, g.n AS duplicate_group_size, CASE WHEN g.n > 1 AND g.canonical <> d.filename THEN g.canonical ELSE '' END AS duplicate_of
  FROM named AS d JOIN g ON g.sha256 = d.sha256 LEFT JOIN legend AS l ON l.code = d.final_code)"""
PUBLISH_SQL = f"WITH {PUBLISH_CTE} SELECT row_id, filename, code, description, confidence, label_source, sha256, duplicate_group_size, duplicate_of FROM published"


def publish_summary(spark: SparkSession, folder: str) -> DataFrame:
    p = publish_records(spark, folder)
    blank = lambda c: F.col(c) == ""
    return p.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~blank("code")).alias("coded"), F.count_if(~blank("description")).alias("described"),
        F.count_if(blank("code") | blank("description")).alias("needs_label"), F.count_if(F.col("duplicate_of") != "").alias("duplicates"),
        F.countDistinct(F.when(F.col("duplicate_group_size") > 1, F.col("sha256"))).alias("duplicate_groups"),
    )


PUBLISH_SUMMARY_SQL = f"""WITH {PUBLISH_CTE} SELECT count(*) AS n_rows, count(*) FILTER (WHERE code <> '') AS coded, count(*) FILTER (WHERE description <> '') AS described,
  count(*) FILTER (WHERE code = '' OR description = '') AS needs_label, count(*) FILTER (WHERE duplicate_of <> '') AS duplicates,
  count(DISTINCT CASE WHEN duplicate_group_size > 1 THEN sha256 END) AS duplicate_groups FROM published"""


def dup_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that occur more than once: the smallest id and the surplus."""
    d = table(spark, folder, "documents").filter(F.col("text").isNotNull()).select("doc_id", F.sha2("text", 256).alias("sha256"))
    g = d.groupBy("sha256").agg(F.min("doc_id").alias("canonical"), F.count(F.lit(1)).alias("n_members"))
    return g.filter("n_members > 1").withColumn("surplus", F.col("n_members") - 1)


DUP_GROUPS_SQL = "SELECT sha256, min(doc_id) AS canonical, count(*) AS n_members, count(*) - 1 AS surplus FROM (SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL) AS d GROUP BY sha256 HAVING count(*) > 1"


def dup_links(spark: SparkSession, folder: str) -> DataFrame:
    """Every surplus document with the one that stands for its text."""
    d = table(spark, folder, "documents").filter(F.col("text").isNotNull()).select("doc_id", F.sha2("text", 256).alias("sha256"))
    g = dup_groups(spark, folder).select("sha256", F.col("canonical").alias("duplicate_of"))
    return lookup(d, g, ["sha256"], spread_by="doc_id").filter("duplicate_of <> doc_id").select("doc_id", "duplicate_of")


DUP_LINKS_SQL = "SELECT doc_id, duplicate_of FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS duplicate_of FROM documents WHERE text IS NOT NULL) AS d WHERE doc_id <> duplicate_of"


def sync_plan(spark: SparkSession, folder: str) -> DataFrame:
    return merge.sync_plan(table(spark, folder, "page_4_signs"), table(spark, folder, "sign_mappings_clean"), "filename")


SYNC_SQL = """SELECT DISTINCT filename, 'remove' AS action FROM page_4_signs WHERE filename IS NOT NULL AND filename NOT IN (SELECT filename FROM sign_mappings_clean WHERE filename IS NOT NULL)
UNION ALL SELECT DISTINCT filename, 'copy' AS action FROM sign_mappings_clean WHERE filename IS NOT NULL AND filename NOT IN (SELECT filename FROM page_4_signs WHERE filename IS NOT NULL)"""


def upsert_row(spark: SparkSession, folder: str) -> DataFrame:
    """Deleted editions come again under a new status, with a hash but no path, and each with a new sibling."""
    base = table(spark, folder, "manual_editions").select("edition_id", "source_pdf_path", "source_pdf_sha256", "status")
    gone = table(spark, folder, "manual_editions").filter("deleted_at IS NOT NULL")
    none = F.lit(None).cast("string")
    again = gone.select("edition_id", none.alias("source_pdf_path"), F.sha2("edition_id", 256).alias("source_pdf_sha256"), F.lit("restored").alias("status"))
    sibling = gone.select(F.concat("edition_id", F.lit("-b")).alias("edition_id"), "source_pdf_path", none.alias("source_pdf_sha256"), F.lit("new").alias("status"))
    return merge.upsert(base, again.unionByName(sibling), "edition_id")


UPSERT_SQL = """WITH n AS (SELECT edition_id, NULL AS source_pdf_path, sha256(edition_id) AS source_pdf_sha256, 'restored' AS status FROM manual_editions WHERE deleted_at IS NOT NULL
  UNION ALL SELECT edition_id || '-b', source_pdf_path, NULL, 'new' FROM manual_editions WHERE deleted_at IS NOT NULL)
SELECT coalesce(n.edition_id, b.edition_id) AS edition_id, coalesce(n.source_pdf_path, b.source_pdf_path) AS source_pdf_path, coalesce(n.source_pdf_sha256, b.source_pdf_sha256) AS source_pdf_sha256, coalesce(n.status, b.status) AS status
FROM manual_editions AS b FULL OUTER JOIN n ON n.edition_id = b.edition_id"""


def upsert_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Editions with deleted pages get all their pages anew, under numbers from 1001."""
    base = table(spark, folder, "manual_pages").select("page_id", "edition_id", "page_number")
    deleted = table(spark, folder, "manual_pages").filter("deleted_at IS NOT NULL").select("edition_id").distinct()
    new = base.join(deleted, "edition_id", "left_semi").select("page_id", "edition_id", (F.col("page_number") + 1000).alias("page_number"))
    return merge.replace_partition(base, new, "edition_id")


UPSERT_PARTITION_SQL = """SELECT page_id, edition_id, CASE WHEN edition_id IN (SELECT edition_id FROM manual_pages WHERE deleted_at IS NOT NULL) THEN page_number + 1000 ELSE page_number END AS page_number FROM manual_pages"""


def bag_and_distinct_union(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes and padded boxes: rows of their bag and of their distinct union, and how many are in both."""
    s = table(spark, folder, "page_4_signs")
    a, b = s.select("page", "x", "y", "w", "h"), s.select("page", F.col("padded_x").alias("x"), F.col("padded_y").alias("y"), F.col("padded_w").alias("w"), F.col("padded_h").alias("h"))
    bag, union = a.unionByName(b), a.unionByName(b).distinct()
    both = a.distinct().join(b.distinct(), a.columns, "left_semi")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return count(bag, "bag_rows").crossJoin(count(union, "distinct_rows")).crossJoin(count(both, "in_both"))


UNION_SQL = """WITH a AS (SELECT page, x, y, w, h FROM page_4_signs), b AS (SELECT page, padded_x AS x, padded_y AS y, padded_w AS w, padded_h AS h FROM page_4_signs)
SELECT (SELECT count(*) FROM a) + (SELECT count(*) FROM b) AS bag_rows, (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b) AS u) AS distinct_rows,
  (SELECT count(*) FROM (SELECT * FROM a WHERE page IS NOT NULL INTERSECT SELECT * FROM b) AS i) AS in_both"""


def natural_sort_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes = table(spark, folder, "sign_legend").select("code").distinct()
    letters, number = text.code_key(F.col("code"))
    return sequence.with_ordinal(codes, [letters, number, F.col("code")])


NATURAL_CTE = """sorted_codes AS (SELECT code, row_number() OVER (ORDER BY regexp_replace(code, '[^A-Za-z]', '', 'g'), CAST(regexp_replace(code, '[^0-9]', '', 'g') AS BIGINT), code) AS ordinal FROM (SELECT DISTINCT code FROM sign_legend) AS c)"""


def positional_zip(spark: SparkSession, folder: str) -> DataFrame:
    """Crops in reading order get codes in natural order, until the codes run out."""
    crops = table(spark, folder, "page_4_signs").select("row_id", "page", "y", "x").filter("page IS NOT NULL")
    placed = sequence.with_ordinal(crops, [F.col("page"), F.col("y"), F.col("x"), F.col("row_id")])
    return placed.join(natural_sort_codes(spark, folder), "ordinal").select("ordinal", "row_id", "code")


ZIP_SQL = f"""WITH {NATURAL_CTE}, placed AS (SELECT row_id, row_number() OVER (ORDER BY page, y, x, row_id) AS ordinal FROM page_4_signs WHERE page IS NOT NULL)
SELECT p.ordinal, p.row_id, n.code FROM placed AS p JOIN sorted_codes AS n ON n.ordinal = p.ordinal"""


def mapping_output(spark: SparkSession, folder: str) -> DataFrame:
    """The zipped crops as mappings: file, page, code and the legend's wording or ''."""
    crops = table(spark, folder, "page_4_signs").select("row_id", "filename", "page")
    zipped = positional_zip(spark, folder).join(crops, "row_id")
    return zipped.join(last_wins_legend(spark, folder), "code", "left").select("filename", "page", "code", F.coalesce("description", F.lit("")).alias("description"))


MAPPING_SQL = f"""WITH {NATURAL_CTE}, {LEGEND_CTE}, placed AS (SELECT filename, page, row_number() OVER (ORDER BY page, y, x, row_id) AS ordinal FROM page_4_signs WHERE page IS NOT NULL)
SELECT p.filename, p.page, n.code, coalesce(l.description, '') AS description FROM placed AS p JOIN sorted_codes AS n ON n.ordinal = p.ordinal LEFT JOIN legend AS l ON l.code = n.code"""


def completion_criteria(spark: SparkSession, folder: str) -> DataFrame:
    """One row of criteria over published crops; the last is null without evidence."""
    p = publish_records(spark, folder)
    all_of = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    found = p.agg(
        all_of(F.col("filename").isNotNull()).alias("has_filename"), all_of(F.col("code") != "").alias("all_coded"), all_of(F.col("description") != "").alias("all_described"),
        all_of(F.col("duplicate_group_size") >= 1).alias("duplicates_linked"), all_of(F.col("confidence").between(0, 100)).alias("confidence_in_range"),
        F.coalesce(F.bool_or(F.col("duplicate_of") != ""), F.lit(False)).alias("any_duplicate"), F.max(F.when(F.col("code") != "", F.lit(1))).alias("evidence"),
    )
    deferred = F.when(F.col("evidence").isNotNull(), F.col("has_filename") & F.col("confidence_in_range") & F.col("duplicates_linked"))
    return found.withColumn("publishable", deferred).drop("evidence")


COMPLETION_SQL = f"""WITH {PUBLISH_CTE} SELECT coalesce(bool_and(filename IS NOT NULL), true) AS has_filename, coalesce(bool_and(code <> ''), true) AS all_coded, coalesce(bool_and(description <> ''), true) AS all_described,
  coalesce(bool_and(duplicate_group_size >= 1), true) AS duplicates_linked, coalesce(bool_and(confidence BETWEEN 0 AND 100), true) AS confidence_in_range, coalesce(bool_or(duplicate_of <> ''), false) AS any_duplicate,
  CASE WHEN count(*) FILTER (WHERE code <> '') > 0 THEN coalesce(bool_and(filename IS NOT NULL), true) AND coalesce(bool_and(confidence BETWEEN 0 AND 100), true) AND coalesce(bool_and(duplicate_group_size >= 1), true) END AS publishable FROM published"""


def canonical_hash(spark: SparkSession, folder: str) -> DataFrame:
    """A digest of each run's candidates, whatever the order of their rows."""
    c = table(spark, folder, "candidate_assignments").select("run_id", "candidate_assignment_id", "filename", "reference_position_id", "status")
    return merge.canonical_hash(c, ["candidate_assignment_id", "filename", "reference_position_id", "status"], ["run_id"])


def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as they were registered and as they are: deleted pages are gone, others changed with their edition."""
    pages = table(spark, folder, "manual_pages")
    before = pages.select("page_id", F.col("page_image_sha256").alias("v"))
    after = pages.filter("deleted_at IS NULL").select("page_id", F.when(F.col("page_number") % 10 == 0, F.sha2("page_id", 256)).otherwise(F.col("page_image_sha256")).alias("v"))
    return merge.snapshot_diff(before, after, "page_id", "v")


SNAPSHOT_SQL = """WITH a AS (SELECT page_id, page_image_sha256 AS v FROM manual_pages), b AS (SELECT page_id, CASE WHEN page_number % 10 = 0 THEN sha256(page_id) ELSE page_image_sha256 END AS v FROM manual_pages WHERE deleted_at IS NULL)
SELECT coalesce(a.page_id, b.page_id) AS page_id, CASE WHEN a.page_id IS NULL THEN 'added' WHEN b.page_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL OUTER JOIN b ON a.page_id = b.page_id WHERE a.page_id IS NULL OR b.page_id IS NULL OR a.v IS DISTINCT FROM b.v"""


def page_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and means per page; 0.0 where there is nothing to average."""
    s = table(spark, folder, "page_4_signs")
    area, padded = F.col("w").cast("long") * F.col("h"), F.col("padded_w").cast("long") * F.col("padded_h")
    mean = lambda c: round6(F.coalesce(F.sum(c).cast("double") / F.count(c), F.lit(0.0)))
    return s.groupBy("page").agg(
        F.count(F.lit(1)).alias("exported"), F.count_if(F.col("status") == "warning").alias("rejected"), F.count_if(F.coalesce(F.trim("code"), F.lit("")) == "").alias("missing_codes"),
        mean(area).alias("avg_crop_area"), mean(padded - area).alias("avg_padding"), mean(F.col("confidence")).alias("avg_confidence"),
        round6(F.avg(F.when(F.col("status") == "ok", 1.0).otherwise(0.0)) * 100).alias("success_rate"),
    )


PAGE_STATS_SQL = """SELECT page, count(*) AS exported, count(*) FILTER (WHERE status = 'warning') AS rejected, count(*) FILTER (WHERE coalesce(trim(code), '') = '') AS missing_codes,
  floor(coalesce(CAST(sum(CAST(w AS BIGINT) * h) AS DOUBLE) / count(*), 0.0) * 1000000.0 + 0.5) / 1000000.0 AS avg_crop_area,
  floor(coalesce(CAST(sum(CAST(padded_w AS BIGINT) * padded_h - CAST(w AS BIGINT) * h) AS DOUBLE) / count(*), 0.0) * 1000000.0 + 0.5) / 1000000.0 AS avg_padding,
  floor(coalesce(sum(confidence) / count(confidence), 0.0) * 1000000.0 + 0.5) / 1000000.0 AS avg_confidence,
  floor(CAST(count(*) FILTER (WHERE status = 'ok') AS DOUBLE) / count(*) * 100 * 1000000.0 + 0.5) / 1000000.0 AS success_rate FROM page_4_signs GROUP BY page"""


def queries() -> dict:
    return {f.__name__: f for f in (
        priority_merge, last_wins_legend, publish_records, publish_summary, dup_groups, dup_links, sync_plan, upsert_row, upsert_partition, bag_and_distinct_union,
        natural_sort_codes, positional_zip, mapping_output, completion_criteria, canonical_hash, snapshot_diff, page_stats,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "priority_merge": PRIORITY_MERGE_SQL, "last_wins_legend": f"WITH {LEGEND_CTE} SELECT code, description FROM legend", "publish_records": PUBLISH_SQL,
        "publish_summary": PUBLISH_SUMMARY_SQL, "dup_groups": DUP_GROUPS_SQL, "dup_links": DUP_LINKS_SQL, "sync_plan": SYNC_SQL, "upsert_row": UPSERT_SQL,
        "upsert_partition": UPSERT_PARTITION_SQL, "bag_and_distinct_union": UNION_SQL, "natural_sort_codes": f"WITH {NATURAL_CTE} SELECT code, ordinal FROM sorted_codes",
        "positional_zip": ZIP_SQL, "mapping_output": MAPPING_SQL, "completion_criteria": COMPLETION_SQL, "canonical_hash": CANONICAL_SQL, "snapshot_diff": SNAPSHOT_SQL, "page_stats": PAGE_STATS_SQL,
    }


_VALUES = " || ".join(f"CASE WHEN {c} IS NULL THEN 'n' ELSE 's' || strlen({c}) || ':' || {c} END" for c in ("candidate_assignment_id", "filename", "reference_position_id", "status"))
_QUARTERS = " || '-' || ".join(f"CAST(sum(CAST(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS UBIGINT) AS HUGEINT)) AS VARCHAR)" for i in range(4))
CANONICAL_SQL = f"SELECT run_id, count(*) AS n_rows, {_QUARTERS} AS digest FROM (SELECT run_id, sha256({_VALUES}) AS h FROM candidate_assignments) AS s GROUP BY run_id"
