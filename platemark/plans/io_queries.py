"""Queries over sources, sinks, images and grid regions: what is written is read back, what is drawn is found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.functions import pixels as px
from platemark.operators import grid, legend, merge
from platemark.session import remove_at_exit, shared_path
from platemark.sources import images, io
from platemark.sources.tables import table


def _folder(spark: SparkSession, name: str) -> str:
    path = shared_path(spark, name)
    remove_at_exit(spark, path)
    return path


def json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Crops written as JSON and read again, lists and nulls included."""
    signs = table(spark, folder, "page_4_signs").select("row_id", "filename", "code", "confidence", "warnings")
    path = _folder(spark, "signs-json")
    io.write_json(signs, path)
    back = io.read_json(spark, path, signs.schema, lines=True)
    return back.select("row_id", "filename", "code", "confidence", F.array_join("warnings", "|", "~").alias("warnings"))


JSON_SQL = "SELECT row_id, filename, code, confidence, array_to_string(list_transform(warnings, lambda w: coalesce(w, '~')), '|') AS warnings FROM page_4_signs"


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Crops written as CSV, their lists as JSON text, and read again."""
    signs = table(spark, folder, "page_4_signs").select("row_id", "status", "confidence", "x", "warnings")
    path = _folder(spark, "signs-csv")
    io.write_csv(signs, path)
    back = io.read_csv(spark, path, signs.schema, ("warnings",))
    return back.select("row_id", "status", "confidence", "x", F.size("warnings").alias("n_warnings"))


CSV_SQL = "SELECT row_id, status, confidence, x, CASE WHEN warnings IS NULL THEN NULL ELSE CAST(len(warnings) AS INTEGER) END AS n_warnings FROM page_4_signs"


def missing_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that runs read or write and that aren't among their inputs and the page images."""
    runs = table(spark, folder, "reference_matcher_run_manifest")
    read = runs.select(F.explode("inputs.extracted_metadata_files").alias("path"))
    files = read.union(table(spark, folder, "manual_pages").select("page_image_path")).dropna()
    wanted = read.union(runs.select("output_file")).dropna().distinct().select("path", F.element_at(F.split("path", "/"), -1).alias("name"))
    return io.missing_sources(wanted, files, "name").select("path", "name")


MISSING_FILES_SQL = """WITH r AS (SELECT unnest(inputs.extracted_metadata_files) AS path FROM reference_matcher_run_manifest),
f AS (SELECT list_last(string_split(path, '/')) AS name FROM (SELECT path FROM r UNION ALL SELECT page_image_path FROM manual_pages) AS a WHERE path IS NOT NULL),
w AS (SELECT DISTINCT path, list_last(string_split(path, '/')) AS name FROM (SELECT path FROM r UNION ALL SELECT output_file FROM reference_matcher_run_manifest) AS b WHERE path IS NOT NULL)
SELECT path, name FROM w WHERE name NOT IN (SELECT name FROM f)"""


def page_types(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of each type."""
    pages = table(spark, folder, "manual_pages")
    return pages.groupBy(grid.page_type(F.col("page_number")).alias("page_type")).agg(F.count(F.lit(1)).alias("n_pages"))


PAGE_TYPES_SQL = "SELECT CASE WHEN page_number = 5 THEN 'legend' ELSE 'standard' END AS page_type, count(*) AS n_pages FROM manual_pages GROUP BY 1"


def region_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Problems of regions made of crops: two columns and rows each, of sizes that may not be positive, and a count that may be wrong."""
    s = table(spark, folder, "page_4_signs")
    regions = s.select(
        "row_id", F.array(F.col("w") - 60, F.col("w")).alias("column_widths"), F.array("h").alias("row_heights"),
        F.when(F.col("row_id") % 7 == 0, 3).otherwise(2).alias("columns"), F.when(F.col("row_id") % 5 == 0, 2).otherwise(1).alias("rows"),
    )
    return grid.invalid_regions(regions, ["row_id"])


REGION_RULES_SQL = """SELECT row_id, 'column_widths' AS problem FROM page_4_signs WHERE row_id % 7 = 0 UNION ALL SELECT row_id, 'row_heights' FROM page_4_signs WHERE row_id % 5 = 0
UNION ALL SELECT row_id, 'not_positive' FROM page_4_signs WHERE w <= 60 OR h <= 0"""


def body_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Posts laid out as text blocks: those of a page's body."""
    d = table(spark, folder, "documents")
    blocks = d.select("doc_id", (F.col("doc_id") * 37 % 2000).cast("double").alias("x0"), (F.col("doc_id") * 91 % 2400).cast("double").alias("y0"), "text")
    return legend.body_blocks(blocks).select("doc_id", "x0", "y0")


BODY_BLOCKS_SQL = """SELECT doc_id, CAST(doc_id * 37 % 2000 AS DOUBLE) AS x0, CAST(doc_id * 91 % 2400 AS DOUBLE) AS y0 FROM documents
WHERE doc_id * 37 % 2000 < 1320 AND doc_id * 91 % 2400 > 150 AND doc_id * 91 % 2400 < 1800 AND length(trim(text)) > 20"""


def ink_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Dark pixels by row of pages whose pixels are made of crops."""
    pixels = table(spark, folder, "page_4_signs").select("page", (F.col("y") % 50).alias("line"), (F.col("row_id") * 37 % 256).alias("value"))
    return images.ink_profile(pixels, ["page"], "line").select("page", "line", "ink", F.round("density", 9).alias("density"))


INK_SQL = "SELECT page, y % 50 AS line, CAST(sum(CASE WHEN row_id * 37 % 256 < 245 THEN 1 ELSE 0 END) AS BIGINT) AS ink, round(avg(CASE WHEN row_id * 37 % 256 < 245 THEN 1 ELSE 0 END), 9) AS density FROM page_4_signs GROUP BY 1, 2"


def one_record(spark: SparkSession, folder: str) -> DataFrame:
    """The record of the smallest position id, found by its key."""
    positions = table(spark, folder, "reference_positions").select("reference_position_id", "edition_id", "page_id", "official_code")
    return merge.get_one(positions, "reference_position_id", positions.agg(F.min("reference_position_id")).first()[0])


ONE_SQL = "SELECT reference_position_id, edition_id, page_id, official_code FROM reference_positions WHERE reference_position_id = (SELECT min(reference_position_id) FROM reference_positions)"


def all_files_of_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Each run's input and output files, once each and in order."""
    runs = table(spark, folder, "reference_matcher_run_manifest")
    own = F.array("inputs.reference_positions", "inputs.reference_cells", "output_file")
    files = merge.sorted_union("inputs.extracted_metadata_files", F.filter(own, lambda f: f.isNotNull()))
    return runs.select("run_id", "run_at", F.array_join(files, "|").alias("files"))


RUN_FILES_SQL = """SELECT run_id, run_at, array_to_string(list_sort(list_distinct(list_concat(coalesce(list_filter(inputs.extracted_metadata_files, lambda f: f IS NOT NULL), []),
  list_filter([inputs.reference_positions, inputs.reference_cells, output_file], lambda f: f IS NOT NULL)))), '|') AS files FROM reference_matcher_run_manifest"""


def _drawn(spark: SparkSession, folder: str) -> DataFrame:
    """A PNG file for each page, with one dark rectangle (left, top, width, height) in it."""
    n, size = F.coalesce("page_number", F.lit(0)), F.coalesce("image_width", F.lit(0))
    pages = table(spark, folder, "manual_pages").filter("page_id IS NOT NULL").select(
        F.col("page_id").alias("path"), (n % 40 + 10).alias("left"), (size % 30 + 10).alias("top"), (n * 7 % 25 + 8).alias("width"), (size * 3 % 20 + 8).alias("height"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            files = []
            for r in batch.itertuples():
                image = np.full((80, 96, 3), 255, np.uint8)
                image[r.top : r.top + r.height, r.left : r.left + r.width] = (200, 16, 16) if r.left % 2 else 0
                files.append(px.encode_png(image))
            yield batch.assign(content=files)

    return pages.mapInPandas(draw, "path string, left int, top int, width int, height int, content binary")


def detected_regions(spark: SparkSession, folder: str) -> DataFrame:
    """What is found on the drawn pages."""
    return images.detect_regions(_drawn(spark, folder), with_edges=False).drop("source")


_LEFT, _TOP = "(coalesce(page_number, 0) % 40 + 10)", "(coalesce(image_width, 0) % 30 + 10)"
_SIZE = "coalesce(page_number, 0) * 7 % 25 + 8 AS w, coalesce(image_width, 0) * 3 % 20 + 8 AS h"
DETECTED_SQL = f"SELECT page_id AS path, {_LEFT} AS x, {_TOP} AS y, {_SIZE} FROM manual_pages WHERE page_id IS NOT NULL"


def cropped_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Crops of what is drawn, with and without some space around; tight ones touch their edge if they are dark (of one other colour, nothing in them is)."""
    files = _drawn(spark, folder)
    space = F.when(F.col("left") % 3 == 0, 0).otherwise(4)
    boxes = files.select("path", F.concat("path", F.lit(".png")).alias("filename"), (F.col("left") - space).alias("x"), (F.col("top") - space).alias("y"), (F.col("width") + 2 * space).alias("w"), (F.col("height") + 2 * space).alias("h"))
    crops = images.crops(files, boxes)
    number = lambda at: F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int")
    return crops.select("filename", number(17).alias("width"), number(21).alias("height"), "touches_edge")


CROPPED_SQL = f"""SELECT path || '.png' AS filename, CASE WHEN x % 3 = 0 THEN w ELSE w + 8 END AS width, CASE WHEN x % 3 = 0 THEN h ELSE h + 8 END AS height, x % 6 = 0 AS touches_edge FROM ({DETECTED_SQL}) AS d"""


def queries() -> dict:
    return {f.__name__: f for f in (json_round_trip, csv_round_trip, missing_files, page_types, region_rules, body_blocks, ink_profile, one_record, all_files_of_runs, detected_regions, cropped_regions)}


def oracle_sql() -> dict[str, str]:
    return {
        "json_round_trip": JSON_SQL, "csv_round_trip": CSV_SQL, "missing_files": MISSING_FILES_SQL, "page_types": PAGE_TYPES_SQL, "region_rules": REGION_RULES_SQL, "body_blocks": BODY_BLOCKS_SQL,
        "ink_profile": INK_SQL, "one_record": ONE_SQL, "all_files_of_runs": RUN_FILES_SQL, "detected_regions": DETECTED_SQL, "cropped_regions": CROPPED_SQL,
    }
