"""Parsing of legends: lines of codes and descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platemark.functions import text as t
from platemark.operators.running import Running, running

#: A code of a legend (fixed value).
CODE = r"[A-Z]{1,3}[0-9]{1,3}(?:\.[0-9]+)?"
#: A line that begins with codes, and the rest of it.
CODES_LINE = rf"(?i)^({CODE}(?:[,&]\s*{CODE})*)\s*(.*)$"
#: A single code of letters and three digits, and its description.
SIMPLE_LINE = r"^([A-Z]{1,2}[0-9]{3})\s*[–-]?\s*(.+)$"


def parse(lines: DataFrame, block: str, place: str, line: str) -> DataFrame:
    """(block, line_no, code, description) of the lines of each block, in order of ``place``.

    A line that begins with codes and goes on with a valid description gives
    an entry for each code; without one its codes wait for the next valid
    line, until another line of codes comes. Blank lines don't count.
    """
    clean = lines.filter(F.trim(line) != "").select(block, F.col(place).alias("line_no"), t.normalize_line(F.col(line)).alias("line"))
    is_codes = F.col("line").rlike(CODES_LINE)
    marked = clean.withColumn("codes", F.when(is_codes, t.split_codes(F.regexp_extract("line", CODES_LINE, 1)))).withColumn("rest", F.when(is_codes, F.trim(F.regexp_extract("line", CODES_LINE, 2))).otherwise(F.col("line")))
    begun = F.when(F.col("codes").isNotNull(), 1).otherwise(0)
    grouped = running(marked, [block], ["line_no"], Running(sums={"segment": begun})).filter("segment > 0")
    first = F.min_by("rest", F.when(t.valid_description(F.col("rest")), F.col("line_no")))
    entries = grouped.groupBy(block, "segment").agg(F.min("line_no").alias("line_no"), F.first("codes", ignorenulls=True).alias("codes"), first.alias("description"))
    return entries.filter(F.col("description").isNotNull()).select(block, "line_no", F.explode("codes").alias("code"), "description")


def simple_entries(lines: DataFrame, line: str, *keep: str) -> DataFrame:
    """(keep, code, description) of lines of one code and its description."""
    stripped = lines.select(*keep, F.trim(line).alias("line")).filter(F.col("line").rlike(SIMPLE_LINE))
    return stripped.select(*keep, F.regexp_extract("line", SIMPLE_LINE, 1).alias("code"), F.trim(F.regexp_extract("line", SIMPLE_LINE, 2)).alias("description"))


def body_blocks(blocks: DataFrame, right: float = 1320.0, top: float = 150.0, bottom: float = 1800.0, least: int = 20) -> DataFrame:
    """Text blocks (x0, y0, text) of a legend page's body: left of ``right``, between ``top`` and ``bottom``, of more than ``least`` characters."""
    return blocks.filter((F.col("x0") < right) & (F.col("y0") > top) & (F.col("y0") < bottom) & (F.length(F.trim("text")) > least))
