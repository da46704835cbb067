"""Scores and retries of boxes; regular grids of cells."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platemark.functions import geometry as g


def warning_tags(b: g.Box, code: Column, min_area: int = 900, min_side: int = 28, max_aspect: float = 4.0) -> Column:
    """Array of the tags that apply, in fixed order."""
    tags = [
        F.when(b[2].cast("long") * b[3] < min_area, "small_area"),
        F.when((b[2] < min_side) | (b[3] < min_side), "small_side"),
        F.when(g.aspect(b[2], b[3]) > max_aspect, "extreme_aspect"),
        F.when(F.coalesce(F.trim(code), F.lit("")) == "", "code_missing"),
    ]
    return F.filter(F.array(*tags), lambda t: t.isNotNull())


def confidence(ok: Column, warnings: Column, has_code: Column, text_on: Column, area: Column) -> Column:
    """100 less deductions for a bad status, warnings, a missing code (where text is read) and a small area; within 0 to 100."""
    score = F.lit(100) - F.when(ok, 0).otherwise(20) - F.least(F.lit(30), warnings * 10) - F.when(text_on & ~has_code, 25).otherwise(0) - F.when(area < 10000, 5).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("double")


def refine(df: DataFrame, valid: Callable[[g.Box], Column], page_w: Column, page_h: Column, step: int, most: int, rounds: int) -> DataFrame:
    """Expands boxes that aren't valid, up to ``rounds`` times; adds retries and valid."""
    df = df.withColumn("retries", F.lit(0))
    b = g.box("x", "y", "w", "h")
    for _ in range(rounds):
        good = valid(b)
        grown = dict(zip(("x", "y", "w", "h"), g.expand(b, page_w, page_h, step, most), strict=True))
        df = df.withColumns({n: F.when(good, F.col(n)).otherwise(c).cast("int") for n, c in grown.items()} | {"retries": F.col("retries") + F.when(good, 0).otherwise(1)})
    return df.withColumn("valid", valid(b))


def grid_cells(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per cell of each region: row_no, column_no (from 0), x, y, w, h.

    A region has ``keys``, left, top, gap_x, gap_y, and the arrays
    column_widths and row_heights; a cell begins after the sizes and gaps
    before it. A region with an empty array has no cells.
    """
    before = lambda sizes, i, gap: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0).cast("long"), lambda a, v: a + v) + i * gap
    out = df.select("*", F.posexplode("row_heights").alias("row_no", "h")).select("*", F.posexplode("column_widths").alias("column_no", "w"))
    x = F.col("left") + before(F.col("column_widths"), F.col("column_no"), F.col("gap_x"))
    y = F.col("top") + before(F.col("row_heights"), F.col("row_no"), F.col("gap_y"))
    return out.select(*keys, "row_no", "column_no", x.alias("x"), y.alias("y"), "w", "h")


def region_extent(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, columns, total width and height of each region."""
    total = lambda sizes, gap: F.aggregate(sizes, F.lit(0).cast("long"), lambda a, v: a + v) + F.greatest(F.size(sizes) - 1, F.lit(0)) * F.col(gap)
    return df.select(*keys, F.size("row_heights").alias("n_rows"), F.size("column_widths").alias("n_columns"), total("column_widths", "gap_x").alias("total_width"), total("row_heights", "gap_y").alias("total_height"))


def cell_size_from_corners(extent: Column, gap: Column, n: Column) -> Column:
    """(extent - gap * (n - 1)) / n, rounded half to even; null without cells."""
    return F.when(n > 0, F.bround((extent - gap * (n - 1)).cast("double") / n, 0).cast("int"))


def page_type(page: Column, legend_page: int = 5) -> Column:
    """Pages with crops, and the page that only holds the legend."""
    return F.when(page == legend_page, "legend").otherwise("standard")


def invalid_regions(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, problem) of regions whose lists don't have as many sizes as ``columns`` and ``rows`` say, or whose sizes aren't positive."""
    some_bad = lambda sizes: F.exists(sizes, lambda v: v <= 0)
    problems = F.array(
        F.when(F.size("column_widths") != F.col("columns"), "column_widths"), F.when(F.size("row_heights") != F.col("rows"), "row_heights"),
        F.when(some_bad("column_widths") | some_bad("row_heights"), "not_positive"),
    )
    return df.select(*keys, F.explode(F.filter(problems, lambda p: p.isNotNull())).alias("problem"))
