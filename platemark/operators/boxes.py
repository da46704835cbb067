"""Filters, joins and greedy reductions over boxes on pages."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from platemark.functions import geometry as g
from platemark.functions.closest import Closest
from platemark.operators.sizing import lookup
from platemark.session import cut, tasks

#: Undecided pairs that greedy suppression settles one after another.
SETTLED = 500_000
#: Left boxes of one tile that are searched in one task.
SEARCHED = 100_000


def fits(b: g.Box, min_area: int, max_area: int, min_side: int, max_aspect: float) -> Column:
    """Size predicate: area, shortest side and aspect within limits."""
    area = b[2].cast("long") * b[3]
    return area.between(min_area, max_area) & (b[2] >= min_side) & (b[3] >= min_side) & F.coalesce(g.aspect(b[2], b[3]) <= max_aspect, F.lit(False))


def plausible(b: g.Box, page_h: Column, min_side: int, min_area: int, top: float, bottom: float, max_aspect: float) -> Column:
    """False for boxes in the page's head or foot, too thin, too small or too long."""
    ratio = b[2].cast("double") / F.greatest(b[3], F.lit(1))
    return ~(
        (b[1] < (page_h * top).cast("int"))
        | (b[1] + b[3] > (page_h * (1.0 - bottom)).cast("int"))
        | (b[2] < 1.2 * min_side) & (b[3] < 1.2 * min_side)
        | (b[2].cast("long") * b[3] < min_area)
        | (b[2] < 2 * min_side) & (b[3] < 2 * min_side)
        | (ratio > max_aspect)
        | (ratio < 1.0 / max_aspect)
    )


def with_bins(df: DataFrame, b: g.Box, size: float, around: float = 0.0) -> DataFrame:
    """One row for each square of side ``size`` that the box, grown by ``around``, touches: columns bx, by."""
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size)))
    df = df.withColumn("bx", cells(b[0] - around, b[0] + b[2] + around))
    return df.withColumn("by", cells(b[1] - around, b[1] + b[3] + around))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partitioned by ``keys`` over all cores, however few bytes there are: for steps whose work isn't told by their input's size."""
    return df.repartition(tasks(df.sparkSession), *keys)


def square_side(df: DataFrame) -> float:
    """A side for the squares boxes meet in: the mean of their longer sides, so a box touches a few squares and a square few boxes."""
    return max(float(df.agg(F.avg(F.greatest("w", "h"))).first()[0] or 1.0), 1e-6)


def overlapping_pairs(left: DataFrame, right: DataFrame, page: str, at_least: float, size: float | None = None, rank: str | None = None) -> DataFrame:
    """Pairs of boxes of the same page whose overlap over union reaches ``at_least`` (> 0).

    Both sides have (id, ``page``, x, y, w, h); the result (``page``, left_id,
    right_id, iou). With ``rank``, a column of both, only pairs whose left box
    has the smaller one, so a table held against itself gives each pair once.
    An equi-join on page and square replaces the comparison of all boxes of a
    page: a pair is met in the square that holds the top left corner of the
    overlap, and only there, so nothing has to be made distinct. The squares'
    side follows the boxes unless ``size`` is given; it doesn't change the
    result. The join sorts, so a dense square spills instead of failing.
    """
    names = ("x", "y", "w", "h")
    size = size or square_side(left)
    side = lambda df, p: df.select(F.col("id").alias(f"{p}_id"), page, *[F.col(c).cast("double").alias(f"{p}_{c}") for c in names], *([F.col(rank).alias(f"{p}_rank")] if rank else []))
    box = lambda p: g.box(*[f"{p}_{c}" for c in names])
    a, b = (spread(with_bins(side(df, p), box(p), size), page, "bx", "by") for df, p in ((left, "left"), (right, "right")))
    met = (F.floor(F.greatest("left_x", "right_x") / size) == F.col("bx")) & (F.floor(F.greatest("left_y", "right_y") / size) == F.col("by"))
    if rank:
        met = met & (F.col("left_rank") < F.col("right_rank"))
    return a.join(b, [page, "bx", "by"]).filter(met).select(page, "left_id", "right_id", g.iou(box("left"), box("right")).alias("iou")).filter(F.col("iou") >= at_least)


def suppress(df: DataFrame, page: str, order: list[Column], at_least: float, size: float | None = None) -> DataFrame:
    """Greedy suppression: in order, a box goes if it overlaps a kept one by ``at_least``.

    The sequential rule is decided in parallel rounds. A box is kept when no
    earlier neighbour is left that is kept or undecided, and dropped when an
    earlier neighbour is kept; each round settles at least the first box of
    every chain. Only boxes that have neighbours take part. As soon as no more
    than SETTLED pairs are undecided they are settled one box after another, a
    page in one task; until then rounds go on, however many it takes.
    ``df`` has (id, ``page``, x, y, w, h) and the columns of ``order``, which
    must be a total order within a page; ids are unique.
    """
    boxes = df.select("id", page, "x", "y", "w", "h", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("rank"))
    edges = cut(overlapping_pairs(boxes, boxes, page, at_least, size, "rank").select(F.col(page).alias("page"), "left_id", "right_id"))
    dropped = [edges.select(F.col("right_id").alias("id")).limit(0)]
    while (left := edges.count()) > SETTLED:
        # A box with no earlier neighbour left is kept; whatever it overlaps is dropped.
        kept = edges.select("left_id").distinct().join(edges.select(F.col("right_id").alias("left_id")).distinct(), "left_id", "left_anti")
        gone = cut(edges.join(kept, "left_id", "left_semi").select(F.col("right_id").alias("id")).distinct())
        dropped.append(gone)
        both = edges.join(gone.withColumnRenamed("id", "left_id"), "left_id", "left_anti")
        edges = cut(both.join(gone.withColumnRenamed("id", "right_id"), "right_id", "left_anti"))
    if left:
        dropped.append(edges.groupBy("page").applyInPandas(_suppressed, f"id {df.schema['id'].dataType.simpleString()}"))
    return df.join(reduce(DataFrame.unionByName, dropped), "id", "left_anti")


def _suppressed(edges: pd.DataFrame) -> pd.DataFrame:
    """Boxes that go, of edges from earlier to later boxes: each is decided when all before it are."""
    after, waits, gone = {}, {}, set()
    for a, b in zip(edges["left_id"].tolist(), edges["right_id"].tolist(), strict=True):
        after.setdefault(a, []).append(b)
        waits[b] = waits.get(b, 0) + 1
    ready = [a for a in after if a not in waits]
    while ready:
        a = ready.pop()
        for b in after.get(a, ()):
            if a not in gone:
                gone.add(b)
            waits[b] -= 1
            if not waits[b]:
                ready.append(b)
    return pd.DataFrame({"id": pd.Series(list(gone), dtype=edges["right_id"].dtype)})


def nearest(left: DataFrame, right: DataFrame, page: str, first_size: float | None = None, growth: float = 4.0) -> DataFrame:
    """(left_id, right_id, distance): the nearest box of the same page by centres, the smallest right_id on a tie.

    Right boxes of one centre count as the first of them. The others are cut
    into as many tiles as there are tasks, each with about as many boxes, so
    crowded places get more tiles. A left box is searched in the tile next to
    it, which bounds its distance, and then in those no farther than that; in a
    tile by a tree, so boxes aren't paired. Both sides have (id, ``page``, x,
    y, w, h). Boxes without a finite centre, and boxes of pages without any
    right box, give no row. ``first_size`` and ``growth`` are of a search in
    squares that this one replaced; they change nothing.
    """

    def centre(df: DataFrame, p: str) -> DataFrame:
        df = df.select(F.col("id").alias(f"{p}_id"), F.col(page).alias(page), (F.col("x") + F.col("w") / 2.0).alias(f"{p}x"), (F.col("y") + F.col("h") / 2.0).alias(f"{p}y"))
        return df.filter((F.abs(f"{p}x") < 1e15) & (F.abs(f"{p}y") < 1e15))

    n = tasks(left.sparkSession)
    others = centre(right, "right").groupBy(page, "rightx", "righty").agg(F.min("right_id").alias("right_id"))
    others = cut(others.repartitionByRange(n, page, "rightx", "righty").withColumn("tile", F.spark_partition_id()))
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("rightx", "righty") for f in (F.min, F.max)]
    tiles = others.groupBy(page, "tile").agg(*ends).groupBy(page).agg(F.collect_list(F.struct("tile", "min_rightx", "max_rightx", "min_righty", "max_righty")).alias("tiles"))

    def apart(t: Column) -> Column:
        dx, dy = (F.greatest(t[f"min_right{a}"] - F.col(f"left{a}"), F.col(f"left{a}") - t[f"max_right{a}"], F.lit(0.0)) for a in "xy")
        return F.sqrt(dx * dx + dy * dy)

    def searched(todo: DataFrame) -> DataFrame:
        """The nearest box in the tile that each row of ``todo`` names."""
        keys = [page, "tile", "part"]
        parts = todo.groupBy(page, "tile").agg(F.ceil(F.count(F.lit(1)) / SEARCHED).cast("int").alias("parts"))
        a = lookup(todo, parts, [page, "tile"], "left_id").withColumn("part", F.pmod(F.xxhash64("left_id"), F.col("parts")).cast("int")).drop("parts")
        b = others.join(parts, [page, "tile"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        kinds = {f.name: f.dataType.simpleString() for f in [*todo.schema, *others.schema]} | {"distance": "double"}
        schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*todo.columns, "right_id", "distance"])
        return spread(a, *keys).groupBy(*keys).cogroup(spread(b, *keys).groupBy(*keys)).applyInPandas(_nearest, schema)

    todo = lookup(centre(left, "left"), tiles, [page], "left_id").filter(F.col("tiles").isNotNull())
    home = F.array_min(F.transform("tiles", lambda t: F.struct(apart(t).alias("apart"), t["tile"].alias("tile"))))["tile"]
    first = cut(searched(cut(todo.withColumn("tile", home).drop("tiles"))))
    also = F.explode(F.transform(F.filter("tiles", lambda t: (t["tile"] != F.col("tile")) & (apart(t) <= F.col("distance"))), lambda t: t["tile"]))
    rest = lookup(first, tiles, [page], "left_id").select("left_id", page, "leftx", "lefty", also.alias("tile"))
    found = (df.select("left_id", F.struct("distance", "right_id").alias("b")) for df in (first, searched(cut(rest))))
    return reduce(DataFrame.unionByName, found).groupBy("left_id").agg(F.min("b").alias("b")).select("left_id", "b.right_id", "b.distance")


def _nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    right = right.sort_values("right_id", ignore_index=True)
    place, distance = Closest(right["rightx"].to_numpy(), right["righty"].to_numpy()).search(left["leftx"].to_numpy(), left["lefty"].to_numpy())
    return left.drop(columns="part").assign(right_id=right["right_id"].to_numpy()[place], distance=distance)


def merge_group(frame: pd.DataFrame, at_least: float, distance: float) -> pd.DataFrame:
    """Boxes merged until nothing changes: the first box in (y, x, w, h) order takes in the first other that overlaps enough or is near enough, and starts over."""
    queue = frame.sort_values(["y", "x", "w", "h"], kind="stable")[["x", "y", "w", "h"]].to_numpy(float)
    out = []
    while len(queue):
        x, y, w, h = queue[0]
        queue, members = queue[1:], 1
        while len(queue):
            ox, oy, ow, oh = queue.T
            across = np.minimum(x + w, ox + ow) - np.maximum(x, ox)
            down = np.minimum(y + h, oy + oh) - np.maximum(y, oy)
            both = np.where((across > 0) & (down > 0), across * down, 0.0)
            union = w * h + ow * oh - both
            share = np.where(union > 0, both / np.where(union > 0, union, 1), 0.0)
            dx, dy = (x + w / 2) - (ox + ow / 2), (y + h / 2) - (oy + oh / 2)
            hit = np.flatnonzero((share >= at_least) | (np.sqrt(dx * dx + dy * dy) <= distance))
            if not len(hit):
                break
            k = hit[0]
            right, low = max(x + w, ox[k] + ow[k]), max(y + h, oy[k] + oh[k])
            x, y = min(x, ox[k]), min(y, oy[k])
            w, h, members = right - x, low - y, members + 1
            queue = np.delete(queue, k, axis=0)
        out.append((x, y, w, h, members))
    return pd.DataFrame(out, columns=["x", "y", "w", "h", "members"])


def merge_near(df: DataFrame, keys: list[str], at_least: float, distance: float) -> DataFrame:
    """``merge_group`` for each group of ``keys``, a physical page: (keys, x, y, w, h, members).

    The outcome depends on the order, and a grown box reaches farther, so a
    page can't be split; pages are bounded by what fits on paper.
    """
    kinds = dict(df.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", x double, y double, w double, h double, members int"

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = merge_group(frame, at_least, distance)
        for k, v in zip(keys, key, strict=True):
            out[k] = v
        return out[[*keys, "x", "y", "w", "h", "members"]]

    return spread(df.select(*keys, "x", "y", "w", "h"), *keys).groupBy(*keys).applyInPandas(run, schema)


def _islands(df: DataFrame, keys: list[str], order: list[Column], starts: Column) -> DataFrame:
    """Adds ``island``: rows in order, cut where ``starts`` is true. A sheet is only sorted for this, never gathered."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_new", starts.cast("int")).withColumn("island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def row_buckets(df: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Boxes in rows: a row's first box (by y, x, id) anchors it; boxes within ``tolerance`` below join it, then order by x.

    Adds row_no and column_no, from 1. ``df`` has ``keys``, id, x, y. A box
    farther than ``tolerance`` below the one before it begins a row whatever
    the anchor; what lies between two such places is folded by itself.
    """
    flat = df.select(*keys, "id", F.col("y").cast("double").alias("y"), F.col("x").cast("double").alias("x"), F.col("id").cast("string").alias("name"))
    order = [F.col("y"), F.col("x"), F.col("name")]
    before = F.lag("y").over(W.partitionBy(*keys).orderBy(*order))
    cutting = _islands(flat.withColumn("_before", before), keys, order, F.coalesce(F.col("y") - F.col("_before") > tolerance, F.lit(True)))
    start = F.expr("cast(array() as array<double>)")

    def step(anchors: Column, y: Column) -> Column:
        return F.when((F.size(anchors) > 0) & (y - F.element_at(anchors, -1) <= tolerance), anchors).otherwise(F.concat(anchors, F.array(y)))

    anchors = cutting.groupBy(*keys, "island").agg(F.aggregate(F.array_sort(F.collect_set("y")), start, step).alias("anchors"))
    ahead = F.coalesce(F.sum(F.size("anchors")).over(W.partitionBy(*keys).orderBy("island").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    anchors = anchors.withColumn("_ahead", ahead)
    row = (F.size(F.filter("anchors", lambda a: a <= F.col("y"))) + F.col("_ahead")).cast("int")
    placed = cutting.join(anchors, [*keys, "island"]).withColumn("row_no", row)
    return placed.select(*keys, "id", "row_no", F.row_number().over(W.partitionBy(*keys, "row_no").orderBy("x", "name")).alias("column_no"))


def coalesce_boxes(df: DataFrame, keys: list[str], gap: float) -> DataFrame:
    """Boxes in (y, x, w, h) order, each joined to the running one if it begins no farther than ``gap`` below its bottom and right of its edge.

    (keys, block_no, x, y, w, h, members); ``df`` has ``keys``, x, y, w, h. A
    box that begins farther than ``gap`` below all before it begins a block
    whatever the running one is; what lies between two such places is folded
    by itself.
    """
    names = ("y", "x", "w", "h")
    flat = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in names])
    order = [F.col(c) for c in names]
    lowest = F.max(F.col("y") + F.col("h")).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    cutting = _islands(flat.withColumn("_lowest", lowest), keys, order, F.coalesce(F.col("y") > F.col("_lowest") + gap, F.lit(True)))
    start = F.expr("cast(array() as array<struct<x: double, y: double, r: double, b: double, n: int>>)")

    def step(done: Column, b: Column) -> Column:
        last = F.element_at(done, -1)
        joined = (F.size(done) > 0) & (b["y"] <= last["b"] + gap) & (b["x"] <= last["r"] + gap)
        grown = F.struct(
            F.least(last["x"], b["x"]).alias("x"), F.least(last["y"], b["y"]).alias("y"),
            F.greatest(last["r"], b["x"] + b["w"]).alias("r"), F.greatest(last["b"], b["y"] + b["h"]).alias("b"), (last["n"] + 1).alias("n"),
        )
        fresh = F.struct(b["x"].alias("x"), b["y"].alias("y"), (b["x"] + b["w"]).alias("r"), (b["y"] + b["h"]).alias("b"), F.lit(1).alias("n"))
        return F.when(joined, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(fresh)))

    folded = cutting.groupBy(*keys, "island").agg(F.aggregate(F.sort_array(F.collect_list(F.struct(*names))), start, step).alias("o"))
    out = folded.select(*keys, "island", F.posexplode("o").alias("i", "b"))
    number = F.row_number().over(W.partitionBy(*keys).orderBy("island", "i")).alias("block_no")
    return out.select(*keys, number, "b.x", "b.y", (F.col("b.r") - F.col("b.x")).alias("w"), (F.col("b.b") - F.col("b.y")).alias("h"), F.col("b.n").alias("members"))
