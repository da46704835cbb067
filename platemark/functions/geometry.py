"""Box arithmetic as column expressions. A box is (x, y, w, h): top left corner and size."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(*names: str) -> Box:
    x, y, w, h = (F.col(n) for n in names)
    return x, y, w, h


def round6(c: Column) -> Column:
    """Six decimals, halves up, by plain arithmetic, so that other engines give the same bits."""
    return F.floor(c * 1000000.0 + 0.5) / 1000000.0


def _trunc(c: Column) -> Column:
    return c.cast("int")


def intersection(a: Box, b: Box) -> Column:
    across = F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0])
    down = F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1])
    return F.greatest(across, F.lit(0)).cast("double") * F.greatest(down, F.lit(0))


def iou(a: Box, b: Box) -> Column:
    """Overlap over union; 0 where boxes only touch or have no area.

    Kept short on purpose: it is evaluated for every pair, in generated code
    that the JVM compiles only up to a certain size.
    """
    both = intersection(a, b)
    return F.coalesce(both / F.nullif(F.greatest(a[2] * a[3] + b[2] * b[3] - both, F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def center_distance(a: Box, b: Box) -> Column:
    dx = (a[0] + a[2] / 2.0) - (b[0] + b[2] / 2.0)
    dy = (a[1] + a[3] / 2.0) - (b[1] + b[3] / 2.0)
    return F.sqrt(dx * dx + dy * dy)


def center_score(distance: Column, diagonal: float = math.sqrt(2.0)) -> Column:
    return F.greatest(F.lit(0.0), 1.0 - F.least(F.lit(1.0), distance / diagonal))


def area_ratio(a: Box, b: Box) -> Column:
    one, other = a[2] * a[3], b[2] * b[3]
    return F.when((one > 0) & (other > 0), F.least(one, other) / F.greatest(one, other)).otherwise(0.0)


def aspect(w: Column, h: Column) -> Column:
    """The longer side over the shorter; null if a side is 0."""
    return F.when((w > 0) & (h > 0), F.greatest(w.cast("double") / h, h.cast("double") / w))


def normalize(b: Box, page_w: Column, page_h: Column) -> Box:
    x, y, w, h = b
    return tuple(F.when(size > 0, round6(v.cast("double") / size)) for v, size in ((x, page_w), (y, page_h), (w, page_w), (h, page_h)))


def clamp(b: Box, page_w: Column, page_h: Column) -> Box:
    """Into the page; a box keeps at least one pixel of width and height."""
    x = F.greatest(F.lit(0), F.least(b[0], page_w - 1))
    y = F.greatest(F.lit(0), F.least(b[1], page_h - 1))
    return x, y, F.greatest(F.lit(1), F.least(b[2], page_w - x)), F.greatest(F.lit(1), F.least(b[3], page_h - y))


def pad(b: Box, page_w: Column, page_h: Column, left: float, top: float, right: float, bottom: float, floor: int) -> Box:
    """Grows by a share of the size per side (rounded half to even, ``floor`` pixels at least), clipped to the page."""
    grow = lambda size, share: F.greatest(F.lit(floor), F.bround(size * share, 0).cast("int"))
    x1, y1 = F.greatest(F.lit(0), b[0] - grow(b[2], left)), F.greatest(F.lit(0), b[1] - grow(b[3], top))
    x2, y2 = F.least(page_w, b[0] + b[2] + grow(b[2], right)), F.least(page_h, b[1] + b[3] + grow(b[3], bottom))
    return x1, y1, x2 - x1, y2 - y1


def pad_fixed(b: Box, page_w: Column, page_h: Column, pixels: int) -> Box:
    x1, y1 = F.greatest(F.lit(0), b[0] - pixels), F.greatest(F.lit(0), b[1] - pixels)
    x2, y2 = F.least(page_w, b[0] + b[2] + pixels), F.least(page_h, b[1] + b[3] + pixels)
    return x1, y1, x2 - x1, y2 - y1


def expand(b: Box, page_w: Column, page_h: Column, step: int, most: int) -> Box:
    """Grows ``step`` pixels on each side; stays as it was if width or height would grow by more than ``most``."""
    n = pad_fixed(b, page_w, page_h, step)
    within = (n[2] - b[2] <= most) & (n[3] - b[3] <= most)
    return tuple(F.when(within, new).otherwise(old) for new, old in zip(n, b, strict=True))
