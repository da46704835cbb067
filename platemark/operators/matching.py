"""Scoring of boxes against reference positions, and their ranks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from platemark.functions import geometry as g
from platemark.session import tasks


@dataclass(frozen=True)
class Weights:
    overlap: float = 0.7
    centre: float = 0.2
    area: float = 0.1
    text_bonus: float = 0.15

    @classmethod
    def of(cls, config: dict) -> Weights:
        """Weights of a configuration; what it doesn't name is as by default."""
        names = {"iou": "overlap", "center": "centre", "area": "area", "ocr_bonus": "text_bonus"}
        return cls(**{names[k]: float(v) for k, v in config.get("weights", {}).items() if k in names})


def text_agreement(read: Column, official: Column) -> tuple[Column, Column]:
    """(agreement, score): unavailable without text, else consistent or inconsistent."""
    read = F.coalesce(F.trim(read), F.lit(""))
    state = F.when(read == "", "unavailable").when(read == official, "consistent").otherwise("inconsistent")
    return state, F.when(state == "consistent", 1.0).when(state == "inconsistent", 0.0)


def scored(pairs: DataFrame, a: g.Box, b: g.Box, read: Column, official: Column, weights: Weights = Weights()) -> DataFrame:
    """Adds iou, center_distance, center_score, area_ratio, geometry_score, agreement, match_score; each rounded to six decimals.

    The bonus is added to the rounded geometry score, only where there is text, and the sum held to 1.
    """
    overlap, distance, ratio = g.iou(a, b), g.center_distance(a, b), g.area_ratio(a, b)
    near = g.center_score(distance)
    geometry = overlap * weights.overlap + near * weights.centre + ratio * weights.area
    state, agreed = text_agreement(read, official)
    out = pairs.withColumns({
        "iou": g.round6(overlap), "center_distance": g.round6(distance), "center_score": g.round6(near),
        "area_ratio": g.round6(ratio), "geometry_score": g.round6(geometry), "agreement": state,
    })
    bonus = F.when(agreed.isNotNull(), F.least(F.lit(1.0), F.col("geometry_score") + weights.text_bonus * agreed)).otherwise(F.col("geometry_score"))
    return out.withColumn("match_score", g.round6(bonus))


def ranked(pairs: DataFrame, keys: list[str], k: int, reference: str) -> DataFrame:
    """The first ``k`` references of each group: score, overlap, distance, reference id."""
    w = W.partitionBy(*keys).orderBy(F.desc_nulls_last("match_score"), F.desc_nulls_last("iou"), F.asc_nulls_last("center_distance"), F.asc(reference))
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


#: Crops of one page that meet its references in one task, and pairs scored at a time there.
PART, CELLS = 2_000, 500_000
#: More than rounding can move a match score.
SLACK = 4e-6


def _rough(c: pd.DataFrame, r: pd.DataFrame, weights: Weights) -> np.ndarray:
    """Unrounded match scores, crops by references; NaN where a side is null, or the score is left open.

    Distance and area are taken of all pairs, overlap and bonus only of those that have any.
    """
    a = [c[f"norm_{n}"].to_numpy(float) for n in "xywh"]
    b = [r[f"ref_{n}"].to_numpy(float) for n in "xywh"]
    with np.errstate(all="ignore"):
        score = np.subtract.outer(a[0] + a[2] / 2, b[0] + b[2] / 2)
        down = np.subtract.outer(a[1] + a[3] / 2, b[1] + b[3] / 2)
        np.sqrt(np.add(np.square(score, out=score), np.square(down, out=down), out=score), out=score)
        score *= -weights.centre / np.sqrt(2.0)
        score += weights.centre
        np.maximum(score, 0.0, out=score)
        mine, other = a[2] * a[3], b[2] * b[3]
        inverse = lambda v: np.where(v > 0, np.where(v > 1e-300, weights.area / v, np.nan), 0.0)  # noqa: E731 - areas too small to divide by leave it open
        score += np.minimum(np.multiply.outer(np.maximum(mine, 0.0), inverse(other)), np.multiply.outer(inverse(mine), np.maximum(other, 0.0), out=down), out=down)
        meet = np.less.outer(a[0], b[0] + b[2]) & np.greater.outer(a[0] + a[2], b[0]) & np.less.outer(a[1], b[1] + b[3]) & np.greater.outer(a[1] + a[3], b[1])
        i, j = np.nonzero(meet)
        inter = (np.minimum(a[0][i] + a[2][i], b[0][j] + b[2][j]) - np.maximum(a[0][i], b[0][j])) * (np.minimum(a[1][i] + a[3][i], b[1][j] + b[3][j]) - np.maximum(a[1][i], b[1][j]))
        union = mine[i] + other[j] - inter
        sized = (a[2][i] > 0) & (a[3][i] > 0) & (b[2][j] > 0) & (b[3][j] > 0)
        score[i, j] += np.where(sized & (union > 0), inter / union, 0.0) * weights.overlap
    read = c["code"].fillna("").str.strip(" ")
    numbers = pd.factorize(pd.concat([read.where(read != ""), r["official_code"]]))[0]  # equal texts have equal numbers, null has -1
    i, j = np.nonzero(np.equal.outer(np.where(numbers[: len(c)] < 0, -2, numbers[: len(c)]), numbers[len(c) :]))
    score[i, j] = np.minimum(1.0, score[i, j] + weights.text_bonus)
    score[np.isnan(sum(a))] = np.nan
    score[:, np.isnan(sum(b))] = np.nan
    return score


def _kth(known: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -1 where there are no more than ``k``."""
    if known.shape[1] <= k:
        return np.full(len(known), -1.0)
    known, each = known.copy(), np.arange(len(known))
    for _ in range(k - 1):
        known[each, known.argmax(axis=1)] = -1.0
    return known.max(axis=1)


def contenders(crops: DataFrame, refs: DataFrame, page: str, ident: str, k: int, weights: Weights = Weights(), per: str | None = None) -> DataFrame:
    """Crops joined to the references of their page, without pairs that surely aren't among a crop's first ``k``.

    ``crops`` has (``ident``, ``page``, code, norm_x to norm_h), ``refs``
    (``page``, official_code, ref_x to ref_h and more). With ``per``, a column
    of ``refs``, the first ``k`` are those among the references of one value
    each. All pairs of a page are scored, a block at a time, and only those that reach the crop's k-th
    best score, less a slack for rounding, or have a null leave the task: the
    exact scores and the ties are left to ``scored`` and ``ranked``. A page with many
    crops is cut into parts by a hash of ``ident``; its references go to each.
    """
    parts = crops.groupBy(page).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    left = crops.join(parts, page).withColumn("part", F.pmod(F.xxhash64(ident), F.col("parts")).cast("int")).drop("parts")
    right = refs.join(parts, page).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    mine, theirs = crops.columns, [c for c in refs.columns if c != page]

    def best(c: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        found = [(np.empty(0, int), np.empty(0, int))]
        step = max(1, CELLS // max(1, len(r)))
        if per:
            r = r.sort_values(per, ignore_index=True)
        starts = [0, *(np.flatnonzero(np.diff(pd.factorize(r[per])[0])) + 1 if per else []), len(r)]
        for at in range(0, len(c) if len(r) else 0, step):
            score = _rough(c.iloc[at : at + step], r, weights)
            leave = np.isnan(score)
            known = np.where(leave, -1.0, score)
            for a, b in zip(starts, starts[1:]):  # noqa: B905 - one shorter
                leave[:, a:b] |= known[:, a:b] >= _kth(known[:, a:b], k)[:, None] - SLACK
            row, col = np.nonzero(leave)
            found.append((row + at, col))
        row, col = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.concat([c[mine].iloc[row].reset_index(drop=True), r[theirs].iloc[col].reset_index(drop=True)], axis=1)

    fields = [crops.schema[c] for c in mine] + [refs.schema[c] for c in theirs]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    left, right = (df.repartition(tasks(df.sparkSession), page, "part") for df in (left, right))  # the work isn't told by the bytes
    return left.groupBy(page, "part").cogroup(right.groupBy(page, "part")).applyInPandas(best, schema)


def pair_id(reference: Column, instance: Column) -> Column:
    """'CA-' and 16 hexadecimal digits of the pair's hash."""
    return F.concat(F.lit("CA-"), F.substring(F.sha2(F.concat(reference, F.lit("|"), instance), 256), 1, 16))


def instance_id(filename: Column) -> Column:
    return F.concat(F.lit("ES-"), F.replace(filename, F.lit(".png"), F.lit("")))


def last_wins(df: DataFrame, key: str, place: Column, columns: list[str]) -> DataFrame:
    """One row per key: the columns of its last row by ``place``."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), place).alias("v")).select(key, "v.*")
