import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from platemark.operators import boxes


def some(spark, n=120, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice([1, 2]), rng.randrange(400), rng.randrange(400), rng.randrange(1, 90), rng.randrange(1, 90)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, page int, x int, y int, w int, h int")


def overlap(a, b):
    across, down = min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2]), min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3])
    both = across * down if across > 0 and down > 0 else 0
    return both / (a[4] * a[5] + b[4] * b[5] - both) if both else 0.0


@pytest.mark.parametrize("size", [40.0, 1000.0, None])
def test_pairs_once_each(spark, size):
    rows, df = some(spark)
    got = sorted((r.left_id, r.right_id) for r in boxes.overlapping_pairs(df, df, "page", 0.1, size).collect())
    assert got == sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and overlap(a, b) >= 0.1)
    once = sorted((r.left_id, r.right_id) for r in boxes.overlapping_pairs(df, df, "page", 0.1, size, "id").collect())
    assert once == [p for p in got if p[0] < p[1]]


def test_suppression_equals_the_sequential_rule(spark):
    rows, df = some(spark, 200)
    kept = []
    for r in sorted(rows, key=lambda r: (-r[4] * r[5], r[0])):
        if all(r[1] != k[1] or overlap(r, k) < 0.2 for k in kept):
            kept.append(r)
    got = boxes.suppress(df, "page", [-(F.col("w") * F.col("h")), F.col("id")], 0.2, 60.0)
    assert sorted(r.id for r in got.collect()) == sorted(k[0] for k in kept)
    assert boxes.suppress(df.limit(0), "page", [F.col("id")], 0.2, 60.0).count() == 0


def test_nearest(spark):
    rows, df = some(spark, 80)
    left, right = [r for r in rows if r[0] % 2], [r for r in rows if not r[0] % 2 and r[0] < 40]
    d = lambda a, b: (((a[2] + a[4] / 2) - (b[2] + b[4] / 2)) ** 2 + ((a[3] + a[5] / 2) - (b[3] + b[5] / 2)) ** 2) ** 0.5
    expected = {a[0]: min((d(a, b), b[0]) for b in right if b[1] == a[1])[1] for a in left if any(b[1] == a[1] for b in right)}
    got = boxes.nearest(df.filter("id % 2 = 1"), df.filter("id % 2 = 0 AND id < 40"), "page", 10.0)
    assert {r.left_id: r.right_id for r in got.collect()} == expected


def test_nearest_knows_no_limit_and_no_missing_centres(spark):
    left = spark.createDataFrame([(1, 1, 0.0, 0.0, 2.0, 2.0), (2, 1, None, 0.0, 2.0, 2.0), (3, 2, 0.0, 0.0, 2.0, 2.0), (4, 1, float("nan"), 0.0, 2.0, 2.0)], "id long, page int, x double, y double, w double, h double")
    right = spark.createDataFrame([(7, 1, 3e7, 0.0, 2.0, 2.0), (8, 1, 5e7, 0.0, 2.0, 2.0), (9, 1, None, None, None, None)], "id long, page int, x double, y double, w double, h double")
    assert [tuple(r) for r in boxes.nearest(left, right, "page", 10.0, 100.0).collect()] == [(1, 7, 3e7)]
    assert boxes.nearest(left, right.limit(0), "page", 10.0).count() == 0


@pytest.mark.parametrize("searched", [50, 100_000])
def test_nearest_pairs_nothing_where_boxes_crowd(spark, monkeypatch, searched):
    """1,200 and 1,500 boxes in one place, many on the same centre, and some far from it: all would meet in one square."""
    plans, cut = [], boxes.cut
    monkeypatch.setattr(boxes, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    monkeypatch.setattr(boxes, "SEARCHED", searched, raising=False)
    at = random.Random(searched)
    some = lambda n, far: [(at.randrange(10**6), 1 + (i % 9 == 0), *((at.randrange(far), at.randrange(far)) if i % 50 == 0 else (at.randrange(30), at.randrange(30))), 2 * at.randrange(4), 3) for i in range(n)]
    left, right = ([(i, *r[1:]) for i, r in enumerate(some(n, 10**7))] for n in (1200, 1500))
    at.shuffle(right)
    names = "id long, page int, x int, y int, w int, h int"
    got = boxes.nearest(spark.createDataFrame(left, names), spark.createDataFrame(right, names), "page", 300.0).collect()
    centre = lambda r: (r[2] + r[4] / 2.0, r[3] + r[5] / 2.0)
    distance = lambda a, b: (((centre(a)[0] - centre(b)[0]) ** 2) + ((centre(a)[1] - centre(b)[1]) ** 2)) ** 0.5
    expected = sorted((a[0], *min((distance(a, b), b[0]) for b in right if b[1] == a[1])) for a in left)
    assert [(r.left_id, r.right_id) for r in sorted(got)] == [(a, b) for a, _, b in expected]
    assert [r.distance for r in sorted(got)] == pytest.approx([d for _, d, _ in expected])
    assert not any("bx#" in p for p in plans)


def plain_merge(todo, at_least, distance):
    todo, out = sorted(todo, key=lambda b: (b[1], b[0], b[2], b[3])), []
    while todo:
        b, n, found = list(todo.pop(0)), 1, True
        while found:
            found = False
            for i, o in enumerate(todo):
                far = (((b[0] + b[2] / 2) - (o[0] + o[2] / 2)) ** 2 + ((b[1] + b[3] / 2) - (o[1] + o[3] / 2)) ** 2) ** 0.5
                if overlap((0, 0, *b), (0, 0, *o)) >= at_least or far <= distance:
                    x, y = min(b[0], o[0]), min(b[1], o[1])
                    b = [x, y, max(b[0] + b[2], o[0] + o[2]) - x, max(b[1] + b[3], o[1] + o[3]) - y]
                    todo.pop(i)
                    n, found = n + 1, True
                    break
        out.append((*b, n))
    return sorted(out)


@pytest.mark.parametrize("seed", range(5))
def test_merging_equals_the_plain_loop(seed):
    rng = random.Random(seed)
    b = [(rng.randrange(300), rng.randrange(300), rng.randrange(1, 60), rng.randrange(1, 60)) for _ in range(60)]
    got = boxes.merge_group(pd.DataFrame(b, columns=["x", "y", "w", "h"]), 0.14, 25.0)
    assert sorted(map(tuple, got.values.tolist())) == [tuple(map(float, r)) for r in plain_merge(b, 0.14, 25.0)]


def test_rows_are_anchored(spark):
    df = spark.createDataFrame([(1, "a", 5.0, 0.0), (1, "b", 1.0, 39.0), (1, "c", 0.0, 41.0), (1, "d", 9.0, 80.0), (1, "e", 0.0, 82.0)], "p int, id string, x double, y double")
    got = {r.id: (r.row_no, r.column_no) for r in boxes.row_buckets(df, ["p"], 40.0).collect()}
    assert got == {"b": (1, 1), "a": (1, 2), "c": (2, 1), "d": (2, 2), "e": (3, 1)}


@pytest.mark.parametrize("settled", [0, 150, 500_000])
def test_suppression_of_long_chains(spark, monkeypatch, settled):
    monkeypatch.setattr(boxes, "SETTLED", settled)
    at = random.Random(settled)
    rows = [(i, 1 + i % 2, i // 2 * 4, 0, 10, 10) for i in range(24)] + [(200 + i, 3, at.randrange(60), at.randrange(60), 10, 10 + at.randrange(5)) for i in range(80)]
    kept = []
    for b in rows:
        def iou(a, b=b):
            w, h = min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2]), min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3])
            return w * h / (a[4] * a[5] + b[4] * b[5] - w * h) if w > 0 and h > 0 else 0

        if not any(a[1] == b[1] and iou(a) >= 0.2 for a in kept):
            kept.append(b)
    df = spark.createDataFrame(rows, "id int, page int, x int, y int, w int, h int")
    got = boxes.suppress(df, "page", [F.col("id")], 0.2, 60.0)
    assert sorted(r.id for r in got.collect()) == sorted(b[0] for b in kept)


@pytest.mark.parametrize("seed", range(4))
def test_folds_of_a_sheet_equal_plain_loops(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b"]), f"i{n:03d}", float(rng.randrange(300)), float(rng.randrange(900 if seed % 2 else 90)), float(rng.randrange(1, 60)), float(rng.randrange(1, 60))) for n in range(90)]
    df = spark.createDataFrame(rows, "p string, id string, x double, y double, w double, h double")
    placed, blocks = {}, []
    for p in ("a", "b"):
        anchor, number, members = None, 0, []
        for r in sorted((r for r in rows if r[0] == p), key=lambda r: (r[3], r[2], r[1])):
            if anchor is None or r[3] - anchor > 20:
                anchor, number = r[3], number + 1
            members.append((number, r[2], r[1]))
        for n in range(1, number + 1):
            placed |= {m[2]: (n, k) for k, m in enumerate(sorted(m for m in members if m[0] == n), 1)}
        run = None
        mine = []
        for r in sorted((r for r in rows if r[0] == p), key=lambda r: (r[3], r[2], r[4], r[5])):
            if run and r[3] <= run[3] + 15 and r[2] <= run[2] + 15:
                run[:] = [min(run[0], r[2]), min(run[1], r[3]), max(run[2], r[2] + r[4]), max(run[3], r[3] + r[5]), run[4] + 1]
            else:
                run = [r[2], r[3], r[2] + r[4], r[3] + r[5], 1]
                mine.append(run)
        blocks += [(p, n, b[0], b[1], b[2] - b[0], b[3] - b[1], b[4]) for n, b in enumerate(mine, 1)]
    assert {r.id: (r.row_no, r.column_no) for r in boxes.row_buckets(df, ["p"], 20.0).collect()} == placed
    assert sorted(tuple(r) for r in boxes.coalesce_boxes(df, ["p"], 15.0).collect()) == sorted(blocks)
