"""Points in intervals against every pair."""

from __future__ import annotations

import random

import pytest

from gavel.operators import sweep

POINTS = "pid long, key int, at long, k string, p int, chunk int"
INTERVALS = "iid long, key int, lo long, hi long, nth int, slice int"


def _rows(seed, n, m, span, hot):
    rng = random.Random(seed)
    points = [(i, rng.choice([1, 1, 1, 2, None]), 50 if rng.random() < hot else rng.choice([rng.randint(0, span), None]), "x", 1, 1) for i in range(n)]
    intervals = []
    for i in range(m):
        lo = rng.randint(-5, span)
        hi = lo + rng.choice([0, 0, 1, 5, span // 10, 2 * span, -1])
        intervals.append((i, rng.choice([1, 2, 3, None]), rng.choice([lo, lo, lo, 50, None]), rng.choice([hi, hi, hi, None]), 1, 1))
    return points, intervals


def _plain(points, intervals, keyed):
    return sorted(
        (p[0], i[0])
        for p in points
        for i in intervals
        if None not in (p[2], i[2], i[3]) and i[2] <= p[2] <= i[3] and (not keyed or (p[1] == i[1] and p[1] is not None))
    )


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize(("hot", "target", "slices"), [(0.0, 10_000, 1000), (0.0, 20, 7), (0.4, 15, 3)])
def test_equals_every_pair(spark, keyed, hot, target, slices):
    points, intervals = _rows(3, 300, 120, 200, hot)
    p = spark.createDataFrame(points, POINTS).repartition(3)
    i = spark.createDataFrame(intervals, INTERVALS).repartition(2)
    found = sweep.points_in_intervals(p, i, ["key"] if keyed else [], "pid", "at", "iid", "lo", "hi", target, slices)
    assert found.columns == ["pid", "iid"]
    assert sorted(map(tuple, found.collect())) == _plain(points, intervals, keyed)


def test_empty_sides(spark):
    points, intervals = _rows(1, 20, 20, 50, 0)
    p, i = spark.createDataFrame(points, POINTS), spark.createDataFrame(intervals, INTERVALS)
    args = ["key"], "pid", "at", "iid", "lo", "hi"
    assert sweep.points_in_intervals(p.where("false"), i, *args).count() == 0
    assert sweep.points_in_intervals(p, i.where("false"), *args).count() == 0


def test_a_hot_moment_is_many_ranges(spark):
    points = [(i, 1, 7, "x", 1, 1) for i in range(400)]
    p, i = spark.createDataFrame(points, POINTS), spark.createDataFrame([(1, 1, 7, 7, 1, 1), (2, 1, 0, 99, 1, 1), (3, 1, 8, 9, 1, 1)], INTERVALS)
    found = sweep.points_in_intervals(p, i, ["key"], "pid", "at", "iid", "lo", "hi", 50, 1)
    assert found.groupBy("iid").count().orderBy("iid").collect() == [(1, 400), (2, 400)]
