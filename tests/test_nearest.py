"""Nearest joins against a binary search in Python."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import factors as FA
from tidemark.operators import nearest as N

POINT = "k string, time bigint, value double"


def brute(points, at):
    """The nearest point; the earlier one on a tie."""
    if not points:
        return None
    times = [p[0] for p in points]
    i = bisect.bisect_left(times, at)
    around = [points[j] for j in (i - 1, i) if 0 <= j < len(points)]
    return min(around, key=lambda p: (abs(p[0] - at), p[0]))


def frames(spark, left, right):
    return (
        spark.createDataFrame([(k, t) for k, t in left], "k string, time bigint"),
        spark.createDataFrame([(k, t, v) for k, t, v in right], POINT),
    )


def run(spark, left, right, **options):
    rows = N.nearest_join(*frames(spark, left, right), ["k"], **options).collect()
    return sorted((r["k"], r["time"], r["nearest"]["time"] if r["nearest"] else None) for r in rows)


@pytest.mark.parametrize("span", [None, 50, 86400])
def test_tie_ends_and_empty(spark, span):
    assert run(spark, [("a", 30)], [("a", 0, 1.0), ("a", 60, 2.0)], span_seconds=span) == [("a", 30, 0)]
    assert run(spark, [("a", 0), ("a", 500)], [("a", 60, 1.0), ("a", 120, 2.0)], span_seconds=span) == [("a", 0, 60), ("a", 500, 120)]
    assert run(spark, [("a", 0)], [("b", 60, 1.0)], span_seconds=span) == [("a", 0, None)]


def test_tolerance_is_inclusive(spark):
    right = [("a", 100, 1.0)]
    got = run(spark, [("a", 40), ("a", 39), ("a", 160), ("a", 161)], right, tolerance=F.lit(60))
    assert got == [("a", 39, None), ("a", 40, 100), ("a", 160, 100), ("a", 161, None)]


@pytest.mark.parametrize("seed, span, distance", [(1, 100, 3000), (2, 7, 500), (3, None, 2000), (4, 86400, 900000), (5, 1000, 200)])
def test_random_series(spark, seed, span, distance):
    rng = random.Random(seed)
    left = [(rng.choice("abcd"), rng.randint(-distance, distance)) for _ in range(400)]
    left += [("a", 17)] * 50  # many rows of one time
    right = {(rng.choice("abc"), rng.randint(-distance, distance)): rng.random() for _ in range(300)}
    points = {k: sorted((t, v) for (kk, t), v in right.items() if kk == k) for k in "abcd"}
    got = N.nearest_join(*frames(spark, left, [(k, t, v) for (k, t), v in right.items()]), ["k"], span_seconds=span).collect()
    expected = sorted((k, t, *(brute(points[k], t) or (None, None))) for k, t in left)
    actual = sorted((r["k"], r["time"], *((r["nearest"]["time"], r["nearest"]["value"]) if r["nearest"] else (None, None))) for r in got)
    assert len(actual) == len(left)
    assert sorted(actual, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("flags", [{"unique_left": True}, {"unique_right": True}, {"unique_left": True, "unique_right": True}])
def test_promises_do_not_change_the_result(spark, flags):
    rng = random.Random(9)
    left = sorted({(rng.choice("ab"), rng.randint(0, 5000)) for _ in range(200)})
    right = [(k, t, float(t)) for k, t in sorted({(rng.choice("ab"), rng.randint(0, 5000)) for _ in range(60)})]
    assert run(spark, left, right, span_seconds=300, **flags) == run(spark, left, right, span_seconds=300)


def test_repeated_right_times_keep_one(spark):
    left, right = frames(spark, [("a", 5)], [("a", 5, 2.0), ("a", 5, 1.0)])
    rows = N.nearest_join(left, right, ["k"]).collect()
    assert [(r["nearest"]["time"], r["nearest"]["value"]) for r in rows] == [(5, 1.0)]


def test_ratio_drops_empty_candles(spark):
    candles = spark.createDataFrame([("a", 0, 2.0), ("a", 10, 0.0), ("b", 0, 1.0)], "k string, time bigint, volume double")
    interest = spark.createDataFrame([("a", 3, 8.0)], POINT)
    assert [tuple(r) for r in FA.oi_volume_ratio(candles, interest, ["k"]).collect()] == [("a", 0, 4.0)]
