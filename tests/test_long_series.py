"""Rolling scores of long histories cut into spans, and nearest joins by tolerance buckets."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import factors as FA
from tidemark.operators import nearest as NJ


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("span", [1, 7, 100, 100_000])
def test_spans_give_the_scores_of_whole_series(spark, span):
    random.seed(span)
    rows = []
    for key, n, width in (("dense", 300, 300), ("sparse", 60, 100_000), ("one", 1, 10), ("same", 40, 10)):
        for _ in range(n):
            rows.append((key, random.randrange(-width, width), random.choice([None, 1.0, random.random()]), random.randrange(5)))
    points = spark.createDataFrame(rows, "key string, time long, value double, note long").repartition(5)
    whole = FA.rolling_zscore(points, ["key"], rows=6)
    cut = FA.rolling_zscore(points, ["key"], rows=6, span=span)
    assert cut.columns == whole.columns

    def rounded(x):
        return sorted((r.key, r.time, str(r.value), r.note, None if r.zscore is None else round(r.zscore, 9)) for r in x.collect())

    got, want = rounded(cut), rounded(whole)
    assert [str(x) for x in got] == [str(x) for x in want]
    assert any(r[-1] is not None for r in got)


def test_span_windows_hold_a_span(spark):
    points = spark.range(1000).select(F.lit("a").alias("key"), F.col("id").alias("time"), F.rand(1).alias("value"))
    plan = _plan(FA.rolling_zscore(points, ["key"], span=50))
    windows = [line for line in plan.splitlines() if "Window [" in line and "value" in line and "stddev" in line]
    assert windows and all("_span" in line for line in windows) and "WindowGroupLimit" in plan


def brute(left, right, tolerance):
    out = []
    for key, time, note in left:
        near = [(abs(t - time), t, v) for k, t, v in right if k == key and abs(t - time) <= tolerance]
        best = min(near, key=lambda x: (x[0], x[1], x[2])) if near else None
        out.append((key, time, note, None if best is None else best[1], None if best is None else best[2]))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,tolerance", [(1, 1), (2, 7), (3, 60), (4, 1000), (5, 0)])
def test_buckets_equal_brute_force(spark, seed, tolerance):
    random.seed(seed)
    left = [(random.choice("abcz"), random.randrange(-300, 300), i) for i in range(200)]
    right = [(random.choice("abcy"), random.randrange(-400, 400), float(random.randrange(9))) for _ in range(120)]
    lf = spark.createDataFrame(left, "key string, time long, note long").repartition(4)
    rf = spark.createDataFrame(right, "key string, time long, value double").repartition(3)
    got = NJ.nearest_within_buckets(lf, rf, ["key"], tolerance)
    rows = sorted(((r.key, r.time, r.note, r.nearest and r.nearest.time, r.nearest and r.nearest.value) for r in got.collect()), key=str)
    assert rows == brute(left, right, tolerance)
    assert NJ.nearest_within_buckets(lf.limit(0), rf, ["key"], tolerance).count() == 0
    none = NJ.nearest_within_buckets(lf, rf.limit(0), ["key"], tolerance).collect()
    assert len(none) == 200 and all(r.nearest is None for r in none)


def test_each_side_is_scanned_once(spark, tables):
    candles = tables.market_data_raw.where("source_dataset = 'kline'").select("exchange", "symbol", F.unix_seconds("open_time").alias("time"), "close")
    interest = tables.open_interest_history.select("exchange", "symbol", F.unix_seconds("open_time").alias("time"), "open_interest_amount")
    plan = _plan(NJ.nearest_within_buckets(candles, interest, ["exchange", "symbol"], 3600))
    assert plan.count("FileScan") == 2
