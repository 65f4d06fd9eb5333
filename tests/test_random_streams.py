"""Quality rules, last-row-wins and plans on random streams against plain Python."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import timegrid as G
from tidemark.operators import factors as FA
from tidemark.operators import normalize as N
from tidemark.operators import quality as Q
from tidemark.plans import requests as P

BASE = dt.datetime(2024, 1, 1)
RAW = (
    "exchange string, symbol string, market_type string, bar_interval string, source_dataset string, open_time timestamp, "
    "fetch_seq bigint, open double, high double, low double, close double, volume double"
)
PLAN = (
    "job_name string, exchange string, symbol string, market_type string, bar_interval string, source_dataset string, "
    "fetch_mode string, anchor_open_time timestamp, target_last_open_time timestamp"
)


def random_streams(seed):
    rng = random.Random(seed)
    raw, plans = [], []
    for name in ("hot", "cold", "sparse"):
        stream = ("x", name, "spot", "1h", "kline")
        count = {"hot": 1500, "cold": 60, "sparse": 40}[name]
        width = {"hot": 90 * 24 * 60, "cold": 3000, "sparse": 400 * 24 * 60}[name]
        for seq in range(count):
            minute = rng.randrange(0, width, 30) if rng.random() < 0.1 else rng.randrange(0, width, 60)
            low, high = sorted((rng.random(), rng.random()))
            close = rng.uniform(low, high) if rng.random() < 0.9 else high + 1
            raw.append((*stream, BASE + dt.timedelta(minutes=minute), seq, low, high, low, close, rng.choice([1.0, 2.0, -1.0])))
        anchor = BASE - dt.timedelta(hours=rng.choice([1, 5])) if rng.random() < 0.7 else None
        plans.append(("j", *stream, "incremental", anchor, BASE + dt.timedelta(minutes=width + rng.choice([0, 600]))))
    rng.shuffle(raw)
    return raw, plans


def expected_issues(raw, plans):
    out = []
    for _, *stream, _mode, anchor, target in plans:
        rows = sorted((r for r in raw if list(r[:5]) == stream), key=lambda r: r[6])
        last, repeats = {}, []
        for r in rows:
            if r[5] in last:
                repeats.append(r[5])
            last[r[5]] = r
        iso = [t.isoformat() for t in sorted(repeats)]
        name = stream[1]
        if iso:
            out.append((name, "duplicate_bar", len(iso), 0, json.dumps({"duplicate_count": len(iso), "duplicate_open_times": iso[:20]})))
        times = sorted(last)
        invalid = [t for t in times if not last[t][9] <= last[t][10] <= last[t][8]]
        negative = [t for t in times if last[t][11] < 0]
        for kind, found in (("invalid_ohlc", invalid), ("negative_volume", negative)):
            if found:
                detail = {"affected_count": len(found), "open_times": [t.isoformat() for t in found[:20]]}
                out.append((name, kind, None, len(found), json.dumps(detail)))
        step, before = dt.timedelta(hours=1), anchor
        for t in times:
            if before is not None and t - before > step:
                gap = {"gap_from": (before + step).isoformat(), "gap_to": (t - step).isoformat(), "missing_count": (t - before) // step - 1}
                out.append((name, "missing_bar", gap["missing_count"], 0, json.dumps(gap)))
            before = t
        lag = target - times[-1]
        if lag > 2 * step:
            detail = {"latest_observed_open_time": times[-1].isoformat(), "expected_latest_open_time": target.isoformat(), "lag_seconds": int(lag.total_seconds())}
            out.append((name, "late_data", 1, 0, json.dumps(detail)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_issues_equal_brute_force(spark, seed):
    raw, plans = random_streams(seed)
    collapsed = N.collapse_bars(spark.createDataFrame(raw, RAW).repartition(5))
    found = Q.quality_issues(collapsed, spark.createDataFrame(plans, PLAN)).collect()
    got = sorted(
        ((r["symbol"], r["issue_type"], r["expected_count"], r["actual_count"], json.dumps(json.loads(r["detail"]))) for r in found), key=str
    )
    assert got == expected_issues(raw, plans)


def test_gate_table(spark):
    rows = [
        ("kline", "bybit", "1M", "run"), ("long_short_ratio", "bybit", "1h", "skipped"), ("long_short_ratio", "binance", "1h", "run"),
        ("taker_buy_sell_volume", "binance", "1m", "skipped"), ("open_interest", "kucoinfutures", "2h", "failed"),
        ("open_interest", "kucoinfutures", "1d", "run"), ("open_interest", "coinbase", "1h", "skipped"), ("open_interest", "bybit", "1h", "run"),
        ("liquidation", "binance", "event", "skipped"), ("liquidation", "bybit", "event", "run"), ("liquidation", "coinbase", "event", "skipped"),
        ("funding_rate", "bybit", "8h", "run"), ("funding_rate", "coinbase", "8h", "skipped"), ("trades", "binance", "1h", "failed"),
    ]
    jobs = spark.createDataFrame(rows, "source_dataset string, exchange string, bar_interval string, wanted string")
    methods = ["fetchOpenInterestHistory", "fetchFundingRateHistory", "fetchLiquidations"]
    offered = spark.createDataFrame([("bybit", m) for m in methods] + [("binance", m) for m in methods[:2]], "exchange string, method string")
    wrong = P.capability_gate(jobs, offered).where("gate <> wanted OR (gate = 'run') <> (gate_message IS NULL)")
    assert wrong.collect() == []


def test_due_at_exactly_one_cadence(spark):
    now = dt.datetime(2024, 1, 1, 12)
    jobs = spark.createDataFrame(
        [("a", "kline", "1h", now - dt.timedelta(seconds=3600)), ("b", "kline", "1h", now - dt.timedelta(seconds=3599)), ("c", "kline", "1h", None)],
        "job_name string, source_dataset string, bar_interval string, last_ingested_at timestamp",
    )
    assert sorted(r["job_name"] for r in P.due_streams(jobs, G.as_timestamp("2024-01-01 12:00:00")).collect()) == ["a", "c"]


def test_step_rounds_half_up_and_has_a_floor(spark):
    points = spark.createDataFrame([("a", 0), ("a", 61), ("a", 201), ("b", 5), ("c", 0), ("c", 10)], "k string, time bigint")
    assert {r["k"]: r["step_seconds"] for r in FA.bar_step(points, ["k"]).collect()} == {"a": 101, "b": 60, "c": 60}
    assert FA.time_range_filter(points, 5, 61).count() == 3


def test_families(spark):
    jobs = spark.createDataFrame([(d,) for d in [*C.ALL_DATASETS, "trades", None]], "source_dataset string")
    branches, unknown = N.split_by_family(jobs)
    assert {name: rows.count() for name, rows in branches.items()} == {
        "ohlcv": 3, "open_interest": 1, "funding_rate": 1, "long_short_ratio": 1, "taker_buy_sell_volume": 1, "liquidation": 1
    }
    assert unknown.count() == 2


def test_availability_and_status_selection(spark):
    from tidemark.operators import dashboard as D

    rows = spark.createDataFrame([("BTC", ["binance"]), ("X", [])], "base_asset string, exchanges array<string>")
    got = {(r["base_asset"], e): r["available"] for e in ("all", "binance", "bybit") for r in D.asset_availability(rows, F.lit(e)).collect()}
    assert got == {("BTC", "all"): True, ("BTC", "binance"): True, ("BTC", "bybit"): False, ("X", "all"): False, ("X", "binance"): False, ("X", "bybit"): False}
