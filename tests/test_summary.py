"""The per-stream, per-day summary: what reads only it, what it prunes, and that pruning changes no row."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import queries as registry
from tidemark.operators import dashboard as D
from tidemark.sources import summary as SU

QUERIES = registry.registered()
MARKS = "bar_high_water history_high_water event_high_water due_streams watchlist data_status selection_status asset_availability".split()
NEWEST = """
latest_bars aggregate_volume volume_breakdown chart_all chart_single aggregate_open_interest open_interest_breakdown
aggregate_funding funding_breakdown long_short long_short_breakdown taker taker_breakdown aggregate_liquidations
liquidation_breakdown open_interest_single long_short_single taker_single funding_single liquidation_single derivatives_all
derivatives_single
""".split()
FACTS = "market_data_raw|open_interest_history|funding_rate_history|long_short_ratio_history|taker_buy_sell_volume_history|liquidation_event"


def scans(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


@pytest.fixture(autouse=True)
def whole_lines(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")


@pytest.mark.parametrize("name", MARKS)
def test_marks_scan_no_fact_table(name, spark, sf_dir):
    found = scans(QUERIES[name](spark, sf_dir))
    assert any("/days-" in x for x in found) and not any(re.search(rf"/({FACTS})-", x) for x in found)


@pytest.mark.parametrize("name", NEWEST)
def test_newest_series_prune_days(name, spark, sf_dir):
    found = [x for x in scans(QUERIES[name](spark, sf_dir)) if re.search(rf"/({FACTS})-", x)]
    assert found
    for scan in found:
        filters = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
        assert re.search(r"day#\d+\) AND dynamicpruning|dynamicpruningexpression\(day#", filters), filters


def test_walking_back_takes_the_days_that_hold_enough(spark):
    day = lambda n: dt.date(2024, 1, n)
    held = spark.createDataFrame(
        [("a", day(9), 3), ("a", day(8), 2), ("a", day(7), 9), ("a", day(1), 1), ("old", day(2), 1), ("old", day(1), 1)], "g string, day date, held bigint"
    )
    got = lambda n: sorted(r["day"].day for r in SU.needed_days(held, ["g"], n).collect())
    assert got(1) == [2, 9] and got(3) == [1, 2, 9] and got(4) == [1, 2, 8, 9] and got(6) == [1, 2, 7, 8, 9]
    assert got(F.when(F.col("g") == "a", 5).otherwise(1)) == [2, 8, 9]


def test_buckets_of_a_mask(spark):
    random.seed(3)
    rows = [(sorted(random.sample(range(60), random.randint(1, 40))),) for _ in range(200)]
    masks = spark.createDataFrame([(sum(1 << m for m in minutes), minutes) for (minutes,) in rows], "mask long, minutes array<int>")
    for row in masks.select("minutes", *[SU.buckets_seen(F.col("mask"), F.lit(i)).alias(f"b{i}") for i in ("1m", "5m", "1h")]).collect():
        assert row["b1m"] == len(row["minutes"]) and row["b5m"] == len({m // 5 for m in row["minutes"]}) and row["b1h"] == 1


def lake(spark, seed):
    """Streams of three assets that are dense, sparse or ended long ago; a bar or event may lie on any day of a year."""
    random.seed(seed)
    start = dt.datetime(2023, 3, 1)
    markets = [("binance", "A/USDT:USDT"), ("binance", "A/USDC:USDC"), ("bybit", "A/USDT:USDT"), ("binance", "B/USDT:USDT"), ("bybit", "C/USDT:USDT")]
    bars, series, events = [], [], []
    for exchange, symbol in markets:
        for interval, minutes in (("1h", 60), ("5m", 5)):
            last, share = random.randint(30, 365 * 24 * 60), random.choice([0.001, 0.02, 0.3])
            times = {last - minutes * int(random.expovariate(share)) for _ in range(60)}
            for at in sorted(t // minutes * minutes for t in times if t >= 0):
                when = start + dt.timedelta(minutes=at)
                key = (exchange, symbol, "perpetual", interval)
                bars += [(*key, d, when, 1.0, 2.0, 0.5, float(at), 3.0) for d in ("kline", "mark_price_kline") if random.random() < 0.8]
                series.append((*key, when, float(at), None if at % 3 else 2.0 * at, at / 7))
        for _ in range(random.choice([3, 200])):
            when = start + dt.timedelta(seconds=random.randint(0, random.choice([86_400, 365 * 86_400])), milliseconds=random.choice([0, 500]))
            events += [(exchange, symbol, "perpetual", when, random.choice(["buy", "SELL", None]), 2.0, 3.0, None)] * random.choice([1, 1, 2])
    names = "exchange string, symbol string, market_type string"
    tables = {
        "bars": spark.createDataFrame(set(bars), f"{names}, bar_interval string, source_dataset string, open_time timestamp, open double, high double, low double, close double, volume double")
        .select("*", F.lit(None).cast("decimal(28,8)").alias("quote_volume"), F.col("open_time").alias("close_time")),
        "series": spark.createDataFrame(
            {(*r[:5],): r for r in series}.values(), f"{names}, bar_interval string, open_time timestamp, open_interest_amount double, open_interest_value double, long_short_ratio double"
        ).select("*", F.col("open_interest_amount").alias("buy_volume"), F.lit(1.0).alias("sell_volume"), F.lit(2.0).alias("buy_sell_ratio")),
        "events": spark.createDataFrame(events, f"{names}, liquidation_time timestamp, side string, price double, amount double, cost double"),
    }
    tables["funding"] = tables["events"].select("exchange", "symbol", "market_type", F.col("liquidation_time").alias("funding_time"), F.col("price").alias("funding_rate")).distinct()
    cast = {"open": "decimal(18,2)", "high": "decimal(18,2)", "low": "decimal(18,2)", "close": "decimal(18,2)", "volume": "decimal(18,2)"}
    for c, kind in cast.items():
        tables["bars"] = tables["bars"].withColumn(c, F.col(c).cast(kind))
    for c in ("price", "amount", "cost"):
        tables["events"] = tables["events"].withColumn(c, F.col(c).cast("decimal(18,2)"))
    time = {"bars": "open_time", "series": "open_time", "events": "liquidation_time", "funding": "funding_time"}
    tables = {n: t.withColumn("ingested_at", F.col(time[n])).withColumn("day", F.to_date(time[n])) for n, t in tables.items()}
    tables = {n: t.cache() for n, t in tables.items()}
    days = SU.summarise(tables["bars"], "open_time", close="close_time")
    for name in ("open_interest", "long_short_ratio", "taker_buy_sell_volume"):
        days = days.unionByName(SU.summarise(tables["series"], "open_time", name))
    days = days.unionByName(SU.summarise(tables["funding"], "funding_time", "funding_rate"))
    days = days.unionByName(SU.summarise(tables["events"], "liquidation_time", "liquidation")).cache()
    listed = [(e, s, "perpetual", s[0], s.split(":")[1], True) for e, s in markets]
    return tables, days, spark.createDataFrame(listed, f"{names}, base_asset string, quote_asset string, is_active boolean")


@pytest.mark.parametrize("seed", [1, 2])
def test_pruning_changes_no_row(spark, seed):
    t, days, markets = lake(spark, seed)
    asked = {
        "latest_bars": (t["bars"],), "aggregate_volume": (t["bars"], markets), "volume_breakdown": (t["bars"], markets), "chart_all": (t["bars"], markets),
        "aggregate_open_interest": (t["series"], markets), "open_interest_breakdown": (t["series"], markets), "long_short": (t["series"], markets),
        "taker": (t["series"], markets), "aggregate_funding": (t["funding"], markets), "funding_breakdown": (t["funding"], markets),
        "aggregate_liquidations": (t["events"], markets), "liquidation_breakdown": (t["events"], markets), "open_interest_single": (t["series"],),
        "long_short_single": (t["series"],), "taker_single": (t["series"],), "funding_single": (t["funding"],), "liquidation_single": (t["events"],),
    }
    for name, tables in asked.items():
        for limit in (1, 5, 17):
            whole, pruned = (getattr(D, name)(*tables, limit=limit, days=d) for d in (None, days))
            assert sorted(map(str, pruned.collect())) == sorted(map(str, whole.collect())), (name, limit)
