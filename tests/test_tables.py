"""Writes: idempotence, first and last writer, snapshots, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import timegrid as G
from tidemark.operators import dashboard as D
from tidemark.session import scratch_path
from tidemark.sources import tables as TB
from tidemark.streaming import liquidations as L



def now():
    return G.as_timestamp("2024-02-01 00:00:00")


BARS = (
    "exchange string, symbol string, market_type string, bar_interval string, source_dataset string, open_time timestamp, "
    "close double, fetch_seq bigint"
)


def bar(minute, close, seq=0, day=1):
    return ("binance", "A", "spot", "1h", "kline", dt.datetime(2024, 1, day) + dt.timedelta(minutes=minute), close, seq)


def test_first_writer_wins_and_rerun_inserts_nothing(spark):
    path = scratch_path(spark, "bars")
    batch = spark.createDataFrame([bar(0, 2.0, 1), bar(0, 1.0, 0), bar(60, 3.0)], BARS)
    assert TB.append_bars(batch, path, now()) == 2
    assert TB.append_bars(batch, path, now()) == 0
    later = spark.createDataFrame([bar(0, 9.0), bar(120, 4.0), bar(0, 5.0, day=9)], BARS)
    assert TB.append_bars(later, path, now()) == 2
    got = sorted((r["open_time"], float(r["close"])) for r in TB.read_table(spark, path).collect())
    assert [c for _, c in got] == [1.0, 3.0, 4.0, 5.0]
    assert TB.append_bars(batch.limit(0), path, now()) == 0


def test_liquidations_are_kept_twice(spark, tables):
    path = scratch_path(spark, "liquidations")
    n = tables.liquidation_event.count()
    assert [TB.append_liquidations(tables.liquidation_event, path, now()) for _ in range(2)] == [n, n]
    assert TB.read_table(spark, path).count() == 2 * n


def test_upsert_keeps_absent_rows_and_last_row_wins(spark):
    path = scratch_path(spark, "registry")
    schema = "exchange string, symbol string, market_type string, base_asset string, quote_asset string, seq bigint"
    TB.upsert_registry(spark.createDataFrame([("x", "A", "spot", "a1", "q", 0), ("x", "A", "spot", "a2", "q", 1), ("x", "B", "spot", "b", "q", 2)], schema), path, now(), ["seq"])
    TB.upsert_registry(spark.createDataFrame([("x", "A", "spot", "a3", "q", 0)], schema), path, now(), ["seq"])
    got = {r["symbol"]: (r["base_asset"], r["is_active"]) for r in TB.read_snapshot(spark, path, "asset_registry").collect()}
    assert got == {"A": ("a3", True), "B": ("b", True)}


def test_snapshot_without_commit_is_ignored(spark):
    path = scratch_path(spark, "watch")
    TB.upsert_watchlist(TB.listed_assets(spark, ["btc", "eth", "BTC"]), path, now())
    TB.read_snapshot(spark, path, "watchlist_asset").limit(0).write.parquet(f"{path}/snapshots/2")  # a crash before its commit
    got = {r["base_asset"]: r["display_order"] for r in TB.read_snapshot(spark, path, "watchlist_asset").collect()}
    assert got == {"BTC": 3, "ETH": 2}
    TB.upsert_watchlist(TB.listed_assets(spark, ["sol"]), path, now())
    assert TB.read_snapshot(spark, path, "watchlist_asset").count() == 3


def test_reseeding_deactivates(spark, tables):
    from tidemark.operators import seeding as SE

    path = scratch_path(spark, "jobs")
    seedable = SE.seed_market_filter(tables.exchange_market)
    order = ["seq", "interval_position"]
    TB.upsert_jobs(SE.seed_jobs(seedable, ["1h"], active=True), path, now(), order)
    TB.upsert_jobs(SE.seed_jobs(seedable, ["1h"]), path, now(), order)
    rows = TB.read_snapshot(spark, path, "ingestion_job_config")
    assert rows.where("is_active").count() == 0 and rows.count() == seedable.count()


def test_job_lookup_errors(spark, tables):
    with pytest.raises(LookupError, match="Active jobs: "):
        TB.job_lookup(tables.jobs, "nope")
    with pytest.raises(LookupError, match="nor any other active job"):
        TB.job_lookup(tables.jobs.where(F.lit(False)), "nope")


def _messages(spark, tables):
    jobs = tables.jobs.where("source_dataset = 'liquidation' AND exchange = 'binance' AND symbol LIKE '%/USDT:USDT'")
    landed = scratch_path(spark, "landed")
    tables.force_order_raw.repartition(4).write.parquet(landed)
    return jobs, landed


def test_stream_equals_batch_and_restart_adds_nothing(spark, tables):
    from tidemark.operators import normalize as N

    jobs, landed = _messages(spark, tables)
    sink, log, checkpoint = (scratch_path(spark, n) for n in ("sink", "log", "checkpoint"))
    expected = N.decode_force_orders(tables.force_order_raw, jobs).count()
    for _ in range(2):
        messages = L.read_messages(spark, landed, "event_id bigint, raw string", maxFilesPerTrigger="1")
        L.start_liquidation_stream(messages, jobs, sink, log, checkpoint, drain=True).awaitTermination()
        assert L.read_batches(spark, sink).count() == expected
    totals = L.stream_totals(L.read_batches(spark, log)).first()
    assert (totals["events_seen"], totals["rows_inserted"]) == (expected, expected)


def test_failed_flush_is_logged_and_raised(spark, tables):
    jobs, landed = _messages(spark, tables)
    log = scratch_path(spark, "log")
    blocked = scratch_path(spark, "blocked")
    spark.range(1).write.parquet(blocked)  # a file where the sink folder should be
    part = [f for f in spark.read.parquet(blocked).inputFiles()][0]
    messages = L.read_messages(spark, landed, "event_id bigint, raw string")
    query = L.start_liquidation_stream(messages, jobs, part, log, scratch_path(spark, "checkpoint"), drain=True)
    with pytest.raises(Exception):
        query.awaitTermination()
    rows = L.read_batches(spark, log).collect()
    assert rows and all(r["status"] == "failed" and r["rows_inserted"] == 0 and r["error_message"] for r in rows)


def test_unique_stream_drops_replays(spark, tables):
    jobs, landed = _messages(spark, tables)
    once = tables.force_order_raw.count()
    tables.force_order_raw.repartition(2).write.mode("append").parquet(landed)
    assert spark.read.parquet(landed).count() == 2 * once
    sink = scratch_path(spark, "sink")
    messages = L.read_messages(spark, landed, "event_id bigint, raw string")
    L.start_liquidation_stream(messages, jobs, sink, scratch_path(spark, "log"), scratch_path(spark, "checkpoint"), drain=True, unique=True).awaitTermination()
    rows = L.read_batches(spark, sink)
    assert rows.count() == rows.select("raw").distinct().count()


EVENTS = "exchange string, symbol string, market_type string, liquidation_time timestamp, side string, price double, amount double, cost double"


def test_bucket_stream_keeps_late_rows_inside_the_limit(spark):
    def event(day, minute, cost):
        return ("x", "A", "perpetual", dt.datetime(2024, 1, day) + dt.timedelta(minutes=minute), "sell", None, None, cost)

    landed = scratch_path(spark, "events")
    batches = [[event(10, 0, 1.0)], [event(10, 30, 2.0), event(12, 0, 4.0)], [event(11, 10, 8.0), event(5, 0, 16.0)], [event(12, 1, 32.0)]]
    sink, checkpoint = scratch_path(spark, "buckets"), scratch_path(spark, "checkpoint")
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(EVENTS).parquet(landed)
        L.start_bucket_stream(stream, sink, checkpoint, "1h", drain=True).awaitTermination()
    got = {r["bucket_time"]: float(r["total_value"]) for r in L.latest_buckets(spark, sink).collect()}
    # an event a week late counts like any other
    assert got == {
        dt.datetime(2024, 1, 10): 3.0, dt.datetime(2024, 1, 12): 36.0, dt.datetime(2024, 1, 11): 8.0, dt.datetime(2024, 1, 5): 16.0
    }
    exact = D.liquidation_buckets(spark.read.schema(EVENTS).parquet(landed), ["1h"])
    assert float(exact.agg(F.sum("total_value")).first()[0]) == 63.0
