"""Flushes by number and by delay, bounds of a stream, replays into the one liquidation store, folded bucket sums."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import timegrid as G
from tidemark.operators import dashboard as D
from tidemark.session import scratch_path
from tidemark.sources import ledger as LG
from tidemark.sources import tables as TB
from tidemark.streaming import landed
from tidemark.streaming import liquidations as L

JOBS = "job_id string, job_name string, exchange string, symbol string, market_type string, bar_interval string, source_dataset string"
NAMES = ["events", "log", "checkpoint"]


@pytest.fixture()
def jobs(spark):
    rows = [(x, f"job-{x}", "binance", f"{x}/USDT:USDT", "perpetual", "event", "liquidation") for x in ("A", "B")]
    return spark.createDataFrame(rows, JOBS)


def message(i, symbol=None):
    order = {"s": (symbol or "AB"[i % 2]) + "USDT", "S": "SELL", "ap": "2.5", "z": str(i + 1), "T": 1704067200000 + i * 1000}
    return json.dumps({"e": "forceOrder", "E": 1, "o": order})


def land(spark, folder, *texts):
    spark.createDataFrame([(x,) for x in texts], "raw string").coalesce(1).write.mode("append").parquet(folder)


def flushes(spark, log):
    rows = L.read_batches(spark, log).groupBy("flush").agg(F.sum("rows_fetched").alias("n")).orderBy("flush").collect()
    return [r["n"] for r in rows]


def paths(spark):
    return [scratch_path(spark, n) for n in NAMES]


def test_sixty_messages_give_three_flushes(spark, jobs):
    folder = scratch_path(spark, "landed")
    land(spark, folder, *[message(i) for i in range(40)])
    land(spark, folder, *[message(i) for i in range(40, 60)])
    events, log, checkpoint = paths(spark)
    totals = L.run_liquidation_stream(folder, jobs, events, log, checkpoint, until_idle=True).first()
    assert flushes(spark, log) == [25, 25, 10]
    assert tuple(totals) == (2, 60, 60)
    stored = TB.read_table(spark, events)
    assert stored.count() == 60 and sorted(float(r.amount) for r in stored.collect()) == [float(i + 1) for i in range(60)]
    # more messages and a restart: positions go on, nothing comes twice
    land(spark, folder, *[message(i) for i in range(60, 90)])
    L.run_liquidation_stream(folder, jobs, events, log, checkpoint, until_idle=True)
    assert flushes(spark, log) == [25, 25, 10, 25, 5] and TB.read_table(spark, events).count() == 90


def test_admission_by_number_or_delay(spark, tmp_path, monkeypatch):
    folder, clock = scratch_path(spark, "landed"), [100.0]
    monkeypatch.setattr(landed.time, "monotonic", lambda: clock[0])
    options = {"path": folder, "state": f"{scratch_path(spark, 'state')}/s.json", "flush_events": "3", "flush_seconds": "10"}
    schema = spark.createDataFrame([], "raw string, position long").schema
    reader = landed.LandedReader(options, schema)
    assert reader.latestOffset() == {"position": 0}
    land(spark, folder, "a", "b")
    assert reader.latestOffset() == {"position": 0}
    clock[0] += 9.9
    assert reader.latestOffset() == {"position": 0}
    clock[0] += 0.1
    assert reader.latestOffset() == {"position": 2}
    land(spark, folder, "c", "d", "e", "f")
    assert reader.latestOffset() == {"position": 5} and reader.latestOffset() == {"position": 5}
    again = landed.LandedReader(options, schema)  # a restart waits anew, from the same end
    assert again.latestOffset() == {"position": 5}
    parts = again.partitions({"position": 1}, {"position": 4})
    rows = [(raw, at) for part in parts for batch in again.read(part) for raw, at in zip(*(c.to_pylist() for c in batch.columns))]
    assert rows == [("b", 1), ("c", 2), ("d", 3)]


def test_stop_after_so_many_events(spark, jobs):
    folder = scratch_path(spark, "landed")
    land(spark, folder, *[message(i, "Z" if i % 3 == 0 else None) for i in range(90)])  # a third has no job
    events, log, checkpoint = paths(spark)
    totals = L.run_liquidation_stream(folder, jobs, events, log, checkpoint, max_events=30, flush_seconds=0).first()
    assert totals["events_seen"] == totals["rows_inserted"] == 30
    kept = sorted(float(r.amount) for r in TB.read_table(spark, events).collect())
    assert kept == [i + 1.0 for i in range(90) if i % 3][:30]  # the first ones


def test_stop_when_time_is_up_flushes_what_waits(spark, jobs):
    folder = scratch_path(spark, "landed")
    land(spark, folder, *[message(i) for i in range(32)])
    events, log, checkpoint = paths(spark)
    begun = time.monotonic()
    totals = L.run_liquidation_stream(folder, jobs, events, log, checkpoint, timeout_seconds=8, flush_seconds=3600).first()
    assert 8 <= time.monotonic() - begun < 60
    assert totals["events_seen"] == 32 and flushes(spark, log) == [25, 7]
    with pytest.raises(LookupError):
        L.run_liquidation_stream(folder, jobs.limit(0), events, log, checkpoint)


def test_dashboard_reads_what_stream_and_append_store_once(spark, jobs):
    folder = scratch_path(spark, "landed")
    land(spark, folder, *[message(i) for i in range(10)])
    events, log, checkpoint = paths(spark)
    typed = jobs.select("exchange", "symbol", "market_type", F.lit("BTC").alias("base_asset"), F.lit(True).alias("is_active"))
    fetched = spark.createDataFrame(
        [("binance", "A/USDT:USDT", "perpetual", dt.datetime(2024, 1, 1, 0, 0, 30), "buy", 1.0, 7.0, 7.0)],
        "exchange string, symbol string, market_type string, liquidation_time timestamp, side string, price double, amount double, cost double",
    )
    TB.append_liquidations(fetched, events, G.as_timestamp("2024-02-01 00:00:00"))
    L.run_liquidation_stream(folder, jobs, events, log, checkpoint, until_idle=True)
    first = L.read_landed(spark, folder, scratch_path(spark, "other"), flush_seconds=0)
    replay = L.start_liquidation_stream(first, jobs, events, log, checkpoint + "-lost", drain=True)
    replay.awaitTermination()  # another stream: its events are new
    assert TB.read_table(spark, events).count() == 21
    batch = TB.read_table(spark, events).limit(3)
    names = [r["batch"] for r in LG.Ledger(spark, events).commits().where("batch is not null").collect()]
    assert TB.append_liquidations(batch, events, F.current_timestamp(), names[0]) == 0  # a flush run again
    stored = TB.read_table(spark, events)
    days = TB.read_days(spark, events)
    got = D.aggregate_liquidations(stored, typed, intervals=["1h"], days=days).collect()
    assert [(r.event_count, r.short_value, r.long_value) for r in got] == [(21, 7.0, 2 * 2.5 * 55)]


def test_backlog_is_flushed_by_few_jobs_with_a_commit_for_each_flush(spark, jobs, monkeypatch):
    monkeypatch.setattr(LG, "FOLD", 4)
    folder = scratch_path(spark, "landed")
    known = [message(i) for i in range(40)] + [message(i, "Z") for i in range(40, 80)] + [message(i) for i in range(80, 107)]
    land(spark, folder, *known[:33])  # the second to the fourth flush of ten have no job in part or at all
    land(spark, folder, *known[33:])
    events, log, checkpoint = paths(spark)
    batches, append = [], TB.append_flushed_liquidations
    monkeypatch.setattr(TB, "append_flushed_liquidations", lambda *a: batches.append(a[-1]) or append(*a))
    totals = L.run_liquidation_stream(folder, jobs, events, log, checkpoint, flush_events=10, until_idle=True).first()
    assert tuple(totals) == (2, 67, 67)
    assert [len(x) for x in batches] == [10, 1]
    assert flushes(spark, log) == [10] * 4 + [10, 10, 7]
    ledger = LG.Ledger(spark, events, TB.DAYS)
    assert ledger.log.newest() == 11 and ledger.folds.newest() == 2
    commits = {r["batch"]: r["attempt"] for r in ledger.commits().collect()}
    assert len(commits) == len(set(commits.values())) == 11
    rows = TB.read_table(spark, events)
    assert sorted(float(r.amount) for r in rows.collect()) == [i + 1.0 for i in [*range(40), *range(80, 107)]]
    assert "flush" not in rows.columns and TB.read_days(spark, events).agg(F.sum("row_count")).first()[0] == 67
    # flushes run again after a crash between two commits: those committed are passed over, the others stored
    again = rows.withColumn("flush", F.when(F.col("amount") <= 20, 0).otherwise(1000).cast("bigint"))
    names = {0: next(iter(commits)), 1000: "new", 2000: "empty"}
    append(again, events, F.current_timestamp(), names)
    append(again, events, F.current_timestamp(), names)
    assert TB.read_table(spark, events).count() == 67 + 47 and ledger.log.newest() == 13


def test_a_slice_reads_only_the_row_groups_it_needs(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"raw": [str(i) for i in range(50)]}), tmp_path / "a.parquet", row_group_size=7)
    options = {"path": str(tmp_path), "state": f"{scratch_path(spark, 'state')}/s.json", "flush_events": "4", "backlog": "3"}
    reader = landed.LandedReader(options, spark.createDataFrame([], "flush long, raw string, position long").schema)
    assert reader.latestOffset() == {"position": 12} and reader.latestOffset() == {"position": 24}
    parts = reader.partitions({"position": 12}, {"position": 24}) + reader.partitions({"position": 48}, {"position": 50})
    rows = [r for part in parts for batch in reader.read(part) for r in zip(*(c.to_pylist() for c in batch.columns))]
    assert rows == [(12 + (i - 12) // 4 * 4, str(i), i) for i in range(12, 24)] + [(48, "48", 48), (48, "49", 49)]


def test_reading_buckets_does_not_grow_with_flushes(spark, monkeypatch):
    monkeypatch.setattr(LG, "FOLD", 3)
    schema = "exchange string, symbol string, market_type string, liquidation_time timestamp, side string, price double, amount double, cost double"
    folder, sink, checkpoint = (scratch_path(spark, n) for n in ("landed", "buckets", "checkpoint"))

    def event(i):
        day = 1 + (7 if i == 10 else i // 4)  # the eleventh lies on a late day, the twelfth on an early one
        at = dt.datetime(2024, 1, 1 if i == 11 else day) + dt.timedelta(minutes=i)
        return ("x", "A", "perpetual", at, "sell", None, None, float(1 << i))

    for i in range(14):
        spark.createDataFrame([event(i)], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)
    L.start_bucket_stream(stream, sink, checkpoint, "1h", drain=True).awaitTermination()
    got = L.latest_buckets(spark, sink)
    want = D.liquidation_buckets(spark.read.schema(schema).parquet(folder), ["1h"])
    key = lambda r: (r["bucket_time"], float(r["total_value"]), r["event_count"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    files = got.inputFiles()
    assert sum("/parts/" in f for f in files) <= 3 * 2  # parts of the commits since the last fold alone
    ledger = LG.Ledger(spark, sink, L.BUCKETS)
    assert ledger.log.newest() == 14 and ledger.folds.newest() == 4 and ledger.commits().count() == 14


def test_commits_of_a_backlog_lie_in_few_files(spark, jobs):
    folder = scratch_path(spark, "landed")
    land(spark, folder, *[message(i) for i in range(60)])
    events, log, checkpoint = paths(spark)
    L.run_liquidation_stream(folder, jobs, events, log, checkpoint, flush_events=1, until_idle=True)
    assert flushes(spark, log) == [1] * 60
    for path in (events, log):
        ledger = LG.Ledger(spark, path)
        assert ledger.log.newest() == 60 and ledger.commits().select("number").distinct().count() == 60
        listed = [ledger.log._names(f"{path}/{x}") for x in ("data", "log/000000000")]
        assert [len(x) for x in listed] == [1, 1]
    commits = [(r.number, r.attempt.split(":")[1]) for r in LG.Ledger(spark, events).commits().orderBy("number").collect()]
    assert commits == [(i + 1, str(i)) for i in range(60)]


def test_entries_of_one_file_and_a_writer_in_between(spark, monkeypatch):
    monkeypatch.setattr(LG, "SHELF", 3)
    path = scratch_path(spark, "store")
    ledger = LG.Ledger(spark, path)
    assert ledger.commit_together("a", {5: "x", 3: "w"}, 0) == 2
    assert ledger.commit("b", "y") and ledger.log.newest() == 3
    assert ledger.commit_together("c", {i: f"z{i}" for i in range(5)}, 2) == 8  # the number is taken, the batches are new
    assert ledger.commit_together("d", {7: "new", 9: "z3"}, 2) is None  # one of them has been stored since
    assert ledger.commit("e", "last") and ledger.log.newest() == 9
    for after in range(9):
        assert sorted(r.number for r in ledger.log.after(after, 7).collect()) == list(range(after + 1, 8))
    got = [(r.number, r.batch, r.attempt) for r in ledger.commits().where("number <= 4").orderBy("number").collect()]
    assert got == [(1, "w", "a:3"), (2, "x", "a:5"), (3, "y", "b"), (4, "z0", "c:0")]
