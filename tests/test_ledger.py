"""Commits, several writers, replays, folds, and the summary that appends keep."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import timegrid as G
from tidemark.session import scratch_path
from tidemark.sources import ledger as LG
from tidemark.sources import summary as SU
from tidemark.sources import tables as TB

BARS = (
    "exchange string, symbol string, market_type string, bar_interval string, source_dataset string, open_time timestamp, "
    "close_time timestamp, close double, fetch_seq bigint"
)


def now():
    return G.as_timestamp("2024-02-01 00:00:00")


def bars(spark, *rows):
    made = []
    for symbol, hour, close in rows:
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)
        made.append(("binance", symbol, "spot", "1h", "kline", at, at + dt.timedelta(hours=1), float(close), 0))
    return spark.createDataFrame(made, BARS)


def stored(spark, path):
    return sorted((r.symbol, r.open_time.day * 24 + r.open_time.hour - 24, float(r.close)) for r in TB.read_table(spark, path).collect())


def same_days(spark, path):
    """The kept summary equals one made from the rows."""
    fresh = SU.summarise(TB.read_table(spark, path), "open_time", close="close_time")
    kept = TB.read_days(spark, path)
    assert sorted(map(str, kept.select(*fresh.columns).collect())) == sorted(map(str, fresh.collect()))
    return kept


def test_a_file_is_created_once(spark):
    path = scratch_path(spark, "log")
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append(LG.create_if_absent(spark, f"{path}/x/1.json", str(i)))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [False] * 7 + [True]


def test_log_numbers_go_over_shelves(spark, monkeypatch):
    monkeypatch.setattr(LG, "SHELF", 2)
    log = LG.Log(spark, scratch_path(spark, "log"), LG.COMMIT)
    assert log.newest() == 0
    for n in range(1, 6):
        assert log.add(n, batch=f"b{n}", attempt="a") and not log.add(n, batch="other", attempt="a") and log.newest() == n
    assert sorted(r.batch for r in log.after(1, 4).collect()) == ["b2", "b3", "b4"]


@pytest.mark.parametrize("fold", [256, 2])
def test_summary_follows_appends_and_reads_stay_whole(spark, monkeypatch, fold):
    monkeypatch.setattr(LG, "FOLD", fold)
    path = scratch_path(spark, "bars")
    assert TB.append_bars(bars(spark, ("A", 0, 1), ("A", 1, 2), ("B", 30, 3)), path, now()) == 3
    assert TB.append_bars(bars(spark, ("A", 1, 9), ("A", 2, 4)), path, now()) == 1
    same_days(spark, path)
    assert TB.append_bars(bars(spark, ("A", 0, 9), ("B", 30, 9)), path, now()) == 0
    assert TB.append_bars(bars(spark, ("A", 25, 5), ("B", 31, 6), ("C", 700, 7)), path, now()) == 3
    assert TB.append_bars(bars(spark, ("A", 3, 8)), path, now()) == 1
    want = [("A", 0, 1.0), ("A", 1, 2.0), ("A", 2, 4.0), ("A", 3, 8.0), ("A", 25, 5.0), ("B", 30, 3.0), ("B", 31, 6.0), ("C", 700, 7.0)]
    assert stored(spark, path) == want
    kept = same_days(spark, path)
    assert {(r.symbol, r.day.day): r.row_count for r in kept.collect()} == {("A", 1): 4, ("A", 2): 1, ("B", 2): 2, ("C", 30): 1}


def test_a_batch_run_again_counts_once(spark):
    path = scratch_path(spark, "events")
    event = ("binance", "A", "perpetual", dt.datetime(2024, 1, 1, 5, 7), "sell", 2.0, 3.0, None)
    rows = spark.createDataFrame([event, event], "exchange string, symbol string, market_type string, liquidation_time timestamp, side string, price double, amount double, cost double")
    assert TB.append_liquidations(rows, path, now(), "flush-1") == 2
    assert TB.append_liquidations(rows, path, now(), "flush-1") == 0
    assert TB.append_liquidations(rows, path, now(), "flush-2") == 2
    assert TB.append_liquidations(rows, path, now()) == 2
    assert TB.read_table(spark, path).count() == 6
    days = TB.read_days(spark, path).collect()
    assert [(r.row_count, r.hour, r.minutes, r.source_dataset) for r in days] == [(6, 5, 1 << 7, "liquidation")]


def test_what_a_crash_left_is_not_read(spark):
    path = scratch_path(spark, "bars")
    TB.append_bars(bars(spark, ("A", 0, 1)), path, now())
    lost = bars(spark, ("A", 1, 2)).select(*TB._typed_columns(bars(spark, ("A", 1, 2)), "market_data_raw", now())).withColumn("day", F.to_date("open_time"))
    TB._write(lost, path, LG.new_attempt(), ["source_dataset", "bar_interval", "day"])
    LG.Ledger(spark, path, TB.DAYS).write_part("days", TB._summary("market_data_raw")(lost), LG.new_attempt())
    assert stored(spark, path) == [("A", 0, 1.0)]
    same_days(spark, path)
    assert TB.append_bars(bars(spark, ("A", 1, 5)), path, now()) == 1
    assert stored(spark, path) == [("A", 0, 1.0), ("A", 1, 5.0)]


def test_two_writers_of_the_same_keys_store_each_once(spark):
    path = scratch_path(spark, "bars")
    one, two = bars(spark, ("A", 0, 1), ("A", 1, 1)), bars(spark, ("A", 1, 2), ("A", 2, 2))
    seen = TB.last_commit(spark, path)
    fresh = [TB.settle(TB.absent_rows(x, path, "market_data_raw", now()), "fresh") for x in (one, two)]  # both before a commit
    assert TB.append_rows(fresh[0], path, "market_data_raw", seen) == 2
    assert TB.append_rows(fresh[1], path, "market_data_raw", seen) == 1
    assert stored(spark, path) == [("A", 0, 1.0), ("A", 1, 1.0), ("A", 2, 2.0)]
    same_days(spark, path)


def _together(*jobs):
    errors = []

    def guarded(job):
        try:
            job()
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=guarded, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors


def test_four_writers_at_once(spark):
    path, watched = scratch_path(spark, "bars"), scratch_path(spark, "watch")
    batches = [bars(spark, *[("A", h, w) for h in range(w, w + 4)]) for w in range(4)]
    _together(*[lambda b=b: TB.append_bars(b, path, now()) for b in batches])
    got = stored(spark, path)
    assert [h for _, h, _ in got] == list(range(7)) and all(0 <= h - w <= 3 for _, h, w in got)
    same_days(spark, path)
    _together(*[lambda n=n: TB.upsert_watchlist(TB.listed_assets(spark, [n, "btc"]), watched, now()) for n in ("eth", "sol", "xrp", "ada")])
    assert {r.base_asset for r in TB.read_snapshot(spark, watched, "watchlist_asset").collect()} == {"BTC", "ETH", "SOL", "XRP", "ADA"}


def test_marks_of_a_lake_come_from_its_summary(spark):
    from tidemark.plans import ingest as I
    from tidemark.plans import requests as P

    lake = I.Lake(spark, scratch_path(spark, "lake"))
    jobs = bars(spark, ("A", 0, 1), ("Z", 0, 1)).select(*C.STREAM_KEY, F.col("symbol").alias("job_name"))
    assert all(r.row_count is None for r in P.bar_high_water(jobs, lake.days("market_data_raw")).collect())
    TB.append_bars(bars(spark, ("A", 5, 1), ("A", 50, 2)), lake.path("market_data_raw"), now())
    marks = P.bar_high_water(jobs, lake.days("market_data_raw"))
    plan = marks._jdf.queryExecution().executedPlan().toString()
    assert "/data" not in plan
    got = {r.job_name: (r.row_count, r.last_open_time) for r in marks.collect()}
    assert got == {"A": (2, dt.datetime(2024, 1, 3, 2)), "Z": (None, None)}
