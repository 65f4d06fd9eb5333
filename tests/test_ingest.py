"""A whole run over landed payloads, and the run after it."""

from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import timegrid as G
from tidemark.plans import ingest as I
from tidemark.plans import requests as P
from tidemark.session import scratch_path


def _landed(t):
    from tidemark.catalog import queries as q

    ratio = q._payload(
        q._events_with_time(t), "long_short_ratio", F.col("event_id"), timestamp=F.col("at"), longShortRatio=F.col("k") + 1
    )
    prints = t.funding_rate_history
    funding = q._payload(
        prints, "funding_rate", F.lit(0).cast("bigint"), timestamp=F.unix_millis("funding_time"), fundingRate=F.col("funding_rate")
    )
    events = t.liquidation_event
    forced = q._payload(
        events, "liquidation", F.col("event_id"), timestamp=F.unix_millis("liquidation_time"), side=F.col("side"),
        price=F.col("price"), amount=F.col("amount"), cost=F.col("cost"),
    ).withColumn("bar_interval", F.lit("event"))
    parts = [t.landed_ohlcv, q._landed_open_interest(t), ratio, funding, forced]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _by_status(report):
    return {(r["source_dataset"], r["status"]): r["n"] for r in report.groupBy("source_dataset", "status").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_run_and_rerun(spark, tables):
    from tidemark.sources.staging import settle

    lake = I.Lake(spark, scratch_path(spark, "lake"))
    stream = tables.jobs.where("is_active AND source_dataset = 'kline' AND bar_interval = '1h'").orderBy("job_name").limit(1)
    damaged = stream.select(*C.STREAM_KEY, F.lit(99).cast("bigint").alias("fetch_seq"), F.lit("[null,1,1,1,1,1]").alias("payload"))
    landed = settle(_landed(tables).unionByName(damaged), "landed")
    now = G.as_timestamp("2024-01-31 00:00:00")
    first = I.run_active_jobs(lake, tables.jobs, landed, now, F.lit("run-1"))
    jobs = tables.jobs.where("is_active").count()
    assert first.count() == jobs
    bars = lake.table("market_data_raw")
    assert first.where(F.col("source_dataset").isin(C.OHLCV_DATASETS)).agg(F.sum("rows_inserted")).first()[0] == bars.count()
    assert bars.groupBy(*C.STREAM_KEY, "open_time").count().where("count > 1").count() == 0
    assert lake.table("ingestion_run_log").count() == jobs
    assert lake.table("data_quality_issue").count() == first.agg(F.sum("issue_count")).first()[0]
    status = _by_status(first)
    assert status[("trades", "failed")] > 0 and ("trades", "success") not in status
    skipped = first.where("source_dataset = 'liquidation' AND exchange = 'binance'")
    assert {r["status"] for r in skipped.collect()} == {"skipped"}
    # a stream with a malformed candle stores nothing
    broken = first.where("error_message = 'malformed rows in the payload'")
    assert broken.count() >= 1 and broken.agg(F.sum("rows_inserted")).first()[0] == 0
    assert bars.join(broken.select(*C.STREAM_KEY), C.STREAM_KEY, "left_semi").count() == 0

    second = I.run_active_jobs(lake, tables.jobs, landed, now, F.lit("run-2"))
    again = second.where(F.col("source_dataset") != "liquidation").agg(F.sum("rows_inserted")).first()[0]
    assert again == 0
    assert lake.table("market_data_raw").count() == bars.count()
    assert lake.table("ingestion_run_log").count() == 2 * jobs
    marks = P.bar_high_water(tables.jobs.where("is_active"), lake.table("market_data_raw"))
    assert marks.where("row_count IS NOT NULL").count() > 0


def test_run_log_holds_runs_that_store_all_part_and_nothing(tables):
    from tidemark.catalog import queries as q

    inserted = {}
    for r in q.REGISTRY["run_log"](tables).where("status IN ('success', 'partial_success')").collect():
        inserted.setdefault(r["job_name"], []).append(r["rows_inserted"])
    runs = [sorted(x) for x in inserted.values()]
    assert runs and all(len(x) == 3 and x[0] == 0 for x in runs)
    assert sum(x[1] for x in runs) < sum(x[2] for x in runs) and any(x[1] for x in runs)


def test_landed_payloads_lie_by_dataset_in_files_of_bounded_rows(spark, tables, monkeypatch):
    from tidemark.catalog import queries as q
    from tidemark.sources import staging

    monkeypatch.setattr(staging, "FILE_ROWS", 100)
    held = staging.settle(spark.range(0, 1000, 1, 1).selectExpr("id", "if(id < 900, 'a', 'b') kind"), "payloads", ("kind",))
    sizes = [r["n"] for r in held.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 100 and held.columns == ["id", "kind"]
    report = q._complete_run(tables)[1]
    assert report.count() == tables.jobs.where("is_active").count()
    landed = tables.settled("landed_everything", lambda: None)
    assert all("source_dataset=" in f for f in landed.inputFiles())
