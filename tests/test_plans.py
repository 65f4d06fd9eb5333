"""Physical plans: pruned scans, early top-N, no all-pairs joins, nothing funnelled through one task."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import queries as registry

QUERIES = registry.registered()
# a total over everything ends in one row, after partial sums in every task
GLOBAL_TOTALS = {"stream_totals"}
# queries whose building starts streams or table writes are covered by their own tests
EAGER = {n for n in QUERIES if n.startswith(("append_", "upsert_"))} | {
    "run_log", "ingest_run", "liquidation_stream", "flush_summary", "stream_bounds", "stream_totals", "streaming_liquidation_buckets",
    "liquidation_flushes", "live_dashboard", "run_active_jobs", "run_registry", "run_until_failure",
}


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_all_pairs_and_no_single_task(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    if name not in GLOBAL_TOTALS:
        assert "SinglePartition" not in plan


def test_volume_scan_is_pruned_and_top_n_starts_before_the_shuffle(spark, tables):
    from tidemark.operators import dashboard as D

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(D.aggregate_volume(tables.market_data_raw, tables.asset_registry, "BTC", "1h"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "close" in line)
    filters = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "kline" in filters and "1h" in filters
    assert "open#" not in scan and "high#" not in scan and "close_time" not in scan
    assert "BroadcastHashJoin" in plan
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # final above partial
    assert "Partial" in plan


def test_examples_are_trimmed_before_the_shuffle(tables):
    from tidemark.operators import quality as Q

    plan = plan_of(Q.invalid_ohlc(tables.market_data_raw))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 20, Partial", plan)


def test_large_registry_is_not_broadcast(spark, tables):
    """Without a measured small size the registry joins by shuffle: no hint forces it into memory."""
    from tidemark.operators import dashboard as D

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = D.aggregate_volume(tables.market_data_raw, tables.asset_registry)
        assert "BroadcastExchange" not in plan_of(rows)
        shuffled = sorted(tuple(r) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    broadcast = sorted(tuple(r) for r in D.aggregate_volume(tables.market_data_raw, tables.asset_registry).collect())
    assert shuffled == broadcast


def test_gap_windows_hold_one_span(tables):
    from pyspark.sql import functions as F

    from tidemark.operators import quality as Q

    timed = tables.market_data_raw.withColumn("interval_seconds", F.lit(3600).cast("bigint"))
    empty = tables.jobs.limit(0).withColumn("anchor_open_time", F.lit(None).cast("timestamp"))
    plan = plan_of(Q.previous_open_times(timed, empty))
    windows = [line for line in plan.splitlines() if "Window [lag(open_time" in line]
    assert windows and all("span#" in line for line in windows)


def test_quality_reads_the_batch_once(tables):
    from tidemark.operators import quality as Q

    plan = plan_of(Q.checked_bars(tables.market_data_raw.withColumn("copies", F.lit(1)).withColumn("quote_volume", F.lit(None).cast("decimal(28,8)"))))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("span#" in line for line in windows)
