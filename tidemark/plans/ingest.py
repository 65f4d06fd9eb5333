"""Runs over all active jobs: plan, resolve, clip, normalise, check, store and log in one pass per payload family.

Landed payloads carry the stream key, `fetch_seq` and `payload`. Each step that is read more than once is settled;
tables are written in the order registry, rows, issues, run log. A run that died half-way is run again under a new run_id:
candles and series are inserted only if absent, and the issues and log rows of each attempt keep their own run_id.

A run first prepares every family (plans, resolved symbols, decoded rows), from which it is known which jobs fail and why, and
then stores. So a run that stops at the first failure, jobs being taken in name order, stores nothing of the jobs after it.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark import schemas as S
from tidemark.operators import markets as M
from tidemark.operators import normalize as N
from tidemark.operators import quality as Q
from tidemark.plans import requests as P
from tidemark.sources import tables as TB
from tidemark.sources.staging import path_exists, settle

HISTORY_TABLE = {
    "open_interest": "open_interest_history",
    "funding_rate": "funding_rate_history",
    "long_short_ratio": "long_short_ratio_history",
    "taker_buy_sell_volume": "taker_buy_sell_volume_history",
    "liquidation": "liquidation_event",
}


class Lake:
    """The stored tables under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, table: str) -> DataFrame:
        """A stored table, empty before its first write."""
        schema = S.schema_of(table)
        if not path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        return TB.read_table(self.spark, self.path(table), schema)

    def days(self, table: str) -> DataFrame:
        """The summary by stream and day that the appends to a table have kept."""
        return TB.read_days(self.spark, self.path(table))


class Prepared(NamedTuple):
    """A family's jobs with their plan, market (`fetch_symbol`, base and quote) and state before anything is stored, and the
    decoded rows of those that run."""

    plan: DataFrame
    rows: DataFrame


def _resolved(plan: DataFrame, catalogue: DataFrame | None) -> DataFrame:
    """Plans whose running jobs have a market; those without one fail. Without a catalogue symbols are taken as they are."""
    if catalogue is None:
        none = F.lit(None).cast("string")
        return plan.select("*", F.col("symbol").alias("fetch_symbol"), none.alias("base_asset"), none.alias("quote_asset"))
    asked = plan.where(F.col("status") == "running").select(*C.MARKET_KEY).distinct()
    found = M.resolve_symbol(catalogue, asked).withColumnRenamed("error_message", "unresolved")
    unresolved = (F.col("status") == "running") & F.col("unresolved").isNotNull()
    return (
        plan.join(found, C.MARKET_KEY, "left")
        .withColumn("error_message", F.when(unresolved, F.col("unresolved")).otherwise(F.col("error_message")))
        .withColumn("status", F.when(unresolved, F.lit("failed")).otherwise(F.col("status")))
        .drop("unresolved")
    )


def _of_running(landed: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    running = plan.where(F.col("status") == "running")
    return landed.join(running.select(*C.STREAM_KEY), C.STREAM_KEY, "left_semi"), running


def _of_failed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("malformed")).select(*C.STREAM_KEY).distinct()


def _until(rows: DataFrame, last_job: str | None) -> DataFrame:
    """Jobs up to the one at which a run stops."""
    return rows if last_job is None else rows.where(F.col("job_name") <= last_job)


def prepare_candles(lake: Lake, jobs: DataFrame, landed: DataFrame, now: Column, catalogue: DataFrame | None = None) -> Prepared:
    """Plans, resolves and decodes the candles of every job."""
    marks = P.bar_high_water(jobs, lake.days("market_data_raw"))
    plan = settle(_resolved(P.plan_skip(P.plan_bar_requests(marks, now)), catalogue), "bar_plan")
    wanted, running = _of_running(landed, plan)
    return Prepared(plan, settle(N.clip_pages(N.decode_ohlcv(wanted), running, "open_time"), "decoded_bars"))


def store_candles(lake: Lake, ready: Prepared, now: Column, run_id: Column, last_job: str | None = None) -> DataFrame:
    """Lists the markets, stores candles and issues, and returns one result row per job. A job with malformed rows stores no
    candles, but its market is listed."""
    plan = _until(ready.plan, last_job)
    running = plan.where(F.col("status") == "running")
    decoded = ready.rows.join(running.select(*C.STREAM_KEY), C.STREAM_KEY, "left_semi")
    listed = running.where(F.col("base_asset").isNotNull()).select(*C.MARKET_KEY, "base_asset", "quote_asset", F.lit(0).alias("seq"))
    if not listed.isEmpty():
        TB.upsert_registry(listed.distinct(), lake.path("asset_registry"), now, ["seq"])
    good = decoded.join(_of_failed(decoded), C.STREAM_KEY, "left_anti")
    batch = settle(N.collapse_bars(good), "batch_bars")
    checked = running.join(_of_failed(decoded), C.STREAM_KEY, "left_anti")
    issues = settle(Q.quality_issues(batch, checked), "issues")
    bars = N.bars_of(batch).drop("copies").withColumn("run_id", run_id)
    seen = TB.last_commit(lake.spark, lake.path("market_data_raw"))
    fresh = settle(TB.absent_rows(bars, lake.path("market_data_raw"), "market_data_raw", now), "fresh_bars")
    TB.append_rows(fresh, lake.path("market_data_raw"), "market_data_raw", seen)
    TB.append_quality_issues(issues, lake.path("data_quality_issue"), now, run_id)
    return P.batch_run_report(plan, decoded, fresh, issues)


def run_candles(
    lake: Lake, jobs: DataFrame, landed: DataFrame, now: Column, run_id: Column, catalogue: DataFrame | None = None
) -> DataFrame:
    """A run of the candle jobs alone; returns one result row per job."""
    return store_candles(lake, prepare_candles(lake, jobs, landed, now, catalogue), now, run_id)


def _normalised(dataset: str, landed: DataFrame) -> DataFrame:
    if dataset == "open_interest":
        amounts_only = F.col("exchange") == "kucoinfutures"
        return N.normalize_open_interest(landed.where(~amounts_only)).unionByName(
            N.normalize_open_interest_amount_only(landed.where(amounts_only))
        )
    return {
        "funding_rate": N.normalize_funding,
        "long_short_ratio": N.normalize_long_short,
        "taker_buy_sell_volume": N.normalize_taker,
        "liquidation": N.normalize_liquidations,
    }[dataset](landed)


def prepare_series(
    lake: Lake,
    dataset: str,
    jobs: DataFrame,
    landed: DataFrame,
    now: Column,
    capabilities: DataFrame | None = None,
    catalogue: DataFrame | None = None,
) -> Prepared:
    """Plans, gates, resolves and decodes one derived dataset of every job."""
    table = HISTORY_TABLE[dataset]
    own = jobs.where(F.col("source_dataset") == dataset)
    of_family = P.event_high_water if dataset in ("funding_rate", "liquidation") else P.history_high_water
    gated = P.capability_gate(P.plan_series_requests(of_family(own, lake.days(table)), now), capabilities)
    status = F.when(F.col("error_message").isNotNull(), "failed").when(F.col("gate") != "run", F.col("gate"))
    planned = gated.withColumn("status", F.coalesce(status, F.lit("running"))).withColumn(
        "error_message", F.coalesce("error_message", "gate_message")
    )
    plan = settle(_resolved(planned, catalogue), "series_plan")
    wanted = _of_running(landed.where(F.col("source_dataset") == dataset), plan.where(~F.col("empty_range")))[0]
    return Prepared(plan, wanted)


def store_series(
    lake: Lake, dataset: str, ready: Prepared, now: Column, run_id: Column, last_job: str | None = None
) -> DataFrame:
    """Stores one derived dataset and returns one result row per job."""
    table = HISTORY_TABLE[dataset]
    time = S.TIME_COLUMN[table]
    plan = _until(ready.plan, last_job)
    wanted, running = _of_running(ready.rows, plan)
    rows = N.clip_pages(_normalised(dataset, wanted), running, time).withColumn("run_id", run_id)
    batch = settle(rows, "batch_series")
    if dataset == "liquidation":
        fresh = batch
        TB.append_liquidations(batch, lake.path(table), now)
    else:
        seen = TB.last_commit(lake.spark, lake.path(table))
        fresh = settle(TB.absent_rows(batch, lake.path(table), table, now), "fresh_series")
        TB.append_rows(fresh, lake.path(table), table, seen)
    # prints and liquidations count every fetched row, the clipped series only rows in range
    counted = wanted if dataset in ("funding_rate", "liquidation") else batch
    keys = C.MARKET_KEY + (["bar_interval"] if "bar_interval" in fresh.columns else [])
    fetched = counted.groupBy(*C.STREAM_KEY).agg(F.count(F.lit(1)).alias("n_fetched"))
    inserted = fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_inserted"))
    none = F.lit(0).cast("bigint")
    return (
        plan.join(fetched, C.STREAM_KEY, "left")
        .join(inserted, keys, "left")
        .select(
            "job_name",
            *C.STREAM_KEY,
            F.when(F.col("status") == "running", F.lit("success")).otherwise(F.col("status")).alias("status"),
            "request_start",
            "request_end",
            F.coalesce("n_fetched", none).alias("rows_fetched"),
            F.coalesce("n_inserted", none).alias("rows_inserted"),
            none.alias("rows_updated"),
            none.alias("issue_count"),
            "error_message",
        )
    )


def run_series(
    lake: Lake,
    dataset: str,
    jobs: DataFrame,
    landed: DataFrame,
    now: Column,
    run_id: Column,
    capabilities: DataFrame | None = None,
    catalogue: DataFrame | None = None,
) -> DataFrame:
    """A run of the jobs of one derived dataset; returns one result row per job."""
    return store_series(lake, dataset, prepare_series(lake, dataset, jobs, landed, now, capabilities, catalogue), now, run_id)


def run_unknown(jobs: DataFrame) -> DataFrame:
    """Failed result rows of jobs whose dataset has no payload family."""
    unknown = N.split_by_family(jobs)[1]
    none = F.lit(0).cast("bigint")
    return unknown.select(
        "job_name",
        *C.STREAM_KEY,
        F.lit("failed").alias("status"),
        F.lit(None).cast("timestamp").alias("request_start"),
        F.lit(None).cast("timestamp").alias("request_end"),
        none.alias("rows_fetched"),
        none.alias("rows_inserted"),
        none.alias("rows_updated"),
        none.alias("issue_count"),
        F.concat(F.lit("Unsupported source_dataset='"), "source_dataset", F.lit("'.")).alias("error_message"),
    )


def first_failure(candles: Prepared, series: list[Prepared], unknown: DataFrame) -> str | None:
    """The first job in name order that fails: no range, no market, not supported, or malformed candles."""
    failed = [x.plan.where(F.col("status") == "failed").select("job_name") for x in (candles, *series)]
    broken = candles.plan.join(_of_failed(candles.rows), C.STREAM_KEY, "left_semi").select("job_name")
    names = reduce(DataFrame.unionByName, [*failed, broken, unknown.select("job_name")])
    return names.agg(F.min("job_name")).first()[0]


def run_active_jobs(
    lake: Lake,
    jobs: DataFrame,
    landed: DataFrame,
    now: Column,
    run_id: Column,
    capabilities: DataFrame | None = None,
    catalogue: DataFrame | None = None,
    stop_at_failure: bool = False,
) -> DataFrame:
    """Runs every active job over the landed payloads, logs one row per job, and returns the result rows.

    With a market catalogue each job's symbol is resolved first, jobs without a market fail, and the markets of candle jobs
    are listed in the registry. With `stop_at_failure` jobs are taken in name order up to the first that fails; the others
    leave no trace. Else a failing job does not hold up others.
    """
    active = settle(jobs.where(F.col("is_active")), "active_jobs")
    candles = prepare_candles(lake, active, landed, now, catalogue)
    series = {name: prepare_series(lake, name, active, landed, now, capabilities, catalogue) for name in HISTORY_TABLE}
    unknown = run_unknown(active)
    last = first_failure(candles, list(series.values()), unknown) if stop_at_failure else None
    results = [store_candles(lake, candles, now, run_id, last), _until(unknown, last)]
    results += [store_series(lake, name, ready, now, run_id, last) for name, ready in series.items()]
    report = settle(reduce(DataFrame.unionByName, results), "run_report")
    TB.append_run_log(report.withColumn("run_id", run_id), lake.path("ingestion_run_log"), now, now)
    return report
