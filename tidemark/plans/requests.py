"""What to fetch next, for every job in one pass: high-water marks, ranges, gates, due streams, run report.

Every function takes `now` as a column or literal, never the clock, so a plan can be rebuilt and checked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import timegrid as G
from tidemark.sources import summary as SU

MARKS = ["first_open_time", "last_open_time", "last_close_time", "row_count", "last_ingested_at"]


# --- high-water marks ------------------------------------------------------------


def _marks(days: DataFrame, keys: list[str]) -> DataFrame:
    merged = {c: SU.MERGED[c](c) for c in ("first_time", "last_time", "last_close", "row_count", "last_ingested_at")}
    return days.groupBy(*keys).agg(*[cell.alias(mark) for mark, cell in zip(MARKS, merged.values())])


def _on_jobs(jobs: DataFrame, marks: DataFrame, keys: list[str]) -> DataFrame:
    return jobs.join(marks, keys, "left")


def bar_high_water(jobs: DataFrame, bars: DataFrame) -> DataFrame:
    """First and last bar, count and last ingest per candle job; NULL when nothing is stored.

    `bars` is the table's summary (see sources/summary.py), or the table itself, which is then read whole.
    """
    days = bars if SU.is_summary(bars) else SU.summarise(bars, "open_time", close="close_time")
    of_candles = F.col("source_dataset").isin(C.OHLCV_DATASETS)
    return _on_jobs(jobs.where(of_candles), _marks(days.where(of_candles), C.STREAM_KEY), C.STREAM_KEY)


HISTORIES = ["open_interest", "long_short_ratio", "taker_buy_sell_volume"]


def history_high_water(jobs: DataFrame, tables: DataFrame | dict[str, DataFrame]) -> DataFrame:
    """The same marks for open interest, account ratios and taker volumes, in one aggregation.

    `tables` is their summary, or maps the dataset name to its history table. The last close equals the last open.
    """
    names, days = HISTORIES, tables
    if isinstance(tables, dict):
        names = [n for n in HISTORIES if n in tables]
        days = reduce(DataFrame.unionByName, [SU.summarise(tables[n], "open_time", n) for n in names])
    own = F.col("source_dataset").isin(names)
    return _on_jobs(jobs.where(own), _marks(days.where(own), C.STREAM_KEY), C.STREAM_KEY)


def event_high_water(jobs: DataFrame, tables: DataFrame | dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The same marks for event tables, which have no interval. `tables` is their summary, or maps dataset to (table, time
    column)."""
    keys, names, days = C.MARKET_KEY + ["source_dataset"], ["funding_rate", "liquidation"], tables
    if isinstance(tables, dict):
        names = list(tables)
        days = reduce(DataFrame.unionByName, [SU.summarise(table, time, n) for n, (table, time) in tables.items()])
    own = F.col("source_dataset").isin(names)
    return _on_jobs(jobs.where(own), _marks(days.where(own), keys), keys)


# --- request ranges ----------------------------------------------------------------


def plan_bar_requests(marked_jobs: DataFrame, now: Column) -> DataFrame:
    """Range, target and quality anchor of each candle job, from its high-water mark.

    A backfill without a start time, or an interval that does not parse, is planned as `failed`.
    """
    step = G.interval_seconds_or_null(F.col("bar_interval"))
    closed = G.floor_closed_bar(now, step)
    backfill = F.col("fetch_mode") == "backfill"
    backfill_target = F.coalesce(G.shift_seconds(F.col("first_open_time"), -step), F.col("end_time"), closed)
    target = F.least(F.when(backfill, backfill_target).otherwise(closed), F.col("end_time"))
    start = F.when(backfill, F.col("start_time")).otherwise(
        F.coalesce(G.shift_seconds(F.col("last_open_time"), step), F.col("start_time"))
    )
    error = F.when(step.isNull(), F.concat(F.lit("Unknown interval "), F.col("bar_interval"))).when(
        backfill & F.col("start_time").isNull(),
        F.concat(F.lit("No start time to fill back to: "), F.col("job_name")),
    )
    return (
        marked_jobs.withColumn("interval_seconds", step)
        .withColumn("error_message", error)
        .withColumn("request_start", F.when(error.isNull(), start))
        .withColumn("target_last_open_time", F.when(error.isNull(), target))
        .withColumn("anchor_open_time", F.when(~backfill, F.col("last_open_time")))
        .withColumn("since_ms", F.unix_millis("request_start"))
        .withColumn("until_ms", F.unix_millis("target_last_open_time"))
        .withColumn("clip_lower", F.lit(False))
        .withColumn("clip_upper", F.lit(True))
    )


def plan_skip(plan: DataFrame) -> DataFrame:
    """Marks jobs whose range is empty (start strictly after target) as skipped; their range ends where it starts."""
    skipped = F.coalesce(F.col("request_start") > F.col("target_last_open_time"), F.lit(False))
    status = F.when(F.col("error_message").isNotNull(), "failed").when(skipped, "skipped").otherwise("running")
    end = F.when(skipped, F.col("request_start")).otherwise(F.col("target_last_open_time"))
    return plan.withColumn("status", status).withColumn("request_end", end)


def plan_series_requests(marked_jobs: DataFrame, now: Column) -> DataFrame:
    """Range of each non-candle job. The end is not floored; the start is the last stored time itself.

    All datasets but open interest then ask from one millisecond later.
    """
    backfill = F.col("fetch_mode") == "backfill"
    start = F.when(backfill, F.col("start_time")).otherwise(F.coalesce("last_open_time", "start_time"))
    error = F.when(
        backfill & F.col("start_time").isNull(),
        F.concat(F.lit("No start time to fill back to: "), F.col("job_name")),
    )
    planned = (
        marked_jobs.withColumn("error_message", error)
        .withColumn("request_start", F.when(error.isNull(), start))
        .withColumn("request_end", F.coalesce(F.col("end_time"), now))
    )
    return retention_clamp(planned)


def retention_clamp(plan: DataFrame) -> DataFrame:
    """Moves the start into the window the exchange keeps, and derives the millisecond bounds.

    `request_start` is what the run log shows. KuCoin's window applies to the fetch only (`effective_start`), and
    a start after the end makes the fetch empty.
    """
    dataset, exchange = F.col("source_dataset"), F.col("exchange")
    derived = ["open_interest", "long_short_ratio", "taker_buy_sell_volume"]
    binance = (exchange == "binance") & dataset.isin(derived) & F.col("request_start").isNotNull()
    kucoin = (exchange == "kucoinfutures") & (dataset == "open_interest")

    def kept_since(days: int) -> Column:
        return G.shift_seconds(F.col("request_end"), F.lit(-days * 86400).cast("bigint"))

    kucoin_start = F.when(F.col("bar_interval") == "1d", kept_since(C.KUCOIN_DAILY_RETENTION_DAYS)).otherwise(
        kept_since(C.KUCOIN_RETENTION_DAYS)
    )
    later_by = F.when(dataset == "open_interest", F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    lower_bounded = kucoin | dataset.isin("long_short_ratio", "taker_buy_sell_volume")
    return (
        plan.withColumn(
            "request_start",
            F.when(binance, F.greatest("request_start", kept_since(C.BINANCE_RETENTION_DAYS))).otherwise(
                F.col("request_start")
            ),
        )
        .withColumn(
            "effective_start",
            F.when(kucoin, F.greatest("request_start", kucoin_start)).otherwise(F.col("request_start")),
        )
        .withColumn("empty_range", F.coalesce(kucoin & (F.col("effective_start") > F.col("request_end")), F.lit(False)))
        .withColumn("since_ms", F.unix_millis("effective_start") + later_by)
        .withColumn("until_ms", F.unix_millis("request_end"))
        .withColumn("clip_lower", lower_bounded)
        .withColumn("clip_upper", dataset.isin(derived))
    )


# --- gates -----------------------------------------------------------------------------


def capability_gate(jobs: DataFrame, capabilities: DataFrame | None = None) -> DataFrame:
    """Adds `gate` (run, skipped, failed) and `gate_message` per job.

    `capabilities` lists (exchange, method) pairs an exchange adapter offers; without it all are assumed.
    """
    dataset, exchange, interval = F.col("source_dataset"), F.col("exchange"), F.col("bar_interval")
    ratio = dataset.isin("long_short_ratio", "taker_buy_sell_volume")
    kucoin_oi = (exchange == "kucoinfutures") & (dataset == "open_interest")
    method = (
        F.when((dataset == "open_interest") & ~kucoin_oi, "fetchOpenInterestHistory")
        .when(dataset == "funding_rate", "fetchFundingRateHistory")
        .when(dataset == "liquidation", "fetchLiquidations")
    )
    wanted = jobs.withColumn("method", method)
    if capabilities is None:
        wanted = wanted.withColumn("offered", F.lit(True))
    else:
        offered = capabilities.select("exchange", "method").distinct().withColumn("offered", F.lit(True))
        wanted = wanted.join(offered, ["exchange", "method"], "left")
    lacks = F.col("method").isNotNull() & F.col("offered").isNull()

    def message(template: str) -> Column:
        filled = F.replace(F.lit(template), F.lit("{dataset}"), dataset)
        filled = F.replace(filled, F.lit("{interval}"), interval)
        return F.replace(filled, F.lit("{method}"), F.coalesce("method", F.lit("")))

    failed = F.when(kucoin_oi & ~interval.isin(C.KUCOIN_OPEN_INTEREST_INTERVALS), message(C.MESSAGE_KUCOIN_INTERVAL))
    skipped = (
        F.when(ratio & (exchange != "binance"), message(C.MESSAGE_RATIO_EXCHANGE))
        .when(ratio & ~interval.isin(C.RATIO_INTERVALS), message(C.MESSAGE_RATIO_INTERVAL))
        .when((dataset == "liquidation") & (exchange == "binance"), F.lit(C.MESSAGE_BINANCE_LIQUIDATION))
        .when((dataset == "liquidation") & lacks, F.lit(C.MESSAGE_NO_LIQUIDATIONS))
        .when(lacks, message(C.MESSAGE_NO_METHOD))
    )
    unknown = F.when(
        ~dataset.isin(C.ALL_DATASETS), F.concat(F.lit("Unsupported source_dataset='"), dataset, F.lit("'."))
    )
    return (
        wanted.withColumn("gate_message", F.coalesce(unknown, failed, skipped))
        .withColumn(
            "gate",
            F.when(F.coalesce(unknown, failed).isNotNull(), "failed").when(skipped.isNotNull(), "skipped").otherwise("run"),
        )
        .drop("method", "offered")
    )


def due_streams(marked_jobs: DataFrame, now: Column) -> DataFrame:
    """Jobs whose last ingest is at least one cadence ago, or that never ingested."""
    cadence = G.cadence_seconds(F.col("source_dataset"), F.col("bar_interval"))
    age = F.unix_seconds(now) - F.unix_seconds("last_ingested_at")
    return (
        marked_jobs.withColumn("cadence_seconds", cadence)
        .withColumn("age_seconds", age)
        .where(age.isNull() | (age >= cadence))
    )


# --- run report -------------------------------------------------------------------------


def batch_run_report(plan: DataFrame, decoded: DataFrame, inserted: DataFrame, issues: DataFrame) -> DataFrame:
    """One result row per planned job. A job with malformed rows fails on its own; the others go on.

    decoded (with its `malformed` flag), inserted and issues are row-level tables with the stream key; each is
    pre-aggregated to one row per stream before the join.
    """

    def per_stream(rows: DataFrame, *aggregates: Column) -> DataFrame:
        return rows.groupBy(*C.STREAM_KEY).agg(*aggregates)

    def counted(name: str) -> Column:
        return F.count(F.lit(1)).alias(name)

    rejected = F.count_if("malformed").alias("n_rejected")
    severe = F.max(F.col("severity").isin("error", "critical")).alias("severe")
    joined = (
        plan.join(per_stream(decoded, counted("n_fetched"), rejected), C.STREAM_KEY, "left")
        .join(per_stream(inserted, counted("n_inserted")), C.STREAM_KEY, "left")
        .join(per_stream(issues, counted("n_issues"), severe), C.STREAM_KEY, "left")
    )
    status = (
        F.when(F.col("status") != "running", F.col("status"))
        .when(F.coalesce("n_rejected", F.lit(0)) > 0, "failed")
        .when(F.coalesce("severe", F.lit(False)), "partial_success")
        .otherwise("success")
    )
    ran = F.col("run_status").isin("success", "partial_success")

    def only_if_ran(name: str) -> Column:
        return F.when(ran, F.coalesce(F.col(name), F.lit(0))).otherwise(F.lit(0)).cast("bigint")

    return joined.withColumn("run_status", status).select(
        "job_name",
        *C.STREAM_KEY,
        F.col("run_status").alias("status"),
        "request_start",
        "request_end",
        only_if_ran("n_fetched").alias("rows_fetched"),
        only_if_ran("n_inserted").alias("rows_inserted"),
        F.lit(0).cast("bigint").alias("rows_updated"),
        only_if_ran("n_issues").alias("issue_count"),
        F.coalesce("error_message", F.when(F.col("n_rejected") > 0, F.lit("malformed rows in the payload"))).alias(
            "error_message"
        ),
    )


def until_first_failure(report: DataFrame) -> DataFrame:
    """The rows a stop-at-first-error run would have produced: jobs in name order up to the first failure."""
    stop_at = report.where(F.col("status") == "failed").agg(F.min("job_name").alias("stop_at")).scalar()
    return report.where(stop_at.isNull() | (F.col("job_name") <= stop_at))
