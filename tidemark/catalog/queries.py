"""The registered queries: one per operator, each over whole tables derived from a scale-factor folder.

Results are made portable for comparison in the last projection: times as epoch milliseconds, decimals as doubles,
integers as BIGINT, lists as comma-separated text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as C
from tidemark.functions import text as X
from tidemark.functions import timegrid as G
from tidemark.functions import values as V
from tidemark.operators import dashboard as D
from tidemark.operators import factors as FA
from tidemark.operators import markets as M
from tidemark.operators import nearest as NJ
from tidemark.operators import normalize as N
from tidemark.operators import quality as Q
from tidemark.operators import seeding as SE
from tidemark.plans import ingest as I
from tidemark.plans import requests as P
from tidemark.session import scratch_path
from tidemark.sources import tables as TB
from tidemark.sources.event_log import MarketTables
from tidemark.sources.staging import settle
from tidemark.streaming import liquidations as L

NOW = "2024-01-31 00:00:00"
INTERVALS = ["5m", "1h"]
SEED_ASSETS = ["BTC", "ETH", "MYX", "MOVR"]
REGISTRY: dict[str, Callable[[MarketTables], DataFrame]] = {}


def query(build: Callable[[MarketTables], DataFrame]) -> Callable[[MarketTables], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


def portable(rows: DataFrame) -> DataFrame:
    cells = []
    for field in rows.schema.fields:
        cell, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.TimestampType):
            cell = F.unix_millis(cell)
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            cell = cell.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            cell = cell.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            cell = F.array_join(cell, ",")
        cells.append(cell.alias(field.name))
    return rows.select(*cells)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Callable[[MarketTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: portable(build(MarketTables(spark, sf_dir)))

    return {name: runner(build) for name, build in REGISTRY.items()}


def now():
    return G.as_timestamp(NOW)


# --- scans and sinks ------------------------------------------------------------------


@query
def active_jobs(t):
    return TB.active_jobs(t.jobs)


@query
def job_lookup(t):
    return TB.job_lookup(t.jobs, "binance_BTC/USDT:USDT_perpetual_1h_kline")


@query
def watchlist_jobs(t):
    rows = TB.watchlist_jobs(
        t.jobs, t.asset_registry, ["btc", "MYX"], C.DASHBOARD_EXCHANGES, INTERVALS, ["kline", "open_interest"]
    )
    return rows.drop("base_asset")


@query
def latest_bars(t):
    return D.latest_bars(t.market_data_raw, days=t.days)


def _stored(t, table, append, batch, *columns):
    """The table after two writes of the same batch."""
    path = scratch_path(t.spark, table)
    for _ in range(2):
        append(batch, path, now())
    rows = TB.read_table(t.spark, path)
    return rows.select(*[c for c in rows.columns if c in columns])


STORED_BARS = [*C.STREAM_KEY, "open_time", "close_time", "open", "high", "low", "close", "volume", "ingested_at"]


@query
def append_bars(t):
    step = G.interval_seconds(F.col("bar_interval"))
    batch = t.raw_ohlcv.withColumn("close_time", G.shift_seconds(F.col("open_time"), step))
    return _stored(t, "market_data_raw", TB.append_bars, batch, *STORED_BARS)


@query
def append_open_interest(t):
    values = ["open_interest_amount", "open_interest_value", "ingested_at"]
    return _stored(
        t, "open_interest_history", TB.append_open_interest, t.open_interest_history, *C.SERIES_KEY, "open_time", *values
    )


@query
def append_funding(t):
    values = ["funding_time", "funding_rate", "ingested_at"]
    return _stored(t, "funding_rate_history", TB.append_funding, t.funding_rate_history, *C.MARKET_KEY, *values)


@query
def append_long_short(t):
    return _stored(
        t, "long_short", TB.append_long_short, t.long_short_ratio_history, *C.SERIES_KEY, "open_time", "long_short_ratio"
    )


@query
def append_taker(t):
    values = ["open_time", "buy_volume", "sell_volume", "ingested_at"]
    return _stored(t, "taker", TB.append_taker, t.taker_buy_sell_volume_history, *C.SERIES_KEY, *values)


@query
def append_liquidations(t):
    values = ["liquidation_time", "side", "price", "amount", "cost", "ingested_at"]
    return _stored(t, "liquidation_event", TB.append_liquidations, t.liquidation_event, *C.MARKET_KEY, *values)


@query
def append_quality_issues(t):
    path = scratch_path(t.spark, "data_quality_issue")
    issues = settle(Q.quality_issues(_batch_bars(t), quality_plan(t)), "issues")
    for _ in range(2):
        TB.append_quality_issues(issues, path, now(), F.lit("run"))
    return TB.read_table(t.spark, path).drop("run_id")


def _typed_markets(t):
    kind = F.when(F.col("spot"), "spot").when(F.col("swap"), "perpetual").otherwise("future")
    return t.exchange_market.withColumn("market_type", kind)


@query
def upsert_registry(t):
    path = scratch_path(t.spark, "asset_registry")
    markets = _typed_markets(t).withColumn("quote_asset", F.col("quote"))
    TB.upsert_registry(markets.withColumn("base_asset", F.lit("old")), path, now(), ["seq"])
    TB.upsert_registry(markets.where(~F.col("future")).withColumn("base_asset", F.col("base")), path, now(), ["seq"])
    return TB.read_snapshot(t.spark, path, "asset_registry")


@query
def upsert_jobs(t):
    path = scratch_path(t.spark, "ingestion_job_config")
    seedable = SE.seed_market_filter(t.exchange_market)
    TB.upsert_jobs(SE.seed_jobs(seedable, INTERVALS, active=True), path, now(), ["seq", "interval_position"])
    again = SE.seed_jobs(seedable.where(F.col("exchange") == "binance"), INTERVALS)
    TB.upsert_jobs(again, path, now(), ["seq", "interval_position"])
    return TB.read_snapshot(t.spark, path, "ingestion_job_config").drop("job_id")


@query
def upsert_watchlist(t):
    path = scratch_path(t.spark, "watchlist_asset")
    listed = t.exchange_market
    for _ in range(2):
        TB.upsert_watchlist(listed.select(F.lower("base").alias("base_asset"), F.col("seq").alias("position")), path, now())
    return TB.read_snapshot(t.spark, path, "watchlist_asset")


@query
def run_log(t):
    """The log of three runs over the whole batch: into an empty store, into one that ends on 10 January, and again when all is
    stored."""
    path = scratch_path(t.spark, "ingestion_run_log")
    for stored in (t.market_data_raw.where(F.lit(False)), _stored_until(t, "2024-01-10 00:00:00"), t.market_data_raw):
        TB.append_run_log(_batch_report(t, stored), path, now(), now())
    return TB.read_table(t.spark, path).select(
        "job_name", *C.SERIES_KEY, "dataset", "request_start", "request_end", "status", "rows_fetched", "rows_inserted",
        "rows_updated", "error_message", "started_at", "ended_at",
    )


@query
def latest_run_per_job(t):
    return TB.latest_run_per_job(t.ingestion_run_log, [*C.SERIES_KEY, "dataset"])


@query
def file_and_jdbc_io(t):
    path = scratch_path(t.spark, "round_trip")
    t.market_data_raw.write.partitionBy("source_dataset", "bar_interval").parquet(path)
    prices = ["open", "high", "low", "close", "volume"]
    return TB.read_table(t.spark, path).select(*C.STREAM_KEY, "open_time", "close_time", *prices, "ingested_at")


# --- normalisation -----------------------------------------------------------------------


@query
def normalize_ohlcv(t):
    return N.normalize_ohlcv(t.landed_ohlcv).drop("quote_volume", "trade_count")


@query
def normalize_ohlcv_repeats(t):
    return N.repeats_of(N.collapse_bars(N.decode_ohlcv(t.landed_ohlcv).where(~F.col("malformed"))))


def _payload(rows, dataset, seq, **fields):
    """Landed rows of a dataset: JSON objects with the given fields (NULL fields are left out)."""
    body = F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
    interval = F.col("bar_interval") if "bar_interval" in rows.columns else F.lit("8h")
    return rows.select(
        *C.MARKET_KEY, interval.alias("bar_interval"), F.lit(dataset).alias("source_dataset"), seq.alias("fetch_seq"), body.alias("payload")
    )


def _events_with_time(t):
    """Events as raw rows; one in thirteen lacks its timestamp."""
    cells = t.cells.where(F.col("market_type") == "perpetual")
    return cells.withColumn("at", F.when(F.col("event_id") % 13 != 0, F.unix_millis("open_time")))


def _landed_open_interest(t):
    rows = _events_with_time(t)
    fields = {
        "timestamp": F.col("at"),
        "openInterestAmount": F.col("k"),
        "openInterestValue": F.when(F.col("k") % 5 != 0, F.col("px")),
        "baseVolume": F.col("k") * 2,
    }
    return _payload(rows, "open_interest", F.col("event_id"), **fields)


@query
def clip_pages(t):
    landed = N.normalize_open_interest(_landed_open_interest(t))
    plan = P.plan_series_requests(P.history_high_water(t.jobs.where(F.col("is_active")), t.days), now())
    kept = N.clip_pages(landed, plan.where(F.col("error_message").isNull()), "open_time")
    return kept.groupBy(*C.STREAM_KEY).agg(
        F.count(F.lit(1)).alias("kept"), F.min("open_time").alias("first_time"), F.max("open_time").alias("last_time")
    )


@query
def normalize_open_interest(t):
    return N.normalize_open_interest(_landed_open_interest(t))


@query
def normalize_open_interest_amount_only(t):
    rows = _events_with_time(t).where(F.col("exchange") == "kucoinfutures")
    landed = _payload(rows, "open_interest", F.col("event_id"), ts=F.col("at").cast("string"), openInterest=F.col("k").cast("string"))
    return N.normalize_open_interest_amount_only(landed)


@query
def normalize_funding(t):
    rows = t.market_events.where((F.col("market_type") == "perpetual") & (F.col("event_type") == "purchase"))
    following = F.unix_millis("ts") + 28_800_000
    info = F.struct(
        F.col("px").cast("string").alias("markPrice"),
        F.when(F.col("k") % 2 == 0, F.col("px")).alias("indexPrice"),
        F.when(F.col("k") % 3 == 0, F.lit(0)).otherwise(following).alias("nextFundingTime"),
    )
    fields = {
        "timestamp": F.when(F.col("event_id") % 13 != 0, F.unix_millis("ts")),
        "fundingRate": F.when(F.col("k") % 11 != 0, (F.col("px") - 50).cast("decimal(18,4)")),
        "info": F.when(F.col("k") % 7 != 0, info),
    }
    return N.normalize_funding(_payload(rows, "funding_rate", F.col("event_id"), **fields))


@query
def normalize_long_short(t):
    fields = {
        "timestamp": F.col("at"),
        "longShortRatio": F.when(F.col("k") % 11 != 0, ((F.col("k") + 1) / F.lit(50).cast("decimal(2,0)")).cast("decimal(10,4)")),
        "longAccount": F.col("px").cast("string"),
    }
    return N.normalize_long_short(_payload(_events_with_time(t), "long_short_ratio", F.col("event_id"), **fields))


@query
def normalize_taker(t):
    fields = {
        "timestamp": F.col("at").cast("string"),
        "buySellRatio": F.when(F.col("k") % 11 != 0, F.col("px")),
        "buyVol": F.when(F.col("k") % 5 != 0, F.col("k")),
        "sellVol": (F.lit(100) - F.col("k")).cast("string"),
    }
    return N.normalize_taker(_payload(_events_with_time(t), "taker_buy_sell_volume", F.col("event_id"), **fields))


@query
def normalize_liquidations(t):
    rows = t.liquidation_event
    fields = {
        "timestamp": F.when(F.col("event_id") % 13 != 0, F.unix_millis("liquidation_time")),
        "side": F.col("side"),
        "price": F.col("price"),
        "amount": F.when(F.col("event_id") % 4 == 0, F.lit(0)).otherwise(F.col("amount")),
        "contracts": F.col("amount") + 1,
        "cost": F.col("cost"),
    }
    landed = _payload(rows, "liquidation", F.col("event_id"), **fields)
    return N.normalize_liquidations(landed.withColumn("bar_interval", F.lit("event"))).drop("raw")


def _liquidation_jobs(t):
    return t.jobs.where((F.col("source_dataset") == "liquidation") & (F.col("exchange") == "binance"))


EVENT_COLUMNS = ["event_id", "native_symbol", *C.MARKET_KEY, "liquidation_time", "side", "price", "amount", "cost"]


@query
def decode_force_orders(t):
    return N.decode_force_orders(t.force_order_raw, _liquidation_jobs(t)).select(*EVENT_COLUMNS)


@query
def native_symbol(t):
    return t.asset_registry.select(*C.MARKET_KEY, X.native_symbol(F.col("symbol")).alias("native_symbol"))


@query
def normalize_symbol_key(t):
    return t.exchange_market.select("exchange", "symbol", X.symbol_key(F.lower("symbol")).alias("symbol_key"))


@query
def dataset_router(t):
    return N.route_datasets(t.jobs).groupBy("source_dataset", "family").agg(F.count(F.lit(1)).alias("jobs"))


# --- planning ---------------------------------------------------------------------------------


MARK_COLUMNS = ["job_name", *C.STREAM_KEY, *P.MARKS]


def _bar_marks(t):
    return P.bar_high_water(t.jobs, t.days)


def _series_marks(t):
    history = P.history_high_water(t.jobs, t.days)
    return history.unionByName(P.event_high_water(t.jobs, t.days))


@query
def bar_high_water(t):
    return _bar_marks(t).select(*MARK_COLUMNS)


@query
def history_high_water(t):
    return P.history_high_water(t.jobs, t.days).select(*MARK_COLUMNS)


@query
def event_high_water(t):
    return P.event_high_water(t.jobs, t.days).select(*MARK_COLUMNS)


@query
def floor_closed_bar(t):
    rows = t.events.select("event_id", "ts", F.explode(F.array(F.lit("5m"), F.lit("1h"), F.lit("1w"))).alias("bar_interval"))
    return rows.select(
        "event_id", "bar_interval", G.floor_closed_bar(F.col("ts"), G.interval_seconds(F.col("bar_interval"))).alias("last_open")
    )


@query
def interval_seconds(t):
    return t.jobs.groupBy("bar_interval").agg(F.count(F.lit(1)).alias("jobs")).withColumn(
        "seconds", G.interval_seconds_or_null(F.col("bar_interval"))
    )


BOUNDS = ["job_name", "fetch_mode", "request_start", "target_last_open_time", "anchor_open_time", "error_message"]


@query
def plan_bar_requests(t):
    return P.plan_bar_requests(_bar_marks(t), now()).select(*BOUNDS)


@query
def plan_skip(t):
    # planned at a time inside the data, so some streams are already past their target
    plan = P.plan_skip(P.plan_bar_requests(_bar_marks(t), G.as_timestamp("2024-01-30 12:00:00")))
    return plan.select("job_name", "status", "request_start", "request_end")


@query
def plan_series_requests(t):
    return P.plan_series_requests(_series_marks(t), now()).select(
        "job_name", "request_start", "request_end", "since_ms", "until_ms", "error_message"
    )


@query
def retention_clamp(t):
    plan = t.jobs.withColumn("request_start", F.col("start_time")).withColumn("request_end", now())
    return P.retention_clamp(plan).select("job_name", "request_start", "effective_start", "empty_range")


@query
def capability_gate(t):
    offered = t.exchange_market.select("exchange").distinct().select(
        "exchange", F.explode(F.array(F.lit("fetchOpenInterestHistory"), F.lit("fetchFundingRateHistory"))).alias("method")
    )
    offered = offered.where((F.col("exchange") != "kucoinfutures") | (F.col("method") != "fetchFundingRateHistory"))
    return P.capability_gate(t.jobs, offered).select("job_name", "gate", "gate_message")


@query
def due_streams(t):
    marks = _bar_marks(t).unionByName(_series_marks(t))
    return P.due_streams(marks, G.as_timestamp("2024-01-30 23:00:00")).select("job_name", "cadence_seconds", "age_seconds")


def quality_plan(t):
    """Requests planned when the newest stored bar lay four intervals before the batch (settled, as a run keeps it)."""

    def planned():
        step = G.interval_seconds_or_null(F.col("bar_interval"))
        before = G.shift_seconds(F.col("first_open_time"), -step * 4)
        return P.plan_skip(P.plan_bar_requests(_bar_marks(t).withColumn("last_open_time", before), now()))

    return t.settled("quality_plan", planned)


def _batch_bars(t):
    """The batch after last-row-wins, settled because storing and every quality rule read it."""
    return t.settled("batch_bars", lambda: t.collapsed)


def _batch_report(t, stored):
    decoded = N.decode_ohlcv(t.landed_ohlcv)
    good = t.settled("good_bars", lambda: N.collapse_bars(decoded.where(~F.col("malformed"))))
    bars = N.bars_of(good)
    inserted = bars.join(stored.select(*C.STREAM_KEY, "open_time"), [*C.STREAM_KEY, "open_time"], "left_anti")
    plan = quality_plan(t)
    return P.batch_run_report(plan, decoded, inserted, t.settled("landed_issues", lambda: Q.quality_issues(good, plan)))


def _stored_until(t, end):
    """The stored candles when the store ended before a time."""
    return t.market_data_raw.where(F.col("open_time") < G.as_timestamp(end))


@query
def batch_run_report(t):
    """A batch that comes again: all its bars are stored."""
    return _batch_report(t, t.market_data_raw)


@query
def batch_run_report_fresh(t):
    """The same batch as it came first: nothing is stored."""
    return _batch_report(t, t.market_data_raw.where(F.lit(False)))


@query
def batch_run_report_late(t):
    """The batch comes when the store ends on 10 January."""
    return _batch_report(t, _stored_until(t, "2024-01-10 00:00:00"))


@query
def ingest_run(t):
    """A first run of all active candle jobs into an empty lake: plan, clip, last row wins, check, store, report."""
    lake = I.Lake(t.spark, scratch_path(t.spark, "lake"))
    return I.run_candles(lake, t.jobs.where(F.col("is_active")), t.landed_ohlcv, now(), F.lit("run"))


def _landed_everything(t):
    """Payloads of every family, as they land; kucoinfutures has a shape of its own for open interest."""
    at_kucoin = F.col("exchange") == "kucoinfutures"
    amounts = _events_with_time(t).where(at_kucoin)
    amounts = _payload(amounts, "open_interest", F.col("event_id"), ts=F.col("at").cast("string"), openInterest=F.col("k").cast("string"))
    interest = _landed_open_interest(t).where(~at_kucoin).unionByName(amounts)
    ratio = _payload(_events_with_time(t), "long_short_ratio", F.col("event_id"), timestamp=F.col("at"), longShortRatio=F.col("k") + 1)
    flow = _payload(_events_with_time(t), "taker_buy_sell_volume", F.col("event_id"), timestamp=F.col("at"), buySellRatio=F.col("px"), buyVol=F.col("k"))
    prints = {"timestamp": F.unix_millis("funding_time"), "fundingRate": F.col("funding_rate")}
    funding = _payload(t.funding_rate_history, "funding_rate", F.lit(0).cast("bigint"), **prints)
    fields = {"timestamp": F.unix_millis("liquidation_time"), "side": F.col("side"), "price": F.col("price"), "amount": F.col("amount")}
    forced = _payload(t.liquidation_event, "liquidation", F.col("event_id"), **fields).withColumn("bar_interval", F.lit("event"))
    return reduce(DataFrame.unionByName, [t.landed_ohlcv, interest, ratio, flow, funding, forced])


def _complete_run(t, **options):
    """A run of all active jobs into an empty lake, symbols resolved against the catalogue. One market is not in it."""
    lake = I.Lake(t.spark, scratch_path(t.spark, "lake"))
    catalogue = t.exchange_market.where(~((F.col("exchange") == "kucoinfutures") & (F.col("base") == "myx")))
    # by dataset, as payloads land: each family reads its own, and its tasks get like shares
    landed = t.settled("landed_everything", lambda: _landed_everything(t), ["source_dataset"])
    return lake, I.run_active_jobs(lake, t.jobs, landed, now(), F.lit("run"), catalogue=catalogue, **options)


@query
def run_active_jobs(t):
    return _complete_run(t)[1]


@query
def run_registry(t):
    """The registry after a run: the markets of the candle jobs that had one."""
    return TB.read_snapshot(t.spark, _complete_run(t)[0].path("asset_registry"), "asset_registry")


@query
def run_until_failure(t):
    """Jobs in name order up to the first that fails, with what they stored."""
    lake, report = _complete_run(t, stop_at_failure=True)
    stored = lake.table("market_data_raw").groupBy(*C.STREAM_KEY).agg(F.count(F.lit(1)).alias("bars_stored"))
    return report.join(stored, C.STREAM_KEY, "left")


# --- quality ---------------------------------------------------------------------------------------


@query
def duplicate_bar(t):
    return Q.duplicate_bar(_batch_bars(t))


@query
def invalid_ohlc(t):
    return Q.invalid_ohlc(t.market_data_raw)


@query
def negative_volume(t):
    return Q.negative_volume(t.market_data_raw)


@query
def missing_bar(t):
    return Q.missing_bar(t.market_data_raw, quality_plan(t))


@query
def late_data(t):
    return Q.late_data(t.market_data_raw, quality_plan(t))


@query
def run_status(t):
    plan = quality_plan(t)
    return Q.run_status(Q.quality_issues(_batch_bars(t), plan), plan)


@query
def quality_issues(t):
    return Q.quality_issues(_batch_bars(t), quality_plan(t))


# --- markets and seeding --------------------------------------------------------------------------------


@query
def market_type_match(t):
    types = F.explode(F.array(*[F.lit(x) for x in ("spot", "perpetual", "future", "option")]))
    rows = t.exchange_market.select("*", types.alias("market_type"))
    return rows.select("exchange", "symbol", "market_type", M.market_type_match(F.col("market_type")).alias("matches"))


@query
def seed_market_filter(t):
    return SE.seed_market_filter(t.exchange_market, bases=["BTC", "ETH"], quotes=["USDT", "USD"]).select(
        "exchange", "market_type", "symbol", "id"
    )


JOB_COLUMNS = ["job_name", *C.STREAM_KEY, "fetch_mode", "start_time", "is_active", "base_asset", "quote_asset"]


def _seeded(t, **options):
    return SE.seed_jobs(SE.seed_market_filter(t.exchange_market), INTERVALS, start="2024-01-01 00:00:00", **options)


@query
def seed_jobs(t):
    return _seeded(t).select(*JOB_COLUMNS)


@query
def job_name(t):
    name = X.job_name(
        F.col("exchange"), F.col("symbol"), F.lit("perpetual"), F.lit("1h"), F.lit("mark_price_kline"), F.when(F.col("swap"), F.col("id"))
    )
    return t.exchange_market.select("exchange", "symbol", name.alias("job_name"))


@query
def seed_limit(t):
    return _seeded(t, limit=3).select("exchange", "market_type", "symbol", "bar_interval")


@query
def seed_summary(t):
    return SE.seed_summary(_seeded(t))


@query
def usdt_perpetual_pick(t):
    return M.usdt_perpetual_pick(t.exchange_market)


@query
def spot_pick(t):
    return M.spot_pick(t.exchange_market)


@query
def dashboard_jobs(t):
    return SE.dashboard_jobs(t.exchange_market, SEED_ASSETS, start="2024-01-01 00:00:00").select(*JOB_COLUMNS)


@query
def missing_assets(t):
    return SE.missing_assets(t.exchange_market, SEED_ASSETS)


@query
def resolve_symbol(t):
    listed = t.asset_registry
    spelled = F.concat_ws("-", F.lower("base_asset"), F.lower("quote_asset"))
    requests = (
        listed.select(*C.MARKET_KEY)
        .unionByName(listed.select("exchange", spelled.alias("symbol"), "market_type"))
        .unionByName(listed.select("exchange", F.concat("base_asset", F.lit("/ZZZ")).alias("symbol"), "market_type"))
        .distinct()
    )
    return M.resolve_symbol(t.exchange_market, requests)


def _asked_markets(t):
    """Every listed (exchange, asset) and one unlisted asset per exchange."""
    listed = t.asset_registry.select("exchange", F.upper("base_asset").alias("asset"))
    return listed.unionByName(listed.select("exchange", F.lit("ZZZ").alias("asset"))).distinct()


@query
def resolve_market(t):
    return M.resolve_market(t.asset_registry, _asked_markets(t))


@query
def reference_market(t):
    return M.reference_market(t.asset_registry, _asked_markets(t).select("asset").distinct())


@query
def preferred_markets_any(t):
    return M.preferred_markets_any(t.asset_registry)


@query
def preferred_markets_perp(t):
    return M.preferred_markets_perp(t.asset_registry)


@query
def normalize_selection(t):
    k = F.col("k")
    requests = t.market_events.select(
        F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, F.lit("B-TC")).otherwise(F.concat(F.lit(" "), F.lower("base"), F.lit(" "))).alias("asset"),
        F.when(k % 5 == 0, F.lit("KRAKEN")).when(k % 5 == 1, F.lit("ALL")).otherwise(F.upper("exchange")).alias("exchange"),
        F.when(k % 3 == 0, F.lit("4h")).when(k % 3 == 1, F.lit(" 5m")).otherwise(F.lit("1m")).alias("interval"),
    )
    return M.normalize_selection(requests).groupBy("asset", "exchange", "interval").agg(F.count(F.lit(1)).alias("requests"))


# --- dashboard --------------------------------------------------------------------------------------------


def _status(t):
    return D.data_status(t.jobs, t.days)


@query
def watchlist(t):
    return D.watchlist(t.watchlist_asset, t.asset_registry, _status(t))


@query
def data_status(t):
    return _status(t)


@query
def aggregate_volume(t):
    return D.aggregate_volume(t.market_data_raw, t.asset_registry, days=t.days)


@query
def volume_breakdown(t):
    return D.volume_breakdown(t.market_data_raw, t.asset_registry, days=t.days)


@query
def chart_all(t):
    return D.chart_all(t.market_data_raw, t.asset_registry, days=t.days)


def _selections(t):
    return _asked_markets(t).select("asset", "exchange", F.explode(F.array(*[F.lit(i) for i in INTERVALS])).alias("bar_interval"))


@query
def chart_single(t):
    return D.chart_single(t.market_data_raw, t.asset_registry, _selections(t), days=t.days)


@query
def chart_limit(t):
    rows = t.jobs.groupBy("bar_interval").agg(F.count(F.lit(1)).alias("jobs"))
    return rows.withColumn("chart_rows", G.chart_limit(F.col("bar_interval")))


@query
def aggregate_open_interest(t):
    return D.aggregate_open_interest(t.open_interest_history, t.asset_registry, days=t.days)


@query
def open_interest_breakdown(t):
    return D.open_interest_breakdown(t.open_interest_history, t.asset_registry, days=t.days)


@query
def aggregate_funding(t):
    return D.aggregate_funding(t.funding_rate_history, t.asset_registry, days=t.days).withColumn("value", F.round("value", 12))


@query
def funding_breakdown(t):
    return D.funding_breakdown(t.funding_rate_history, t.asset_registry, days=t.days).withColumn("value", F.round("value", 12))


@query
def long_short(t):
    return D.long_short(t.long_short_ratio_history, t.asset_registry, days=t.days)


@query
def long_short_breakdown(t):
    return D.long_short_breakdown(t.long_short_ratio_history, t.asset_registry, days=t.days)


@query
def taker(t):
    return D.taker(t.taker_buy_sell_volume_history, t.asset_registry, days=t.days)


@query
def taker_breakdown(t):
    return D.taker_breakdown(t.taker_buy_sell_volume_history, t.asset_registry, days=t.days)


@query
def liquidation_bucket(t):
    at = F.col("liquidation_time")
    return t.liquidation_event.select(
        "event_id",
        *[G.liquidation_bucket(at, F.lit(i)).alias(f"bucket_{i}") for i in C.SELECTION_INTERVALS],
    )


@query
def aggregate_liquidations(t):
    return D.aggregate_liquidations(t.liquidation_event, t.asset_registry, days=t.days)


@query
def liquidation_breakdown(t):
    return D.liquidation_breakdown(t.liquidation_event, t.asset_registry, days=t.days)


@query
def open_interest_single(t):
    return D.open_interest_single(t.open_interest_history, days=t.days)


@query
def long_short_single(t):
    return D.long_short_single(t.long_short_ratio_history, days=t.days)


@query
def taker_single(t):
    return D.taker_single(t.taker_buy_sell_volume_history, days=t.days)


@query
def funding_single(t):
    return D.funding_single(t.funding_rate_history, days=t.days)


@query
def liquidation_single(t):
    return D.liquidation_single(t.liquidation_event, days=t.days)


BUNDLE = ["series", "bar_interval", "asset", "exchange", "time", "value", "buy_volume", "sell_volume", "buy_sell_ratio", *D.LIQUIDATION_SUMS]


@query
def derivatives_all(t):
    rows = D.derivatives_all(t.derivative_tables, t.asset_registry, days=t.days)
    return rows.select(*BUNDLE).withColumn("value", F.round("value", 12))


@query
def derivatives_single(t):
    picks = _asked_markets(t).select("asset", "exchange", F.explode(F.array(*[F.lit(i) for i in C.SELECTION_INTERVALS])).alias("bar_interval"))
    return D.derivatives_single(t.derivative_tables, t.asset_registry, picks, days=t.days).select(*BUNDLE)


@query
def interval_fallback(t):
    shown = F.explode(F.array(*[F.lit(i) for i in C.SELECTION_INTERVALS]))
    rows = t.open_interest_history.groupBy("exchange").agg(F.count(F.lit(1)).alias("points"))
    return rows.select("exchange", "points", shown.alias("chart_interval")).withColumn(
        "series_interval", G.series_interval(F.col("chart_interval"))
    )


# --- factors ---------------------------------------------------------------------------------------------------


def _candles(t):
    rows = t.market_data_raw.where(F.col("source_dataset") == "kline")
    return rows.select(
        *C.SERIES_KEY, F.unix_seconds("open_time").alias("time"), F.col("close").cast("double").alias("close"), F.col("volume").cast("double").alias("volume")
    )


def _interest(t):
    rows = t.open_interest_history
    return rows.select(*C.SERIES_KEY, F.unix_seconds("open_time").alias("time"), V.open_interest_number().cast("double").alias("value"))


@query
def nearest_join(t):
    out = NJ.nearest_join(_candles(t), _interest(t), C.SERIES_KEY, unique_left=True, unique_right=True)
    return out.select(*C.SERIES_KEY, "time", F.col("nearest.time").alias("point_time"), F.col("nearest.value").alias("value"))


@query
def nearest_join_within(t):
    out = NJ.nearest_within_buckets(_candles(t), _interest(t), C.SERIES_KEY, tolerance=3600)
    return out.select(*C.SERIES_KEY, "time", F.col("nearest.time").alias("point_time"), F.col("nearest.value").alias("value"))


@query
def oi_volume_ratio(t):
    return FA.oi_volume_ratio(_candles(t), _interest(t), C.SERIES_KEY, unique_right=True).withColumn("value", F.round("value", 9))


def _bundles(t):
    """Chart and derivatives of every asset, settled once per query."""
    return FA.settled_inputs(
        D.chart_all(t.market_data_raw, t.asset_registry, days=t.days),
        D.derivatives_all(t.derivative_tables, t.asset_registry, intervals=INTERVALS, days=t.days),
    )


@query
def exchange_matrix(t):
    chart, derived = _bundles(t)
    parts = FA.series_of(chart, derived, FA.BREAKDOWN_SERIES, [*FA.SELECTION, "exchange"])
    out = FA.exchange_matrix(FA.candles_of(chart), parts)
    return out.withColumn("oi_volume_ratio", F.round("oi_volume_ratio", 9)).withColumn("funding", F.round("funding", 12))


@query
def liquidation_or_zero(t):
    chart = settle(D.chart_all(t.market_data_raw, t.asset_registry, days=t.days), "chart")
    sums = D.aggregate_liquidations(t.liquidation_event, t.asset_registry, intervals=INTERVALS, days=t.days)
    return FA.liquidation_or_zero(FA.candles_of(chart), sums)


@query
def bar_step(t):
    return FA.bar_step(_candles(t), C.SERIES_KEY)


@query
def time_range_filter(t):
    low, high = 1704672000, 1705881600
    return FA.time_range_filter(_candles(t), low, high).select(*C.SERIES_KEY, "time", "close")


@query
def market_point(t):
    chart, derived = _bundles(t)
    out = FA.market_point(FA.candles_of(chart), FA.series_of(chart, derived, FA.POINT_SERIES, FA.SELECTION))
    return out.withColumn("oi_volume_ratio", F.round("oi_volume_ratio", 9)).withColumn("funding", F.round("funding", 12))


@query
def latest_snapshot(t):
    out = FA.latest_snapshot(*_bundles(t))
    for name in ("move", "basis", "oi_volume_ratio", "funding"):
        out = out.withColumn(name, F.round(name, 12))
    return out


@query
def selection_status(t):
    one = M.resolve_market(t.asset_registry, _asked_markets(t)).select("asset", *C.MARKET_KEY)
    empty = F.lit(None).cast("string")
    every = one.select("asset").distinct().select(
        "asset", F.lit("all").alias("exchange"), empty.alias("symbol"), empty.alias("market_type")
    )
    out = D.selection_status(_status(t), one.unionByName(every))
    return out.select("asset", "selected_exchange", *C.STREAM_KEY, "row_count", "last_time")


@query
def asset_availability(t):
    rows = D.watchlist(t.watchlist_asset, t.asset_registry, _status(t))
    asked = rows.select("*", F.explode(F.array(*[F.lit(e) for e in C.SELECTION_EXCHANGES])).alias("exchange"))
    return D.asset_availability(asked, F.col("exchange")).select("base_asset", "exchange", "available")


@query
def exchange_order(t):
    rows = t.market_events.select(
        F.explode(F.array(F.col("exchange"), F.concat(F.lit("x-"), F.col("exchange")))).alias("exchange")
    ).distinct()
    return rows.select("exchange", FA.exchange_order(F.col("exchange"))["position"].alias("position"))


@query
def signed_flow(t):
    flow = D.taker(t.taker_buy_sell_volume_history, t.asset_registry, days=t.days)
    return FA.signed_flow(flow, D.aggregate_liquidations(t.liquidation_event, t.asset_registry, days=t.days))


VISIBLE = 1704672000, 1705881600


def _axis_ranges(t, **window):
    chart = D.chart_all(t.market_data_raw, t.asset_registry, days=t.days)
    derived = D.derivatives_all(t.derivative_tables, t.asset_registry, intervals=INTERVALS, days=t.days)
    out = FA.axis_ranges(chart, derived, **window)
    return out.withColumn("min", F.round("min", 6)).withColumn("max", F.round("max", 6))


@query
def axis_ranges(t):
    return _axis_ranges(t)


@query
def axis_ranges_visible(t):
    return _axis_ranges(t, first_time=VISIBLE[0], last_time=VISIBLE[1])


@query
def series_bounds(t):
    keys = [*C.SERIES_KEY, "series"]
    points = reduce(
        DataFrame.unionByName,
        [
            _candles(t).select(*C.SERIES_KEY, F.lit("close").alias("series"), F.col("close").alias("value")),
            _candles(t).select(*C.SERIES_KEY, F.lit("volume").alias("series"), F.col("volume").alias("value")),
            _interest(t).select(*C.SERIES_KEY, F.lit("open_interest").alias("series"), "value"),
        ],
    )
    plain = FA.series_bounds(points, keys).withColumn("symmetric", F.lit(False))
    mirrored = FA.series_bounds(points, keys, symmetric=True).withColumn("symmetric", F.lit(True))
    both = plain.unionByName(mirrored)
    return both.withColumn("min", F.round("min", 6)).withColumn("max", F.round("max", 6))


@query
def local_time(t):
    at = F.col("liquidation_time")
    return t.liquidation_event.select("event_id", G.local_time(at).alias("local_time"), G.local_time_text(at).alias("local_text"))


@query
def rolling_zscore(t):
    points = D.aggregate_open_interest(t.open_interest_history, t.asset_registry, days=t.days)
    return FA.rolling_zscore(points, ["asset", "bar_interval"]).withColumn("zscore", F.round("zscore", 6))


@query
def liquidation_ratio(t):
    sums = D.aggregate_liquidations(t.liquidation_event, t.asset_registry, days=t.days)
    return FA.liquidation_ratio(sums).select("asset", "bar_interval", "time", F.round("long_share", 9).alias("long_share"))


# --- streaming ------------------------------------------------------------------------------------------------------


FLUSHED = 200


def _streamed_liquidations(t, **bounds):
    """Lands the messages as files, streams them by flushes of FLUSHED messages, and returns the store, log and totals."""
    landed, store, log, checkpoint = (scratch_path(t.spark, n) for n in ("landed", "liquidations", "log", "checkpoint"))
    t.force_order_raw.select("raw").write.parquet(landed)
    bounds = bounds or {"until_idle": True}
    totals = L.run_liquidation_stream(landed, _liquidation_jobs(t), store, log, checkpoint, flush_events=FLUSHED, flush_seconds=0, **bounds)
    return store, log, totals


STORED_EVENTS = [*C.MARKET_KEY, "liquidation_time", "side", "price", "amount", "cost", "source_dataset"]


@query
def liquidation_stream(t):
    store, _, _ = _streamed_liquidations(t)
    return TB.read_table(t.spark, store).select(*STORED_EVENTS)


@query
def flush_summary(t):
    """What the log of the flushes says of each job, flushes taken together: their sizes depend on the order of landing."""
    _, log, _ = _streamed_liquidations(t)
    return L.read_batches(t.spark, log).groupBy("job_name", *C.STREAM_KEY, "status").agg(
        F.min("request_start").alias("request_start"),
        F.max("request_end").alias("request_end"),
        F.sum("rows_fetched").alias("rows_fetched"),
        F.sum("rows_inserted").alias("rows_inserted"),
    )


@query
def liquidation_flushes(t):
    """How many flushes of FLUSHED messages there were, and what the store's summary then holds of each market."""
    store, _, _ = _streamed_liquidations(t)
    flushes = F.lit(TB.last_commit(t.spark, store)).cast("bigint")
    days = TB.read_days(t.spark, store).groupBy(*C.MARKET_KEY, "day").agg(F.sum("row_count").alias("events"))
    return days.select(*C.MARKET_KEY, F.date_format("day", "yyyy-MM-dd").alias("day"), "events", flushes.alias("flushes"))


STOP_AFTER = 40


@query
def stream_bounds(t):
    """A stream that stops after STOP_AFTER events."""
    store, _, totals = _streamed_liquidations(t, max_events=STOP_AFTER)
    return totals.select("events_seen", "rows_inserted", F.lit(TB.read_table(t.spark, store).count()).alias("stored"))


@query
def stream_totals(t):
    return _streamed_liquidations(t)[2]


@query
def live_dashboard(t):
    """Dashboard sums over the one store that fetched events and the stream's flushes were both appended to."""
    store, _, _ = _streamed_liquidations(t)
    TB.append_liquidations(t.liquidation_event, store, now(), "fetched")
    TB.append_liquidations(t.liquidation_event, store, now(), "fetched")
    return D.aggregate_liquidations(TB.read_table(t.spark, store), t.asset_registry, days=TB.read_days(t.spark, store))


@query
def streaming_liquidation_buckets(t):
    landed, sink, checkpoint = (scratch_path(t.spark, n) for n in ("events", "buckets", "checkpoint"))
    t.liquidation_event.write.parquet(landed)
    events = t.spark.readStream.schema(t.liquidation_event.schema).option("maxFilesPerTrigger", "4").parquet(landed)
    L.start_bucket_stream(events, sink, checkpoint, C.SELECTION_INTERVALS, drain=True).awaitTermination()
    return L.latest_buckets(t.spark, sink)


# --- short series -----------------------------------------------------------------------------------------
# at the usual lengths few groups of the small tables are cut; here nearly all are

CUT = 4


def _cut(name, source, with_registry, *rounded):
    def build(t):
        inputs = [getattr(t, source), *([t.asset_registry] if with_registry else [])]
        out = getattr(D, name)(*inputs, limit=CUT, days=t.days)
        for column in rounded:
            out = out.withColumn(column, F.round(column, 12))
        return out

    build.__name__ = f"{name}_cut"
    query(build)


_cut("latest_bars", "market_data_raw", False)
for _name, _source in (
    ("aggregate_volume", "market_data_raw"),
    ("volume_breakdown", "market_data_raw"),
    ("aggregate_open_interest", "open_interest_history"),
    ("open_interest_breakdown", "open_interest_history"),
    ("long_short", "long_short_ratio_history"),
    ("taker", "taker_buy_sell_volume_history"),
    ("aggregate_liquidations", "liquidation_event"),
    ("liquidation_breakdown", "liquidation_event"),
):
    _cut(_name, _source, True)
_cut("aggregate_funding", "funding_rate_history", True, "value")
_cut("funding_breakdown", "funding_rate_history", True, "value")
for _name, _source in (
    ("open_interest_single", "open_interest_history"),
    ("long_short_single", "long_short_ratio_history"),
    ("taker_single", "taker_buy_sell_volume_history"),
    ("funding_single", "funding_rate_history"),
    ("liquidation_single", "liquidation_event"),
):
    _cut(_name, _source, False)
