"""Dashboard series: cross-exchange totals, per-exchange breakdowns, single markets and their bundles.

Every function answers for all assets and intervals in one plan; pass `asset` and `interval` to narrow it, and the
filters reach the scan. Output times are epoch seconds, values doubles (cast last, sums stay decimal).

Registry joins carry no broadcast hint: a small registry is broadcast by its measured size, and a large one joins
by shuffle with adaptive skew splitting. Event tables are summed per market before the join, so a market with a
third of all events reaches it as one row per bucket and task.

Newest-N series take the table's summary as `days` (see sources/summary.py): with it only the days that the series need
are read. Without it they read the whole history and give the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import timegrid as G
from tidemark.functions import values as V
from tidemark.operators import markets as M
from tidemark.sources import summary as SU

SELECTION = ["asset", "bar_interval"]


# --- shared pieces ---------------------------------------------------------------


def _narrow(rows: DataFrame, **wanted: str | None) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return rows


def _newest_rows(rows: DataFrame, groups: list[str], limit: Column | int, order: list[Column], most: int) -> DataFrame:
    """The newest `limit` rows per group; `most` is a literal bound that lets tasks drop rows before the shuffle."""
    position = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    kept = rows.withColumn("_n", position).where(F.col("_n") <= F.lit(most))
    if not isinstance(limit, int):
        kept = kept.where(F.col("_n") <= limit)
    elif limit < most:
        kept = kept.where(F.col("_n") <= F.lit(limit))
    return kept.drop("_n")


def _newest_times(rows: DataFrame, groups: list[str], limit: Column | int, time: str, most: int) -> DataFrame:
    """All rows of the newest `limit` distinct times per group."""
    position = F.dense_rank().over(Window.partitionBy(*groups).orderBy(F.col(time).desc()))
    kept = rows.withColumn("_n", position).where(F.col("_n") <= F.lit(most))
    if not isinstance(limit, int):
        kept = kept.where(F.col("_n") <= limit)
    elif limit < most:
        kept = kept.where(F.col("_n") <= F.lit(limit))
    return kept.drop("_n")


def _chart_rows(limit: int | None) -> tuple[Column | int, int]:
    if limit is not None:
        return limit, limit
    return G.chart_limit(F.col("bar_interval")), max(*C.CHART_ROWS.values(), C.CHART_ROWS_OTHER)


def _of_datasets(days: DataFrame, *datasets: str) -> DataFrame:
    return days.where(F.col("source_dataset").isin(*datasets))


def _walked(rows: DataFrame, held: DataFrame, groups: list[str], limit: Column | int) -> DataFrame:
    """The rows of the days that the newest `limit` of each group can lie on."""
    return SU.on_days(rows, SU.needed_days(held, groups, limit))


def _on_market(rows: DataFrame, markets: DataFrame) -> DataFrame:
    """Rows of the given markets with their asset."""
    return rows.join(markets.select(*C.MARKET_KEY, "asset"), C.MARKET_KEY)


def _of_symbols(rows: DataFrame, markets: DataFrame) -> DataFrame:
    """Rows of the markets' symbols, before they are summed."""
    return rows.join(markets.select("symbol").distinct(), "symbol", "left_semi")


def _active_markets(registry: DataFrame, asset: str | None) -> DataFrame:
    active = registry.where(F.col("is_active")).withColumn("asset", F.upper("base_asset"))
    return _narrow(active, asset=asset)


# --- watchlist and status -----------------------------------------------------------


def data_status(jobs: DataFrame, tables: DataFrame | dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """First, last, count and last ingest per stream. Streams come from the job list, so empty ones show zero.

    `tables` is the summary of the fact tables, or maps dataset to (table, time column), which are then read whole; a table
    without a dataset column takes the dataset name.
    """
    days = tables
    if isinstance(tables, dict):
        parts = [
            SU.summarise(table, time, None if "source_dataset" in table.columns else name) for name, (table, time) in tables.items()
        ]
        days = reduce(DataFrame.unionByName, parts)
    marks = days.groupBy(*C.MARKET_KEY, "source_dataset", F.col("bar_interval").alias("interval_key")).agg(
        *[SU.MERGED[c](c).alias(c) for c in ("first_time", "last_time", "row_count", "last_ingested_at")]
    )
    event_dataset = F.col("source_dataset").isin("funding_rate", "liquidation")
    streams = jobs.select(*C.STREAM_KEY).distinct()
    streams = streams.withColumn("interval_key", F.when(event_dataset, F.lit("")).otherwise(F.col("bar_interval")))
    return (
        streams.join(marks, [*C.MARKET_KEY, "source_dataset", "interval_key"], "left")
        .select(
            *C.STREAM_KEY,
            "first_time",
            "last_time",
            F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
            "last_ingested_at",
        )
        .orderBy("exchange", "symbol", "source_dataset", "bar_interval")
    )


def watchlist(watchlist_assets: DataFrame, registry: DataFrame, status: DataFrame) -> DataFrame:
    """Active watchlist assets with the exchanges that hold candles for them (an empty list when none does)."""
    listed = watchlist_assets.where(F.col("is_active")).select("base_asset", "display_order")
    filled = (
        status.where((F.col("source_dataset") == "kline") & (F.col("row_count") > 0)).select(*C.MARKET_KEY).distinct()
    )
    available = (
        _active_markets(registry, None)
        .join(filled, C.MARKET_KEY)
        .groupBy(F.col("asset").alias("base_asset"))
        .agg(F.sort_array(F.collect_set("exchange")).alias("exchanges"))
    )
    return (
        listed.join(available, "base_asset", "left")
        .withColumn("exchanges", F.coalesce("exchanges", F.array().cast("array<string>")))
        .orderBy("display_order", "base_asset")
    )


def selection_status(status: DataFrame, selections: DataFrame) -> DataFrame:
    """Status rows of each selection (asset, exchange, symbol, market_type); `all` takes every market of the asset."""
    every = (
        selections.where(F.col("exchange") == "all")
        .select("asset", F.lit("all").alias("selected_exchange"))
        .join(status.withColumn("asset", F.upper(F.split_part("symbol", F.lit("/"), F.lit(1)))), "asset")
    )
    one = (
        selections.where(F.col("exchange") != "all")
        .select("asset", F.col("exchange").alias("selected_exchange"), *C.MARKET_KEY)
        .join(status, C.MARKET_KEY)
    )
    return every.unionByName(one)


def asset_availability(watchlist_rows: DataFrame, exchange: Column) -> DataFrame:
    """Whether each asset can be shown for an exchange; `all` needs any exchange at all."""
    available = F.when(exchange == "all", F.size("exchanges") > 0).otherwise(F.array_contains("exchanges", exchange))
    return watchlist_rows.withColumn("available", available)


# --- candles and volume ---------------------------------------------------------------


def latest_bars(
    bars: DataFrame,
    limit: int = C.SERIES_ROWS,
    exchange: str | None = None,
    symbol: str | None = None,
    market_type: str | None = None,
    interval: str | None = None,
    dataset: str | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Newest bars of each stream as epoch seconds and doubles, NULL volume as zero."""
    wanted = dict(exchange=exchange, symbol=symbol, market_type=market_type, bar_interval=interval, source_dataset=dataset)
    rows = _narrow(bars, **wanted)
    if days is not None:
        own = _narrow(_of_datasets(days, *C.OHLCV_DATASETS), **wanted)
        rows = _walked(rows, SU.rows_by_day(own, C.STREAM_KEY), C.STREAM_KEY, limit)
    newest = _newest_rows(rows, C.STREAM_KEY, limit, [F.col("open_time").desc()], limit)
    return newest.select(
        *C.STREAM_KEY,
        G.epoch_seconds(F.col("open_time")).alias("time"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.coalesce(F.col("volume").cast("double"), F.lit(0.0)).alias("volume"),
    )


def _exchange_volume(
    bars: DataFrame,
    registry: DataFrame,
    asset: str | None,
    interval: str | None,
    days: DataFrame | None = None,
    limit: Column | int = C.CHART_ROWS_OTHER,
) -> DataFrame:
    candles = _narrow(bars.where(F.col("source_dataset") == "kline"), bar_interval=interval)
    markets = _narrow(M.preferred_markets_any(registry), asset=asset)
    if days is not None:
        own = _on_market(_narrow(_of_datasets(days, "kline"), bar_interval=interval), markets)
        candles = _walked(candles, SU.times_by_day(own, SELECTION), SELECTION, limit)
    priced = candles.select(*C.SERIES_KEY, "open_time", V.bar_notional().alias("notional"))
    return _on_market(priced, markets)


def _by_exchange(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy(*SELECTION, "open_time", "exchange").agg(F.sum(value).alias("value"))


def _over_exchanges(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy(*SELECTION, "open_time").agg(F.sum(value).alias("value"))


def _newest_volume_parts(
    bars: DataFrame, registry: DataFrame, asset: str | None, interval: str | None, limit: int | None, days: DataFrame | None
) -> DataFrame:
    rows, most = _chart_rows(limit)
    # stated here so that a join on these keys adds no filter that would keep plans from sharing the shuffle
    keyed = _exchange_volume(bars, registry, asset, interval, days, rows).where(
        F.col("asset").isNotNull() & F.col("bar_interval").isNotNull()
    )
    return _newest_times(_by_exchange(keyed, "notional"), SELECTION, rows, "open_time", most)


def aggregate_volume(
    bars: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Quote volume per bar over each asset's preferred market on every exchange; newest bars only."""
    rows, most = _chart_rows(limit)
    totals = _over_exchanges(_exchange_volume(bars, registry, asset, interval, days, rows), "notional")
    newest = _newest_rows(totals, SELECTION, rows, [F.col("open_time").desc()], most)
    return newest.select(
        *SELECTION, G.epoch_seconds(F.col("open_time")).alias("time"), F.col("value").cast("double").alias("volume")
    )


def volume_breakdown(
    bars: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """The same volume per exchange, for the newest distinct bar times."""
    return _breakdown_points(_newest_volume_parts(bars, registry, asset, interval, limit, days), "open_time")


def _breakdown_points(rows: DataFrame, time: str) -> DataFrame:
    return rows.select(
        *SELECTION, G.epoch_seconds(F.col(time)).alias("time"), "exchange", F.col("value").cast("double").alias("value")
    )


def _chart_bars(
    bars: DataFrame,
    markets: DataFrame,
    keys: list[str],
    groups: list[str],
    limit: int | None,
    asset: str | None,
    days: DataFrame | None,
) -> DataFrame:
    """Newest bars of the three price datasets for chosen markets; mark and index only for perpetuals."""
    rows, most = _chart_rows(limit)
    shown = (F.col("source_dataset") == "kline") | (F.col("market_type") == "perpetual")
    priced = (bars if asset is None else _of_symbols(bars, markets)).where(F.col("source_dataset").isin(C.OHLCV_DATASETS))
    groups = [*groups, "source_dataset"]
    if days is not None:
        own = _of_datasets(days, *C.OHLCV_DATASETS).join(markets, keys).where(shown)
        priced = _walked(priced, SU.rows_by_day(own, groups), groups, rows)
    return _newest_rows(priced.join(markets, keys).where(shown), groups, rows, [F.col("open_time").desc()], most)


PRICES = ["open", "high", "low", "close", "volume"]
SERIES_OF_DATASET = {"kline": "candles", "mark_price_kline": "markPrice", "index_price_kline": "indexPrice"}


def _series_name() -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in SERIES_OF_DATASET.items() for x in kv]), F.col("source_dataset"))


def _price_points(rows: DataFrame, groups: list[str], candle_volume: Column) -> DataFrame:
    candle = F.col("source_dataset") == "kline"
    return rows.select(
        *groups,
        _series_name().alias("series"),
        "exchange",
        "symbol",
        "market_type",
        F.col("time"),
        *[F.when(candle, F.col(c).cast("double")).alias(c) for c in ("open", "high", "low", "close")],
        F.when(candle, candle_volume).alias("volume"),
        F.when(~candle, F.col("close").cast("double")).alias("value"),
    )


def chart_all(
    bars: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Cross-exchange chart of each asset: prices of its reference market, volume as the quote total of all exchanges.

    Candles without a total fall back to their own close x volume. One long table, told apart by `series`.
    """
    assets = _active_markets(registry, asset).select("asset").distinct()
    reference = M.reference_market(registry, assets)
    shown = None if days is None else _narrow(days, bar_interval=interval)
    rows = _chart_bars(_narrow(bars, bar_interval=interval), reference, C.MARKET_KEY, SELECTION, limit, asset, shown)
    priced = rows.select(
        *SELECTION, "source_dataset", G.epoch_seconds(F.col("open_time")).alias("time"), *PRICES, F.lit(1).alias("has_bar")
    )
    # the newest times of the breakdown are the newest times of the totals, so both come from one ranked set
    newest = _newest_volume_parts(bars, registry, asset, interval, limit, days)
    totals = _over_exchanges(newest, "value").select(
        *SELECTION,
        F.lit("kline").alias("source_dataset"),
        G.epoch_seconds(F.col("open_time")).alias("time"),
        F.col("value").cast("double").alias("total"),
    )
    # one row per bar either way: stacked and grouped, which leaves the shared scan free of join filters
    timed = (
        priced.unionByName(totals, allowMissingColumns=True)
        .groupBy(*SELECTION, "source_dataset", "time")
        .agg(*[F.max(c).alias(c) for c in (*PRICES, "total", "has_bar")])
        .where(F.col("has_bar") == 1)
        .withColumn("exchange", F.lit("all"))
        .withColumn("symbol", F.concat("asset", F.lit("/ALL")))
        .withColumn("market_type", F.lit("aggregate"))
    )
    own = F.col("close").cast("double") * F.col("volume").cast("double")
    prices = _price_points(timed, SELECTION, F.coalesce("total", own))
    breakdown = _breakdown_points(newest, "open_time").withColumn("series", F.lit("volumeBreakdown"))
    return prices.unionByName(breakdown, allowMissingColumns=True)


def chart_single(
    bars: DataFrame, registry: DataFrame, selections: DataFrame, limit: int | None = None, days: DataFrame | None = None
) -> DataFrame:
    """Charts of single markets, one per selection (asset, exchange, bar_interval)."""
    chosen = M.resolve_market(registry, selections.distinct())
    newest = _chart_bars(bars, chosen, C.SERIES_KEY, ["asset", "exchange", "bar_interval"], limit, None, days)
    timed = newest.withColumn("time", G.epoch_seconds(F.col("open_time")))
    volume = F.coalesce(F.col("volume").cast("double"), F.lit(0.0))
    return _price_points(timed, ["asset", "bar_interval"], volume)


# --- open interest ------------------------------------------------------------------------


def _exchange_open_interest(
    history: DataFrame, registry: DataFrame, asset: str | None, interval: str | None, days: DataFrame | None, limit: int
) -> DataFrame:
    rows = _narrow(history.where(F.col("market_type") == "perpetual"), bar_interval=interval)
    markets = _narrow(M.preferred_markets_perp(registry), asset=asset)
    if days is not None:
        own = _on_market(_narrow(_of_datasets(days, "open_interest"), bar_interval=interval), markets)
        rows = _walked(rows, SU.times_by_day(own, SELECTION), SELECTION, limit)
    valued = rows.select(*C.SERIES_KEY, "open_time", V.open_interest_number().alias("amount"))
    return _on_market(valued, markets)


def _interest_points(totals: DataFrame, limit: int) -> DataFrame:
    newest = _newest_rows(totals, SELECTION, limit, [F.col("open_time").desc()], limit)
    return newest.select(
        *SELECTION, G.epoch_seconds(F.col("open_time")).alias("time"), F.col("value").cast("double").alias("value")
    )


def _interest_parts(parts: DataFrame, limit: int) -> DataFrame:
    return _breakdown_points(_newest_times(parts, SELECTION, limit, "open_time", limit), "open_time")


def aggregate_open_interest(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Open interest over each asset's preferred perpetuals. Exchanges without a value add contract amounts."""
    rows = _exchange_open_interest(history, registry, asset, interval, days, limit)
    return _interest_points(_over_exchanges(rows, "amount"), limit)


def open_interest_breakdown(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """The same open interest per exchange, for the newest distinct times."""
    rows = _exchange_open_interest(history, registry, asset, interval, days, limit)
    return _interest_parts(_by_exchange(rows, "amount"), limit)


# --- funding ----------------------------------------------------------------------------------


def _exchange_funding(
    history: DataFrame, registry: DataFrame, asset: str | None, days: DataFrame | None, limit: int
) -> DataFrame:
    """Sum and count of prints per asset, exchange and second; the average follows from both at any level."""
    markets = _narrow(M.preferred_markets_perp(registry), asset=asset)
    prints = history.where(F.col("market_type") == "perpetual")
    if days is not None:  # prints of distinct minutes are of distinct seconds
        own = _on_market(_of_datasets(days, "funding_rate"), markets)
        prints = _walked(prints, SU.minutes_by_day(own, ["asset"]), ["asset"], limit)
    per_market = (
        (prints if asset is None else _of_symbols(prints, markets))
        .groupBy(*C.MARKET_KEY, F.date_trunc("second", "funding_time").alias("funding_second"))
        .agg(F.sum(F.col("funding_rate").cast("decimal(25,15)")).alias("rate_sum"), F.count("funding_rate").alias("prints"))
    )
    joined = _on_market(per_market, markets)
    return joined.groupBy("asset", "funding_second", "exchange").agg(
        F.sum("rate_sum").alias("rate_sum"), F.sum("prints").alias("prints")
    )


def _mean_rate() -> Column:
    return F.try_divide(F.col("rate_sum").cast("double"), F.col("prints").cast("double"))


def _funding_points(parts: DataFrame, limit: int) -> DataFrame:
    totals = parts.groupBy("asset", "funding_second").agg(
        F.sum("rate_sum").alias("rate_sum"), F.sum("prints").alias("prints")
    )
    newest = _newest_rows(totals, ["asset"], limit, [F.col("funding_second").desc()], limit)
    return newest.select("asset", G.epoch_seconds(F.col("funding_second")).alias("time"), _mean_rate().alias("value"))


def _funding_parts(parts: DataFrame, limit: int) -> DataFrame:
    newest = _newest_times(parts, ["asset"], limit, "funding_second", limit)
    return newest.select(
        "asset", G.epoch_seconds(F.col("funding_second")).alias("time"), "exchange", _mean_rate().alias("value")
    )


def aggregate_funding(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    limit: int = C.FUNDING_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Plain average of funding prints per second over each asset's preferred perpetuals."""
    return _funding_points(_exchange_funding(history, registry, asset, days, limit), limit)


def funding_breakdown(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    limit: int = C.FUNDING_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """The average print per second and exchange, for the newest distinct seconds."""
    return _funding_parts(_exchange_funding(history, registry, asset, days, limit), limit)


# --- account ratios and taker volume ---------------------------------------------------------------


def _binance_rows(
    history: DataFrame,
    dataset: str,
    registry: DataFrame,
    asset: str | None,
    interval: str | None,
    limit: int,
    days: DataFrame | None,
) -> DataFrame:
    """Newest rows of all active perpetuals of an asset. Markets are not ranked: two quotes give two rows per time."""
    perpetual = (F.col("exchange") == "binance") & (F.col("market_type") == "perpetual")
    rows, markets = _narrow(history.where(perpetual), bar_interval=interval), _active_markets(registry, asset)
    if days is not None:
        own = _on_market(_narrow(_of_datasets(days, dataset).where(perpetual), bar_interval=interval), markets)
        rows = _walked(rows, SU.rows_by_day(own, SELECTION), SELECTION, limit)
    joined = _on_market(rows, markets)
    return _newest_rows(joined, SELECTION, limit, [F.col("open_time").desc(), F.col("symbol")], limit)


def long_short(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Account ratio of an asset's perpetuals on binance."""
    return _binance_rows(history, "long_short_ratio", registry, asset, interval, limit, days).select(
        *SELECTION, "symbol", G.epoch_seconds(F.col("open_time")).alias("time"), F.col("long_short_ratio").cast("double").alias("value")
    )


def long_short_breakdown(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """The same ratios labelled with their only exchange."""
    return long_short(history, registry, asset, interval, limit, days).withColumn("exchange", F.lit("binance"))


def _taker_values() -> list[Column]:
    return [
        F.coalesce(F.col("buy_volume").cast("double"), F.lit(0.0)).alias("buy_volume"),
        F.coalesce(F.col("sell_volume").cast("double"), F.lit(0.0)).alias("sell_volume"),
        F.col("buy_sell_ratio").cast("double").alias("buy_sell_ratio"),
    ]


def taker(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Taker buy and sell volume of an asset's perpetuals on binance, NULL volumes as zero."""
    return _binance_rows(history, "taker_buy_sell_volume", registry, asset, interval, limit, days).select(
        *SELECTION, "symbol", G.epoch_seconds(F.col("open_time")).alias("time"), *_taker_values()
    )


def taker_breakdown(
    history: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    interval: str | None = None,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """The same volumes labelled with their only exchange."""
    return taker(history, registry, asset, interval, limit, days).withColumn("exchange", F.lit("binance"))


# --- liquidations ------------------------------------------------------------------------------------

LIQUIDATION_SUMS = ["long_value", "short_value", "total_value", "event_count"]


def sized_liquidations(events: DataFrame) -> DataFrame:
    """Liquidations of perpetuals as (market, time, side in lower case, notional), each computed once per event."""
    return events.where(F.col("market_type") == "perpetual").select(
        *C.MARKET_KEY,
        F.col("liquidation_time").cast("timestamp").alias("liquidation_time"),
        F.lower("side").alias("side"),
        V.liquidation_notional().alias("notional"),
    )


def liquidation_sums() -> list[Column]:
    """Long, short and total notional and event count; unknown sides count in total and count only."""
    return [
        F.sum(V.notional_of_sides(C.LONG_SIDES)).alias("long_value"),
        F.sum(V.notional_of_sides(C.SHORT_SIDES)).alias("short_value"),
        F.sum("notional").alias("total_value"),
        F.count(F.lit(1)).alias("event_count"),
    ]


def liquidation_buckets(events: DataFrame, intervals: list[str]) -> DataFrame:
    """Sums per market, interval and bucket. Events are summed per minute first; wider buckets add up minutes."""
    minute = G.grid_floor(F.col("liquidation_time"), F.lit(60).cast("bigint"))
    minutes = (
        sized_liquidations(events).groupBy(*C.MARKET_KEY, minute.alias("minute")).agg(*liquidation_sums())
    )
    shown = minutes.select("*", F.explode(F.array(*[F.lit(i) for i in intervals])).alias("bar_interval"))
    bucket = G.liquidation_bucket(F.col("minute"), F.col("bar_interval"))
    return _rolled_up(shown.withColumn("bucket_time", bucket), [*C.SERIES_KEY, "bucket_time"])


def _rolled_up(buckets: DataFrame, keys: list[str]) -> DataFrame:
    return buckets.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in LIQUIDATION_SUMS])


def _liquidation_points(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(
        *keys,
        G.epoch_seconds(F.col("bucket_time")).alias("time"),
        *[F.col(c).cast("double").alias(c) for c in LIQUIDATION_SUMS[:3]],
        F.col("event_count").cast("bigint").alias("event_count"),
    )


def _liquidation_totals(rows: DataFrame, limit: int) -> DataFrame:
    totals = _rolled_up(rows, [*SELECTION, "bucket_time"])
    newest = _newest_rows(totals, SELECTION, limit, [F.col("bucket_time").desc()], limit)
    return _liquidation_points(newest, SELECTION)


def _liquidation_parts(parts: DataFrame, limit: int) -> DataFrame:
    newest = _newest_times(parts, SELECTION, limit, "bucket_time", limit)
    return _liquidation_points(newest, [*SELECTION, "exchange"])


def _liquidation_days(days: DataFrame) -> DataFrame:
    """Summary rows of perpetuals' liquidations, whose interval is that of the chart and not of the stream."""
    return _of_datasets(days, "liquidation").where(F.col("market_type") == "perpetual").drop("bar_interval")


def _market_liquidations(
    events: DataFrame, registry: DataFrame, asset: str | None, intervals: list[str], days: DataFrame | None, limit: int
) -> DataFrame:
    markets = _active_markets(registry, asset)
    wanted = events if asset is None else _of_symbols(events, markets)
    if days is not None:
        own = _for_each_interval(_on_market(_liquidation_days(days), markets), intervals)
        wanted = _walked(wanted, SU.buckets_by_day(own, SELECTION), SELECTION, limit)
    return _on_market(liquidation_buckets(wanted, intervals), markets)


def _exchange_liquidations(
    events: DataFrame, registry: DataFrame, asset: str | None, intervals: list[str], days: DataFrame | None, limit: int
) -> DataFrame:
    joined = _market_liquidations(events, registry, asset, intervals, days, limit)
    return _rolled_up(joined, [*SELECTION, "bucket_time", "exchange"])


def aggregate_liquidations(
    events: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    intervals: list[str] = C.SELECTION_INTERVALS,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Liquidation notional per bucket over all active perpetuals of an asset (no market ranking)."""
    return _liquidation_totals(_market_liquidations(events, registry, asset, intervals, days, limit), limit)


def liquidation_breakdown(
    events: DataFrame,
    registry: DataFrame,
    asset: str | None = None,
    intervals: list[str] = C.SELECTION_INTERVALS,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """The same sums per exchange, for the newest distinct buckets."""
    return _liquidation_parts(_exchange_liquidations(events, registry, asset, intervals, days, limit), limit)


# --- single markets -----------------------------------------------------------------------------------


def _single(
    history: DataFrame, dataset: str, time: str, groups: list[str], limit: int, days: DataFrame | None, exchange: str | None = None
) -> DataFrame:
    shown = _narrow(history, market_type="perpetual", exchange=exchange)
    if days is not None:
        own = _narrow(_of_datasets(days, dataset), market_type="perpetual", exchange=exchange)
        shown = _walked(shown, SU.rows_by_day(own, groups), groups, limit)
    return _newest_rows(shown, groups, limit, [F.col(time).desc()], limit)


def open_interest_single(history: DataFrame, limit: int = C.SERIES_ROWS, days: DataFrame | None = None) -> DataFrame:
    """Newest open interest of each perpetual stream."""
    return _single(history, "open_interest", "open_time", C.SERIES_KEY, limit, days).select(
        *C.SERIES_KEY, G.epoch_seconds(F.col("open_time")).alias("time"), V.open_interest_number().cast("double").alias("value")
    )


def long_short_single(history: DataFrame, limit: int = C.SERIES_ROWS, days: DataFrame | None = None) -> DataFrame:
    """Newest account ratios of each perpetual stream on binance; other exchanges have none."""
    rows = _single(history, "long_short_ratio", "open_time", C.SERIES_KEY, limit, days, "binance")
    return rows.select(
        *C.SERIES_KEY, G.epoch_seconds(F.col("open_time")).alias("time"), F.col("long_short_ratio").cast("double").alias("value")
    )


def taker_single(history: DataFrame, limit: int = C.SERIES_ROWS, days: DataFrame | None = None) -> DataFrame:
    """Newest taker volumes of each perpetual stream on binance; other exchanges have none."""
    rows = _single(history, "taker_buy_sell_volume", "open_time", C.SERIES_KEY, limit, days, "binance")
    return rows.select(*C.SERIES_KEY, G.epoch_seconds(F.col("open_time")).alias("time"), *_taker_values())


def funding_single(history: DataFrame, limit: int = C.FUNDING_ROWS, days: DataFrame | None = None) -> DataFrame:
    """Newest funding prints of each perpetual, one point per print."""
    return _single(history, "funding_rate", "funding_time", C.MARKET_KEY, limit, days).select(
        *C.MARKET_KEY, G.epoch_seconds(F.col("funding_time")).alias("time"), F.col("funding_rate").cast("double").alias("value")
    )


def liquidation_single(
    events: DataFrame,
    intervals: list[str] = C.SELECTION_INTERVALS,
    limit: int = C.SERIES_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Liquidation buckets of each perpetual, listed in the registry or not."""
    if days is not None:
        own = _for_each_interval(_liquidation_days(days), intervals)
        events = _walked(events, SU.buckets_by_day(own, C.SERIES_KEY), C.SERIES_KEY, limit)
    newest = _newest_rows(
        liquidation_buckets(events, intervals), C.SERIES_KEY, limit, [F.col("bucket_time").desc()], limit
    )
    return _liquidation_points(newest, C.SERIES_KEY)


# --- bundles --------------------------------------------------------------------------------------------


def _stacked(parts: dict[str, DataFrame]) -> DataFrame:
    labelled = [part.withColumn("series", F.lit(name)) for name, part in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def _shown_as(rows: DataFrame, intervals: list[str]) -> DataFrame:
    """Repeats a stored series for every chart interval that reads it (1m charts read the 5m series)."""
    asked = F.array(*[F.lit(i) for i in intervals])
    fits = F.filter(asked, lambda i: G.series_interval(i) == F.col("bar_interval"))
    return rows.withColumn("bar_interval", F.explode(fits))


def _for_each_interval(rows: DataFrame, intervals: list[str]) -> DataFrame:
    return rows.select("*", F.explode(F.array(*[F.lit(i) for i in intervals])).alias("bar_interval"))


def derivatives_all(
    tables: dict[str, DataFrame],
    registry: DataFrame,
    asset: str | None = None,
    intervals: list[str] = C.SELECTION_INTERVALS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Every derived series of an asset across exchanges, one long table told apart by `series`."""
    rows = C.SERIES_ROWS
    # every total is rolled up from its breakdown, whose shuffle both of them read
    interest = _by_exchange(_exchange_open_interest(tables["open_interest"], registry, asset, None, days, rows), "amount")
    funding = _exchange_funding(tables["funding_rate"], registry, asset, days, C.FUNDING_ROWS)
    forced = _exchange_liquidations(tables["liquidation"], registry, asset, intervals, days, rows)
    ratios = long_short(tables["long_short_ratio"], registry, asset, days=days).drop("symbol")
    flows = taker(tables["taker_buy_sell_volume"], registry, asset, days=days).drop("symbol")
    parts = {
        "openInterest": _shown_as(_interest_points(_over_exchanges(interest, "value"), rows), intervals),
        "openInterestBreakdown": _shown_as(_interest_parts(interest, rows), intervals),
        "fundingRate": _for_each_interval(_funding_points(funding, C.FUNDING_ROWS), intervals),
        "fundingRateBreakdown": _for_each_interval(_funding_parts(funding, C.FUNDING_ROWS), intervals),
        "liquidations": _liquidation_totals(forced, rows),
        "liquidationBreakdown": _liquidation_parts(forced, rows),
    }
    # series from one exchange are their own breakdown: the same rows under both names
    twice = [
        _twice(_shown_as(ratios, intervals), "longShortRatio"),
        _twice(_shown_as(flows, intervals), "takerBuySell"),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_stacked(parts), *twice])


def _twice(rows: DataFrame, name: str) -> DataFrame:
    total = F.struct(F.lit(name).alias("series"), F.lit(None).cast("string").alias("exchange"))
    part = F.struct(F.lit(f"{name}Breakdown").alias("series"), F.lit("binance").alias("exchange"))
    return rows.select("*", F.inline(F.array(total, part)))


def derivatives_single(
    tables: dict[str, DataFrame], registry: DataFrame, selections: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Derived series of single markets per selection (asset, exchange, bar_interval); spot markets have none."""
    chosen = M.resolve_market(registry, selections.distinct()).where(F.col("market_type") == "perpetual")
    intervals = C.SELECTION_INTERVALS

    def of(part: DataFrame, keys: list[str]) -> DataFrame:
        return part.join(chosen, keys).drop("symbol", "market_type")

    parts = {
        "openInterest": of(_shown_as(open_interest_single(tables["open_interest"], days=days), intervals), C.SERIES_KEY),
        "longShortRatio": of(_shown_as(long_short_single(tables["long_short_ratio"], days=days), intervals), C.SERIES_KEY),
        "takerBuySell": of(_shown_as(taker_single(tables["taker_buy_sell_volume"], days=days), intervals), C.SERIES_KEY),
        "fundingRate": of(funding_single(tables["funding_rate"], days=days), C.MARKET_KEY),
        "liquidations": of(liquidation_single(tables["liquidation"], intervals, days=days), C.SERIES_KEY),
    }
    return _stacked(parts)
