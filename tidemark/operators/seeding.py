"""Ingestion jobs from exchange catalogues.

A catalogue row has exchange, symbol, id, base, quote, the type flags, active, market_has_ohlcv, client_has_ohlcv
and `seq`, its position in the exchange's list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import text as X
from tidemark.functions import timegrid as G
from tidemark.operators import markets as M


def _list(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def seed_market_filter(
    catalogue: DataFrame,
    exchanges: list[str] | None = None,
    bases: list[str] | None = None,
    quotes: list[str] | None = None,
) -> DataFrame:
    """Catalogue rows that can be seeded, one per market type they match.

    Base and quote lists apply only to markets that have one; a market is dropped for lack of candles only when
    both it and the exchange adapter lack them.
    """
    by_exchange = F.create_map(
        *[x for name, types in C.MARKET_TYPES_BY_EXCHANGE.items() for x in (F.lit(name), _list(types))]
    )
    types = F.coalesce(F.try_element_at(by_exchange, F.col("exchange")), _list(["spot"]))
    rows = catalogue if exchanges is None else catalogue.where(F.col("exchange").isin(exchanges))
    rows = rows.withColumn("market_type", F.explode(types)).where(M.market_type_match(F.col("market_type")))
    rows = rows.where(F.coalesce("active", F.lit(True)))
    for column, wanted in (("base", bases), ("quote", quotes)):
        if wanted:
            present = F.coalesce(F.col(column), F.lit("")) != ""
            rows = rows.where(~present | F.upper(column).isin([w.upper() for w in wanted]))
    return rows.where(F.coalesce("market_has_ohlcv", F.lit(True)) | F.coalesce("client_has_ohlcv", F.lit(False)))


def _as_jobs(rows: DataFrame, fetch_mode: str, start: str | None, end: str | None, active: bool) -> DataFrame:
    market_id = F.coalesce("id", F.lit(""))
    return rows.select(
        X.job_name(
            F.col("exchange"), F.col("symbol"), F.col("market_type"), F.col("bar_interval"), F.col("source_dataset"), market_id
        ).alias("job_name"),
        *C.STREAM_KEY,
        F.lit(fetch_mode).alias("fetch_mode"),
        G.as_timestamp(start).alias("start_time"),
        G.as_timestamp(end).alias("end_time"),
        F.lit(active).alias("is_active"),
        F.coalesce("base", F.lit("")).alias("base_asset"),
        F.coalesce("quote", F.lit("")).alias("quote_asset"),
        "seq",
        "interval_position",
    )


def seed_jobs(
    seedable: DataFrame,
    intervals: list[str],
    fetch_mode: str = "incremental",
    start: str | None = None,
    end: str | None = None,
    active: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Candle jobs for every seedable market and interval; `limit` counts jobs per exchange and market type."""
    rows = seedable.select("*", F.posexplode(_list(intervals)).alias("interval_position", "bar_interval"))
    jobs = _as_jobs(rows.withColumn("source_dataset", F.lit("kline")), fetch_mode, start, end, active)
    return jobs if limit is None else seed_limit(jobs, limit)


def seed_limit(jobs: DataFrame, limit: int) -> DataFrame:
    """The first `limit` jobs per exchange and market type, in catalogue order; may cut a market in half."""
    return M.limit_per_group(jobs, ["exchange", "market_type"], ["seq", "interval_position"], limit)


def seed_summary(jobs: DataFrame, dry_run: bool = False) -> DataFrame:
    """Markets found and jobs written per exchange and market type."""
    return jobs.groupBy("exchange", "market_type").agg(
        F.countDistinct("symbol").alias("discovered_markets"),
        (F.lit(0).cast("bigint") if dry_run else F.count(F.lit(1))).alias("created_or_updated_jobs"),
    )


def _dashboard_requests(catalogue: DataFrame, assets: list[str], exchanges: list[str]) -> DataFrame:
    spark = catalogue.sparkSession
    return (
        spark.range(1)
        .select(F.posexplode(_list(exchanges)).alias("exchange_position", "exchange"))
        .select("*", F.posexplode(_list(assets)).alias("asset_position", "asset"))
        .withColumn("asset", F.upper("asset"))
        .withColumn("market_type", F.when(F.col("exchange") == "coinbase", "spot").otherwise("perpetual"))
    )


def _dashboard_picks(catalogue: DataFrame) -> DataFrame:
    return (
        M.usdt_perpetual_pick(catalogue)
        .withColumn("market_type", F.lit("perpetual"))
        .unionByName(M.spot_pick(catalogue).withColumn("market_type", F.lit("spot")))
    )


def dashboard_jobs(
    catalogue: DataFrame,
    assets: list[str] = C.WATCHLIST_ASSETS,
    exchanges: list[str] = C.DASHBOARD_EXCHANGES,
    intervals: list[str] = C.DASHBOARD_INTERVALS,
    datasets: list[str] = C.ALL_DATASETS,
    fetch_mode: str = "incremental",
    start: str | None = None,
    end: str | None = None,
    active: bool = True,
) -> DataFrame:
    """Jobs that keep the dashboard's assets fresh: one market per exchange and asset, then its datasets."""
    derived = [i for i in intervals if i in C.DERIVED_SERIES_INTERVALS]
    ratio = (F.col("exchange") == "binance") & (F.col("market_type") == "perpetual")
    dataset = F.col("source_dataset")
    of_dataset = (
        F.when(dataset.isin(C.OHLCV_DATASETS), _list(intervals))
        .when(dataset == "open_interest", _list(derived))
        .when(dataset == "funding_rate", _list(["8h"]))
        .when(dataset.isin("long_short_ratio", "taker_buy_sell_volume") & ratio, _list(derived))
        .when(dataset == "liquidation", _list(["event"]))
        .otherwise(_list([]))
    )
    rows = (
        _dashboard_requests(catalogue, assets, exchanges)
        .join(_dashboard_picks(catalogue), ["exchange", "asset", "market_type"])
        .withColumn("seq", F.col("exchange_position") * F.lit(len(assets)) + F.col("asset_position"))
        .select("*", F.explode(_list(datasets)).alias("source_dataset"))
        .where((F.col("market_type") != "spot") | (dataset == "kline"))
        .select("*", F.posexplode(of_dataset).alias("interval_position", "bar_interval"))
    )
    return _as_jobs(rows, fetch_mode, start, end, active)


def missing_assets(
    catalogue: DataFrame, assets: list[str] = C.WATCHLIST_ASSETS, exchanges: list[str] = C.DASHBOARD_EXCHANGES
) -> DataFrame:
    """`exchange:asset` pairs for which no market is listed."""
    wanted = _dashboard_requests(catalogue, assets, exchanges)
    missing = wanted.join(_dashboard_picks(catalogue), ["exchange", "asset", "market_type"], "left_anti")
    return missing.select(F.concat_ws(":", "exchange", "asset").alias("missing"))
