"""Market tables derived from the `events` table, for queries, tests and benchmarks.

One scan of events fans out into the 1h and 5m cells and the three price datasets inside the plan. Every derivation
is a grouped aggregate with map-side combine. The stored tables of the data model are written once per application to
the shared folder (see staging.py) in the layout they have in production, so queries prune partitions and columns;
everything else is derived in place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark import schemas as S
from tidemark.functions import timegrid as G
from tidemark.operators import normalize
from tidemark.session import configure
from tidemark.sources import summary as SU
from tidemark.sources.staging import settle_once, source_version

CELL_SECONDS = {"1h": 3600, "5m": 300}
LAYOUT = {**S.LAYOUT, "raw_ohlcv": S.LAYOUT["market_data_raw"]}


def _floor(ts: Column, seconds: int) -> Column:
    return G.grid_floor(ts, F.lit(seconds).cast("bigint"))


class MarketTables:
    """The derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def _version(self) -> tuple:
        return source_version(self.spark, f"{self.sf_dir}/events.parquet")

    def _stored(self, name: str, rows: Callable[[], DataFrame], partition_by=(), sort_by=()) -> DataFrame:
        return settle_once(self.spark, self._version, name, rows, tuple(partition_by), tuple(sort_by))

    def _fact(self, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
        """A stored fact table in its layout and by day."""
        time = S.TIME_COLUMN[name]
        return self._stored(
            name, lambda: rows().withColumn(SU.DAY, F.to_date(time)), [*LAYOUT.get(name, []), SU.DAY], [*C.MARKET_KEY, time]
        )

    def settled(self, name: str, build: Callable[[], DataFrame], partition_by: list[str] = ()) -> DataFrame:
        """An intermediate result kept for the whole application."""
        return self._stored(name, build, partition_by)

    @cached_property
    def events(self) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        return rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")

    @cached_property
    def market_events(self) -> DataFrame:
        user = F.col("user_id")
        group = lambda step: F.floor(user / step) % 3
        rows = self.events.select(
            "event_id",
            "ts",
            "event_type",
            F.col("value").cast("decimal(18,2)").alias("px"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
            F.element_at(F.array(*[F.lit(e) for e in C.DASHBOARD_EXCHANGES]), (user % 4 + 1).cast("int")).alias("exchange"),
            F.element_at(F.array(F.lit("BTC"), F.lit("ETH"), F.lit("MYX")), (group(4) + 1).cast("int")).alias("base"),
            group(12).cast("int").alias("v"),
        )
        coinbase = F.col("exchange") == "coinbase"
        quote = (
            F.when(coinbase, F.element_at(F.array(F.lit("USD"), F.lit("USDC"), F.lit("USDT")), F.col("v") + 1))
            .when(F.col("v") == 1, "USDC")
            .otherwise("USDT")
        )
        spot = coinbase | (F.col("v") == 2)
        return (
            rows.withColumn("market_type", F.when(spot, "spot").otherwise("perpetual"))
            .withColumn("quote", quote)
            .withColumn(
                "symbol",
                F.concat("base", F.lit("/"), "quote", F.when(spot, F.lit("")).otherwise(F.concat(F.lit(":"), F.col("quote")))),
            )
        )

    @cached_property
    def asset_registry(self) -> DataFrame:
        return self._stored("asset_registry", self._derive_asset_registry, (), ())

    def _derive_asset_registry(self) -> DataFrame:
        base = F.when(F.col("exchange") == "kucoinfutures", F.lower("base")).otherwise(F.col("base"))
        inactive = (F.col("exchange") == "bybit") & (F.col("base") == "MYX") & (F.col("v") == 1)
        return self.market_events.select(
            *C.MARKET_KEY, base.alias("base_asset"), F.col("quote").alias("quote_asset"), (~inactive).alias("is_active")
        ).distinct()

    @cached_property
    def watchlist_asset(self) -> DataFrame:
        rows = [("BTC", 1, True), ("ETH", 2, True), ("MYX", 3, True), ("MOVR", 4, True), ("UB", 5, False)]
        return self.spark.createDataFrame(rows, "base_asset string, display_order bigint, is_active boolean")

    @cached_property
    def cells(self) -> DataFrame:
        cell = F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("bar_interval"), _floor(F.col("ts"), seconds).alias("open_time"))
                    for name, seconds in CELL_SECONDS.items()
                ]
            )
        )
        return self.market_events.select(*C.MARKET_KEY, "event_id", "ts", "event_type", "px", "k", cell.alias("c")).select(
            *C.MARKET_KEY, "c.bar_interval", "c.open_time", "event_id", "ts", "event_type", "px", "k"
        )

    @cached_property
    def raw_ohlcv(self) -> DataFrame:
        return self._stored("raw_ohlcv", self._derive_raw_ohlcv, LAYOUT["raw_ohlcv"], [*C.MARKET_KEY, "open_time"])

    def _derive_raw_ohlcv(self) -> DataFrame:
        """Fetched candles with repeats (fetch_seq 0 and 1), some with a bad high or a negative volume."""
        perpetual, kind = F.col("market_type") == "perpetual", F.col("event_type")
        datasets = F.array_compact(
            F.array(
                F.lit("kline"),
                F.when(perpetual & kind.isin("view", "click"), F.lit("mark_price_kline")),
                F.when(perpetual & kind.isin("view", "signup"), F.lit("index_price_kline")),
            )
        )
        grouped = (
            self.cells.withColumn("source_dataset", F.explode(datasets))
            .groupBy(*C.STREAM_KEY, "open_time", (F.col("event_id") % 2).alias("fetch_seq"))
            .agg(
                F.min_by("px", "event_id").alias("open"),
                F.max("px").alias("top"),
                F.min("px").alias("low"),
                F.max_by("px", "event_id").alias("close"),
                F.sum("k").alias("units"),
            )
        )
        hour_of_month = F.dayofmonth("open_time") * 24 + F.hour("open_time")
        return grouped.select(
            *C.STREAM_KEY,
            "open_time",
            "fetch_seq",
            "open",
            F.when(hour_of_month % 97 == 0, F.col("low") - 1).otherwise(F.col("top")).cast("decimal(19,2)").alias("high"),
            "low",
            "close",
            F.when(hour_of_month % 89 == 0, -F.col("units")).otherwise(F.col("units")).alias("volume"),
        )

    @cached_property
    def landed_ohlcv(self) -> DataFrame:
        """The fetched candles as JSON payloads, a few without an open price."""
        hour_of_month = F.dayofmonth("open_time") * 24 + F.hour("open_time")
        malformed = (F.col("exchange") == "coinbase") & (hour_of_month % 211 == 0)
        opened = F.when(malformed, F.lit("null")).otherwise(F.col("open").cast("string"))
        cells = [F.unix_millis("open_time").cast("string"), opened]
        cells += [F.col(c).cast("string") for c in ("high", "low", "close", "volume")]
        payload = F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))
        return self.raw_ohlcv.select(*C.STREAM_KEY, "fetch_seq", payload.alias("payload"))

    @cached_property
    def collapsed(self) -> DataFrame:
        return normalize.collapse_bars(self.raw_ohlcv)

    @cached_property
    def market_data_raw(self) -> DataFrame:
        return self._fact("market_data_raw", self._derive_market_data_raw)

    def _derive_market_data_raw(self) -> DataFrame:
        two_hours = F.lit(7200).cast("bigint")
        return (
            normalize.bars_of(self.collapsed)
            .drop("copies")
            .withColumn("ingested_at", G.shift_seconds(F.col("open_time"), two_hours))
        )

    @cached_property
    def open_interest_history(self) -> DataFrame:
        return self._fact("open_interest_history", self._derive_open_interest_history)

    def _derive_open_interest_history(self) -> DataFrame:
        rows = self.cells.where((F.col("market_type") == "perpetual") & F.col("event_type").isin("signup", "purchase"))
        value = F.when(F.col("exchange") != "kucoinfutures", F.sum(F.col("px") * 100).cast("decimal(18,2)"))
        return (
            rows.groupBy(*C.SERIES_KEY, "open_time")
            .agg(F.sum("k").cast("decimal(18,2)").alias("open_interest_amount"), value.alias("open_interest_value"))
            .withColumn("ingested_at", G.shift_seconds(F.col("open_time"), F.lit(7200).cast("bigint")))
        )

    @cached_property
    def funding_rate_history(self) -> DataFrame:
        return self._fact("funding_rate_history", self._derive_funding_rate_history)

    def _derive_funding_rate_history(self) -> DataFrame:
        rows = self.market_events.where((F.col("market_type") == "perpetual") & (F.col("event_type") == "purchase"))
        grouped = rows.groupBy(*C.MARKET_KEY, _floor(F.col("ts"), 8 * 3600).alias("slot")).agg(
            F.max("k").alias("late_ms"), F.min("px").alias("low"), F.max("ts").alias("last_ts")
        )
        rate = ((F.col("low") - 50).cast("decimal(18,8)") / F.lit(100000)).cast("decimal(25,15)")
        return grouped.select(
            *C.MARKET_KEY,
            F.timestamp_millis(F.unix_millis("slot") + F.col("late_ms")).alias("funding_time"),
            rate.alias("funding_rate"),
            G.shift_seconds(F.col("last_ts"), F.lit(3600).cast("bigint")).alias("ingested_at"),
        )

    def _binance_cells(self, kind: str) -> DataFrame:
        return self.cells.where(
            (F.col("exchange") == "binance") & (F.col("market_type") == "perpetual") & (F.col("event_type") == kind)
        )

    @cached_property
    def long_short_ratio_history(self) -> DataFrame:
        return self._fact("long_short_ratio_history", self._derive_long_short_ratio_history)

    def _derive_long_short_ratio_history(self) -> DataFrame:
        return (
            self._binance_cells("view")
            .groupBy(*C.SERIES_KEY, "open_time")
            .agg(((F.max("k") + 1).cast("double") / 50).alias("long_short_ratio"))
            .withColumn("ingested_at", G.shift_seconds(F.col("open_time"), F.lit(7200).cast("bigint")))
        )

    @cached_property
    def taker_buy_sell_volume_history(self) -> DataFrame:
        return self._fact("taker_buy_sell_volume_history", self._derive_taker_buy_sell_volume_history)

    def _derive_taker_buy_sell_volume_history(self) -> DataFrame:
        ratio = F.try_divide(F.col("buy_volume").cast("double"), F.col("sell_volume").cast("double"))
        return (
            self._binance_cells("click")
            .groupBy(*C.SERIES_KEY, "open_time")
            .agg(F.sum("k").alias("buy_volume"), F.sum(F.lit(100) - F.col("k")).alias("sell_volume"))
            .withColumn("buy_sell_ratio", ratio)
            .withColumn("ingested_at", G.shift_seconds(F.col("open_time"), F.lit(7200).cast("bigint")))
        )

    @cached_property
    def liquidation_event(self) -> DataFrame:
        return self._fact("liquidation_event", self._derive_liquidation_event)

    def _derive_liquidation_event(self) -> DataFrame:
        k, px = F.col("k"), F.col("px")
        side = F.try_element_at(
            F.array(F.lit("BUY"), F.lit("SELL"), F.lit("long"), F.lit("Short")), (k % 5 + 1).cast("int")
        )
        return self.market_events.where(F.col("event_type") == "error").select(
            "event_id",
            *C.MARKET_KEY,
            F.col("ts").alias("liquidation_time"),
            side.alias("side"),
            F.when(k % 7 != 0, px).alias("price"),
            k.alias("amount"),
            F.when(k % 3 != 0, px * k).alias("cost"),
            G.shift_seconds(F.col("ts"), F.lit(60).cast("bigint")).alias("ingested_at"),
        )

    @cached_property
    def exchange_market(self) -> DataFrame:
        return self._stored("exchange_market", self._derive_exchange_market)

    def _derive_exchange_market(self) -> DataFrame:
        perpetual = F.col("market_type") == "perpetual"
        unknown = F.lit(None).cast("boolean")
        pair = F.replace(F.split_part("symbol", F.lit(":"), F.lit(1)), F.lit("/"), F.lit(""))
        listed = self.asset_registry.select(
            "exchange",
            "symbol",
            pair.alias("id"),
            F.col("base_asset").alias("base"),
            F.col("quote_asset").alias("quote"),
            (~perpetual).alias("spot"),
            perpetual.alias("swap"),
            perpetual.alias("contract"),
            F.lit(False).alias("future"),
            F.col("is_active").alias("active"),
        )
        linear = (F.col("exchange") == "binance") & (F.col("quote_asset") == "USDT") & perpetual
        dated = self.asset_registry.where(linear).select(
            "exchange",
            F.concat("base_asset", F.lit("/USDT:USDT-240329")).alias("symbol"),
            F.concat("base_asset", F.lit("USDT240329")).alias("id"),
            F.col("base_asset").alias("base"),
            F.lit("USDT").alias("quote"),
            F.lit(False).alias("spot"),
            F.lit(False).alias("swap"),
            F.lit(True).alias("contract"),
            F.lit(True).alias("future"),
            F.lit(True).alias("active"),
        )
        # catalogue order: symbols from Z to A within each exchange, so it differs from tie-breaks by symbol
        position = F.row_number().over(Window.partitionBy("exchange").orderBy(F.col("symbol").desc()))
        return (
            listed.unionByName(dated)
            .withColumn("market_has_ohlcv", unknown)
            .withColumn("client_has_ohlcv", F.lit(True))
            .withColumn("seq", position.cast("bigint"))
        )

    @cached_property
    def force_order_raw(self) -> DataFrame:
        """Live liquidation messages, half of them inside a stream envelope."""
        k, px = F.col("k"), F.col("px").cast("string")
        quoted = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
        at = F.lit(1704067200000).cast("bigint") + F.col("event_id") * 1000
        order = F.concat_ws(
            ",",
            quoted("s", F.concat("base", F.lit("USDT"))),
            quoted("S", F.when(k % 2 == 0, "SELL").otherwise("BUY")),
            quoted("ap", F.when(k % 4 == 0, F.lit("0")).otherwise(px)),
            quoted("p", px),
            quoted("z", F.when(k % 3 == 0, F.lit("0")).otherwise(k.cast("string"))),
            quoted("l", k.cast("string")),
            quoted("q", (k + 1).cast("string")),
            F.when(k % 10 != 0, F.concat(F.lit('"T":'), (at - 5).cast("string"))),
        )
        body = F.concat(F.lit('{"e":"forceOrder","E":'), at.cast("string"), F.lit(',"o":{'), order, F.lit("}}"))
        enveloped = F.concat(F.lit('{"stream":"x@forceOrder","data":'), body, F.lit("}"))
        rows = self.market_events.where((F.col("exchange") == "binance") & (F.col("event_type") == "error"))
        return rows.select("event_id", F.when(F.col("event_id") % 2 == 0, enveloped).otherwise(body).alias("raw"))

    @cached_property
    def ingestion_run_log(self) -> DataFrame:
        return self._stored("ingestion_run_log", self._derive_ingestion_run_log)

    def _derive_ingestion_run_log(self) -> DataFrame:
        states = F.array(F.lit("failed"), F.lit("success"), F.lit("partial_success"), F.lit("skipped"))
        return (
            self.raw_ohlcv.groupBy(
                *C.SERIES_KEY, F.col("source_dataset").alias("dataset"), _floor(F.col("open_time"), 86400).alias("started_at")
            )
            .agg(F.count(F.lit(1)).alias("rows_fetched"))
            .withColumn("status", F.element_at(states, (F.col("rows_fetched") % 4 + 1).cast("int")))
        )

    @cached_property
    def jobs(self) -> DataFrame:
        return self._stored("jobs", self._derive_jobs)

    def _derive_jobs(self) -> DataFrame:
        """Jobs over every registered market with a mix of modes, ranges, gaps in support and one unknown dataset."""
        spot = F.col("market_type") == "spot"
        pairs = [(d, i) for d in C.OHLCV_DATASETS for i in ("1h", "5m")]
        pairs += [(d, i) for d in ("open_interest", "long_short_ratio", "taker_buy_sell_volume") for i in ("1h", "5m")]
        pairs += [("open_interest", "2h"), ("open_interest", "1d"), ("long_short_ratio", "3m"), ("funding_rate", "8h")]
        pairs += [("liquidation", "event"), ("trades", "1h")]
        listed = F.array(*[F.struct(F.lit(d).alias("source_dataset"), F.lit(i).alias("bar_interval")) for d, i in pairs])
        rows = (
            self.asset_registry.select(*C.MARKET_KEY, "base_asset", "quote_asset", F.explode(listed).alias("j"))
            .select(*C.MARKET_KEY, "base_asset", "quote_asset", "j.bar_interval", "j.source_dataset")
            .where(~spot | (F.col("source_dataset") == "kline"))
        )
        usdc, eth = F.col("quote_asset") == "USDC", F.upper("base_asset") == "ETH"
        backfill = (F.col("source_dataset") == "index_price_kline") | (eth & (F.col("source_dataset") == "open_interest"))
        name = F.concat_ws("_", *C.STREAM_KEY)
        return rows.select(
            F.sha1(name).alias("job_id"),
            name.alias("job_name"),
            *C.STREAM_KEY,
            F.when(backfill, "backfill").otherwise("incremental").alias("fetch_mode"),
            F.when(~usdc, F.lit("2023-12-01 00:00:00")).cast("timestamp").alias("start_time"),
            F.when(eth & (F.col("bar_interval") == "5m"), F.lit("2024-01-20 00:00:00")).cast("timestamp").alias("end_time"),
            (~((F.col("exchange") == "bybit") & eth)).alias("is_active"),
        )

    @cached_property
    def histories(self) -> dict[str, DataFrame]:
        return {
            "open_interest": self.open_interest_history,
            "long_short_ratio": self.long_short_ratio_history,
            "taker_buy_sell_volume": self.taker_buy_sell_volume_history,
        }

    @cached_property
    def event_tables(self) -> dict[str, tuple[DataFrame, str]]:
        return {
            "funding_rate": (self.funding_rate_history, "funding_time"),
            "liquidation": (self.liquidation_event, "liquidation_time"),
        }

    @cached_property
    def days(self) -> DataFrame:
        """The summary of all fact tables by stream and day, as appends keep it."""
        return self._stored("days", self._derive_days)

    def _derive_days(self) -> DataFrame:
        parts = [SU.summarise(self.market_data_raw, "open_time", close="close_time")]
        parts += [SU.summarise(table, "open_time", name) for name, table in self.histories.items()]
        parts += [SU.summarise(table, time, name) for name, (table, time) in self.event_tables.items()]
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def status_tables(self) -> dict[str, tuple[DataFrame, str]]:
        tables = {name: (table, "open_time") for name, table in self.histories.items()}
        return {"kline": (self.market_data_raw, "open_time"), **tables, **self.event_tables}

    @cached_property
    def derivative_tables(self) -> dict[str, DataFrame]:
        return {**self.histories, **{name: table for name, (table, _) in self.event_tables.items()}}
