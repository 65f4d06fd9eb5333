"""Market choice: which listed market stands for an asset or a requested symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import text as X
from tidemark.functions.values import rank_of

#: White space of any script, and byte-order marks, at either end.
WHITE_ENDS = r"(?U)\A[\s\uFEFF]+|[\s\uFEFF]+\z"


MARKET_COLUMNS = ["symbol", "market_type"]


def market_type_match(market_type: Column) -> Column:
    """Whether a catalogue row is of a market type; a dated contract also counts as perpetual."""
    flag = lambda name: F.coalesce(F.col(name), F.lit(False))
    return (
        F.when(market_type == "spot", flag("spot"))
        .when(market_type == "perpetual", flag("swap") | flag("contract"))
        .when(market_type == "future", flag("future"))
        .otherwise(F.lit(False))
    )


def _active(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("is_active")).withColumn("asset", F.upper("base_asset"))


def _best(rows: DataFrame, groups: list[str], rank: Column, ties: list[str], keep: list[str]) -> DataFrame:
    """Lowest (rank, ties...) row per group, as a grouped minimum that combines on the map side."""
    order = F.struct(rank.alias("rank"), *ties)
    return rows.groupBy(*groups).agg(F.min_by(F.struct(*keep), order).alias("best")).select(*groups, "best.*")


def preferred_markets_any(registry: DataFrame) -> DataFrame:
    """One market per exchange and asset for volume: spot on coinbase, perpetuals first elsewhere."""
    return _best(
        _active(registry), ["exchange", "asset"], rank_of(C.VOLUME_MARKET_RANK), MARKET_COLUMNS, MARKET_COLUMNS
    )


def preferred_markets_perp(registry: DataFrame) -> DataFrame:
    """One perpetual per exchange and asset, by quote asset."""
    perpetuals = _active(registry).where(F.col("market_type") == "perpetual")
    return _best(perpetuals, ["exchange", "asset"], rank_of(C.PERPETUAL_QUOTE_RANK), ["symbol"], ["symbol", "market_type"])


def resolve_market(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """The market behind each requested (exchange, asset); unlisted pairs get the default USDT perpetual."""
    best = _best(
        _active(registry), ["exchange", "asset"], rank_of(C.SINGLE_MARKET_RANK), MARKET_COLUMNS, MARKET_COLUMNS
    )
    return (
        requests.join(best, ["exchange", "asset"], "left")
        .withColumn("symbol", F.coalesce("symbol", F.concat("asset", F.lit("/USDT:USDT"))))
        .withColumn("market_type", F.coalesce("market_type", F.lit("perpetual")))
    )


def reference_market(registry: DataFrame, assets: DataFrame) -> DataFrame:
    """The one (exchange, market) that carries prices for an asset across exchanges."""
    best = _best(
        _active(registry),
        ["asset"],
        rank_of(C.REFERENCE_MARKET_RANK),
        ["exchange", "symbol", "market_type"],
        ["exchange", "symbol", "market_type"],
    )
    return (
        assets.join(best, "asset", "left")
        .withColumn("symbol", F.coalesce("symbol", F.concat("asset", F.lit("/USDT:USDT"))))
        .withColumn("market_type", F.coalesce("market_type", F.lit("perpetual")))
        .withColumn("exchange", F.coalesce("exchange", F.lit("binance")))
    )


def _is_active(active: str = "active") -> Column:
    return F.coalesce(F.col(active), F.lit(True))


def _catalogue_assets(catalogue: DataFrame) -> DataFrame:
    return catalogue.withColumn("asset", F.upper(F.coalesce("base", F.lit("")))).withColumn(
        "quote_key", F.upper(F.coalesce("quote", F.lit("")))
    )


CATALOGUE_FIELDS = ["symbol", "id", "base", "quote"]


def usdt_perpetual_pick(catalogue: DataFrame) -> DataFrame:
    """First active USDT perpetual per exchange and asset, in catalogue order (`seq`)."""
    fits = market_type_match(F.lit("perpetual")) & _is_active() & (F.col("quote_key") == "USDT")
    return _best(_catalogue_assets(catalogue).where(fits), ["exchange", "asset"], F.col("seq"), [], CATALOGUE_FIELDS)


def spot_pick(catalogue: DataFrame) -> DataFrame:
    """Active spot market per exchange and asset, by quote priority and then catalogue order."""
    priority = F.array_position(F.array(*[F.lit(q) for q in C.SPOT_QUOTE_PRIORITY]), F.col("quote_key"))
    fits = market_type_match(F.lit("spot")) & _is_active() & F.col("quote_key").isin(C.SPOT_QUOTE_PRIORITY)
    return _best(_catalogue_assets(catalogue).where(fits), ["exchange", "asset"], priority, ["seq"], CATALOGUE_FIELDS)


def resolve_symbol(catalogue: DataFrame, requests: DataFrame) -> DataFrame:
    """The catalogue market meant by each request (exchange, symbol, market_type).

    An exact symbol of the right type wins; else any spelling of symbol, id or base+quote, active markets first,
    then catalogue order. Requests that match nothing keep NULL and an error message.
    """
    spelled = (
        catalogue.withColumn(
            "alias_key",
            F.explode(
                F.array_distinct(
                    F.array(
                        X.symbol_key(F.coalesce("symbol", F.lit(""))),
                        X.symbol_key(F.coalesce("id", F.lit(""))),
                        X.symbol_key(F.concat(F.coalesce("base", F.lit("")), F.coalesce("quote", F.lit("")))),
                    )
                )
            ),
        )
        .withColumnRenamed("symbol", "fetch_symbol")
        .withColumnRenamed("base", "base_asset")
        .withColumnRenamed("quote", "quote_asset")
    )
    wanted = requests.select(*C.MARKET_KEY).distinct().withColumn("alias_key", X.symbol_key(F.col("symbol")))
    candidates = wanted.join(spelled, ["exchange", "alias_key"]).where(market_type_match(F.col("market_type")))
    inexact = (F.col("fetch_symbol") != F.col("symbol")).cast("int")
    # an exact symbol is taken whether it is active or not
    inactive = F.when(inexact == 0, F.lit(0)).otherwise((~_is_active()).cast("int"))
    chosen = candidates.groupBy(*C.MARKET_KEY).agg(
        F.min_by(
            F.struct(
                "fetch_symbol",
                F.coalesce("base_asset", F.lit("")).alias("base_asset"),
                F.coalesce("quote_asset", F.lit("")).alias("quote_asset"),
            ),
            F.struct(inexact.alias("inexact"), inactive.alias("inactive"), "seq"),
        ).alias("m")
    )
    error = F.when(
        F.col("m").isNull(),
        F.concat(
            F.lit("No market for symbol "), F.col("symbol"), F.lit(" of type "), F.col("market_type"),
            F.lit(" at "), F.col("exchange"),
        ),
    )
    return (
        requests.join(chosen, C.MARKET_KEY, "left")
        .withColumn("error_message", error)
        .select(*requests.columns, "m.fetch_symbol", "m.base_asset", "m.quote_asset", "error_message")
    )


def normalize_selection(requests: DataFrame) -> DataFrame:
    """Cleans requested (asset, exchange, interval) values; anything unknown falls back to BTC, binance, 1h."""


    def stripped(column: str, default: str) -> Column:
        return F.regexp_replace(F.coalesce(column, F.lit(default)), WHITE_ENDS, "")

    asset = F.upper(stripped("asset", "BTC"))
    exchange = F.lower(stripped("exchange", "binance"))
    interval = stripped("interval", "1h")
    kept = [c for c in requests.columns if c not in ("asset", "exchange", "interval")]
    return requests.select(
        *kept,
        F.when(asset.rlike(C.ASSET_PATTERN), asset).otherwise(F.lit("BTC")).alias("asset"),
        F.when(exchange.isin(C.SELECTION_EXCHANGES), exchange).otherwise(F.lit("binance")).alias("exchange"),
        F.when(interval.isin(C.SELECTION_INTERVALS), interval).otherwise(F.lit("1h")).alias("interval"),
    )


def limit_per_group(rows: DataFrame, groups: list[str], order: list, limit: int) -> DataFrame:
    """The first `limit` rows of each group; tasks drop surplus rows before the shuffle."""
    position = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return rows.withColumn("_position", position).where(F.col("_position") <= limit).drop("_position")
