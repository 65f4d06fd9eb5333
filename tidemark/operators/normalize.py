"""Raw exchange payloads to typed rows.

Landed rows carry the stream key, `fetch_seq` (arrival order within the stream) and `payload` (JSON text).
Every function works on all streams at once. "Last row wins" is a grouped max_by on fetch_seq, which combines
on the map side, so a key with very many copies reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import text as X
from tidemark.functions import timegrid as G
from tidemark.functions.values import NOTIONAL, PRICE, QUANTITY, price_times

RATE = "decimal(20,10)"
MONEY = "decimal(38,10)"


def _millis(text: Column) -> Column:
    return X.number(text, "decimal(38,6)").cast("bigint")


def _time(text: Column) -> Column:
    return F.timestamp_millis(_millis(text))


def _once(rows: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Adds a parsed payload as a generated column. Filters on its fields are not moved below a generator, so the
    JSON is parsed once per row instead of once per filter and field."""
    return rows.select("*", F.explode(F.array(parsed)).alias(name))


def _parsed(rows: DataFrame, fields: list[str], nested: str = "") -> DataFrame:
    """Payload fields as text under `p`; JSON numbers keep their exact digits."""
    schema = ", ".join(f"`{name}` string" for name in fields) + nested
    return _once(rows, F.from_json("payload", schema), "p")


# --- candles ---------------------------------------------------------------


def decode_ohlcv(rows: DataFrame) -> DataFrame:
    """`[ms, open, high, low, close, volume]` payloads as typed columns; `malformed` marks rows that cannot be bars."""
    volume_text = F.get("cells", F.lit(5))
    typed = _once(rows, F.from_json("payload", "array<string>"), "cells").select(
        *C.STREAM_KEY,
        "fetch_seq",
        _time(F.get("cells", F.lit(0))).alias("open_time"),
        *[X.number(F.get("cells", F.lit(i)), PRICE).alias(n) for i, n in enumerate(["open", "high", "low", "close"], 1)],
        X.number(volume_text, QUANTITY).alias("volume"),
        volume_text.isNotNull().alias("has_volume"),
    )
    missing = F.lit(False)
    for name in ("open_time", "open", "high", "low", "close"):
        missing = missing | F.col(name).isNull()
    return typed.withColumn("malformed", missing | (F.col("has_volume") & F.col("volume").isNull())).drop("has_volume")


def collapse_bars(rows: DataFrame) -> DataFrame:
    """One row per stream and open time: the last one fetched, with the number of copies seen."""
    values = ["open", "high", "low", "close", "volume"]
    return rows.groupBy(*C.STREAM_KEY, "open_time").agg(
        *[F.max_by(name, "fetch_seq").alias(name) for name in values],
        F.count(F.lit(1)).alias("copies"),
    )


def bars_of(collapsed: DataFrame) -> DataFrame:
    """Bars ready for storage: closing time added, empty volume as zero, no quote volume or trade count."""
    return collapsed.select(
        *C.STREAM_KEY,
        "open_time",
        G.shift_seconds(F.col("open_time"), G.interval_seconds(F.col("bar_interval"))).alias("close_time"),
        *[F.col(name).cast(PRICE).alias(name) for name in ("open", "high", "low", "close")],
        F.coalesce(F.col("volume").cast(QUANTITY), F.lit(0).cast(QUANTITY)).alias("volume"),
        F.lit(None).cast(QUANTITY).alias("quote_volume"),
        F.lit(None).cast("bigint").alias("trade_count"),
        "copies",
    )


def repeats_of(collapsed: DataFrame) -> DataFrame:
    """Open times seen more than once; `repeats` is the number of surplus copies."""
    return collapsed.where(F.col("copies") > 1).select(
        *C.STREAM_KEY, "open_time", (F.col("copies") - 1).alias("repeats")
    )


def normalize_ohlcv(rows: DataFrame) -> DataFrame:
    """Landed candle payloads to bars, last fetched row per open time. Malformed rows are left to `decode_ohlcv`."""
    return bars_of(collapse_bars(decode_ohlcv(rows).where(~F.col("malformed"))))


# --- paging bounds -----------------------------------------------------------


def clip_pages(rows: DataFrame, plan: DataFrame, time_column: str) -> DataFrame:
    """Rows inside the requested range of their stream; the plan says which ends apply to which dataset.

    Rows without a time are kept: whether that is an error is for the dataset's own rules to say.
    """
    bounds = plan.select(*C.STREAM_KEY, "since_ms", "until_ms", "clip_lower", "clip_upper")
    at = F.unix_millis(time_column)
    below = ~F.col("clip_upper") | (at <= F.col("until_ms"))
    above = ~F.col("clip_lower") | F.col("since_ms").isNull() | (at >= F.col("since_ms"))
    return rows.join(bounds, C.STREAM_KEY).where(at.isNull() | (below & above)).select(*rows.columns)


# --- derived series ------------------------------------------------------------


def normalize_open_interest(rows: DataFrame) -> DataFrame:
    """Open interest history; rows without a timestamp are dropped."""
    fields = ["timestamp", "openInterestAmount", "openInterestValue", "baseVolume", "quoteVolume"]
    return (
        _parsed(rows, fields)
        .select(
            *C.STREAM_KEY,
            "fetch_seq",
            _time(F.col("p.timestamp")).alias("open_time"),
            X.number(F.col("p.openInterestAmount"), MONEY).alias("open_interest_amount"),
            X.number(F.col("p.openInterestValue"), MONEY).alias("open_interest_value"),
            X.number(F.col("p.baseVolume"), MONEY).alias("base_volume"),
            X.number(F.col("p.quoteVolume"), MONEY).alias("quote_volume"),
        )
        .where(F.col("open_time").isNotNull())
    )


def normalize_open_interest_amount_only(rows: DataFrame) -> DataFrame:
    """Open interest from an exchange that reports contract amounts only; value and volumes stay NULL."""
    empty = F.lit(None).cast(MONEY)
    return (
        _parsed(rows, ["ts", "openInterest"])
        .select(
            *C.STREAM_KEY,
            "fetch_seq",
            _time(F.col("p.ts")).alias("open_time"),
            X.number(F.col("p.openInterest"), MONEY).alias("open_interest_amount"),
            empty.alias("open_interest_value"),
            empty.alias("base_volume"),
            empty.alias("quote_volume"),
        )
        .where(F.col("open_time").isNotNull())
    )


def normalize_funding(rows: DataFrame) -> DataFrame:
    """Funding prints; rows without a timestamp or rate are dropped, prices come from the nested exchange record."""
    nested = ", info struct<markPrice: string, indexPrice: string, nextFundingTime: string>"
    following = _millis(F.col("p.info.nextFundingTime"))
    return (
        _parsed(rows, ["timestamp", "fundingRate"], nested)
        .select(
            *C.STREAM_KEY,
            "fetch_seq",
            _time(F.col("p.timestamp")).alias("funding_time"),
            X.number(F.col("p.fundingRate"), "decimal(25,15)").alias("funding_rate"),
            X.number(F.col("p.info.markPrice"), MONEY).alias("mark_price"),
            X.number(F.col("p.info.indexPrice"), MONEY).alias("index_price"),
            F.when(following != 0, F.timestamp_millis(following)).alias("next_funding_time"),
        )
        .where(F.col("funding_time").isNotNull() & F.col("funding_rate").isNotNull())
    )


def _last_per_time(rows: DataFrame, required: str) -> DataFrame:
    kept = rows.where(F.col("open_time").isNotNull() & F.col(required).isNotNull())
    values = [c for c in rows.columns if c not in (*C.STREAM_KEY, "open_time", "fetch_seq")]
    return kept.groupBy(*C.STREAM_KEY, "open_time").agg(*[F.max_by(c, "fetch_seq").alias(c) for c in values])


def normalize_long_short(rows: DataFrame) -> DataFrame:
    """Long/short account ratios, last fetched row per timestamp."""
    fields = ["timestamp", "longShortRatio", "longAccount", "shortAccount"]
    typed = _parsed(rows, fields).select(
        *C.STREAM_KEY,
        "fetch_seq",
        _time(F.col("p.timestamp")).alias("open_time"),
        X.number(F.col("p.longShortRatio"), RATE).alias("long_short_ratio"),
        X.number(F.col("p.longAccount"), RATE).alias("long_account"),
        X.number(F.col("p.shortAccount"), RATE).alias("short_account"),
    )
    return _last_per_time(typed, "long_short_ratio")


def normalize_taker(rows: DataFrame) -> DataFrame:
    """Taker buy and sell volumes, last fetched row per timestamp."""
    fields = ["timestamp", "buySellRatio", "buyVol", "sellVol"]
    typed = _parsed(rows, fields).select(
        *C.STREAM_KEY,
        "fetch_seq",
        _time(F.col("p.timestamp")).alias("open_time"),
        X.number(F.col("p.buyVol"), QUANTITY).alias("buy_volume"),
        X.number(F.col("p.sellVol"), QUANTITY).alias("sell_volume"),
        X.number(F.col("p.buySellRatio"), RATE).alias("buy_sell_ratio"),
    )
    return _last_per_time(typed, "buy_sell_ratio")


def normalize_liquidations(rows: DataFrame) -> DataFrame:
    """Liquidations read by request; a zero or missing amount falls back to the contract count."""
    fields = ["timestamp", "side", "price", "amount", "contracts", "cost"]
    amount = X.number(F.col("p.amount"), QUANTITY)
    return (
        _parsed(rows, fields)
        .select(
            *C.STREAM_KEY,
            "fetch_seq",
            _time(F.col("p.timestamp")).alias("liquidation_time"),
            F.col("p.side").alias("side"),
            X.number(F.col("p.price"), PRICE).alias("price"),
            F.coalesce(F.when(amount != 0, amount), X.number(F.col("p.contracts"), QUANTITY)).alias("amount"),
            X.number(F.col("p.cost"), NOTIONAL).alias("cost"),
            F.col("payload").alias("raw"),
        )
        .where(F.col("liquidation_time").isNotNull())
    )


# --- live liquidation payloads -----------------------------------------------------


def stream_jobs(jobs: DataFrame) -> DataFrame:
    """One job per stream symbol; when two jobs share a symbol the last job name is used."""
    carried = ["job_id", "job_name", *C.STREAM_KEY]
    return (
        jobs.select(X.checked_native_symbol(F.col("symbol")).alias("native_symbol"), *[c for c in carried if c in jobs.columns])
        .groupBy("native_symbol")
        .agg(F.max_by(F.struct(*[c for c in carried if c in jobs.columns]), "job_name").alias("job"))
        .select("native_symbol", "job.*")
    )


def decode_force_orders(rows: DataFrame, jobs: DataFrame) -> DataFrame:
    """Live force-order messages (column `raw`) to liquidation events of known jobs.

    The order is read as a map because its keys `s` and `S` differ only in case. A `data` object wraps the message;
    anything else under that name is ignored.
    """
    parsed = F.from_json("raw", "data struct<o: map<string,string>, E: string>, o map<string,string>, E string")
    body = F.coalesce(F.col("m.data"), F.struct(F.col("m.o").alias("o"), F.col("m.E").alias("E")))
    opened = _once(_once(rows, parsed, "m"), body, "body")

    def field(key: str) -> Column:
        return F.try_element_at("body.o", F.lit(key))

    def amount_of(*keys: str) -> Column:
        return X.first_non_zero(*[X.number(field(k), "decimal(38,18)") for k in keys])

    order_ms = _millis(field("T"))
    event_ms = F.coalesce(F.when(order_ms != 0, order_ms), _millis(F.col("body.E")))
    decoded = opened.where(F.col("body.o").isNotNull()).select(
        *[c for c in rows.columns if c != "raw"],
        "raw",
        F.upper(field("s")).alias("native_symbol"),
        F.timestamp_millis(event_ms).alias("liquidation_time"),
        field("S").alias("side"),
        amount_of("ap", "p").try_cast(PRICE).alias("price"),
        amount_of("z", "l", "q").try_cast(QUANTITY).alias("amount"),
    ).where(F.col("liquidation_time").isNotNull())
    known = decoded.join(stream_jobs(jobs), "native_symbol")
    return known.withColumn("cost", price_times(F.col("price"), F.col("amount")))


# --- routing ---------------------------------------------------------------------


def route_datasets(rows: DataFrame) -> DataFrame:
    """Adds the payload family that handles each source dataset, NULL for an unknown one."""
    known = F.create_map(*[F.lit(x) for pair in C.DATASET_FAMILY.items() for x in pair])
    return rows.withColumn("family", F.try_element_at(known, F.col("source_dataset")))


def split_by_family(rows: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """One branch per payload family, and the rows no branch handles."""
    routed = route_datasets(rows)
    families = sorted(set(C.DATASET_FAMILY.values()))
    return {name: routed.where(F.col("family") == name) for name in families}, routed.where(F.col("family").isNull())
