"""Symbols, job names and JSON fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def symbol_key(symbol: Column) -> Column:
    """Letters and digits of a symbol in upper case, for comparison across spellings."""
    return F.regexp_replace(F.upper(symbol), "[^A-Z0-9]", "")


def native_symbol(symbol: Column) -> Column:
    """Stream symbol of a market, `BTC/USDT:USDT` -> `BTCUSDT`; NULL when base or quote is empty."""
    base = F.split_part(symbol, F.lit("/"), F.lit(1))
    tail = F.substr(symbol, F.length(base) + F.lit(2))
    quote = F.when(tail == "", F.lit("USDT")).otherwise(F.split_part(tail, F.lit(":"), F.lit(1)))
    return F.when((base != "") & (quote != ""), F.upper(F.concat(base, quote)))


def checked_native_symbol(symbol: Column) -> Column:
    """Stream symbol of a market; raises when it cannot be built."""
    return F.coalesce(
        native_symbol(symbol),
        F.raise_error(F.concat(F.lit("Cannot convert job symbol to a stream symbol: "), symbol)).cast("string"),
    )


def job_part(value: Column) -> Column:
    """One part of a job name: lower case, runs of other characters as one underscore."""
    cleaned = F.lower(F.btrim(F.regexp_replace(value, "[^a-zA-Z0-9]+", "_"), F.lit("_")))
    return F.when(cleaned == "", F.lit("unknown")).otherwise(cleaned)


def job_name(
    exchange: Column, symbol: Column, market_type: Column, interval: Column, dataset: Column, market_id: Column
) -> Column:
    """Readable job name that ends in a short hash of the raw parts."""
    raw_id = F.coalesce(market_id, F.lit(""))
    digest = F.sha1(F.concat_ws("|", exchange, symbol, market_type, interval, dataset, raw_id))
    return F.concat_ws(
        "_",
        job_part(exchange),
        job_part(symbol),
        F.when(raw_id != "", job_part(raw_id)),
        job_part(market_type),
        job_part(interval),
        job_part(dataset),
        F.substring(digest, 1, 8),
    )


def number(text: Column, sql_type: str) -> Column:
    """Exact number from JSON text, NULL when it is not one."""
    return text.try_cast(sql_type)


def first_non_zero(*values: Column) -> Column:
    """First value that is neither NULL nor zero."""
    return F.coalesce(*[F.when(value != 0, value) for value in values])
