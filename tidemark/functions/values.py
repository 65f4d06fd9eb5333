"""Value rules shared by the dashboard series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as C

PRICE = "decimal(30,18)"
QUANTITY = "decimal(28,8)"
NOTIONAL = "decimal(38,14)"


def price_times(price: Column, amount: Column) -> Column:
    """Price times amount to all 14 digits of a notional; NULL where it has over 24 digits before the point.

    The exact product of the two types would need 59 digits, so it is put together from products of their parts.
    """
    price, amount = price.cast(PRICE), amount.cast(QUANTITY)
    units, lots = F.floor(price).try_cast("decimal(12,0)"), F.floor(amount).try_cast("decimal(17,0)")
    fraction, rest = (price - F.floor(price)).cast("decimal(18,18)"), (amount - F.floor(amount)).cast("decimal(8,8)")
    whole = (units * amount.try_cast("decimal(25,8)")).try_cast("decimal(37,14)")
    part = (fraction * lots).cast("decimal(37,20)") + (fraction * rest).cast("decimal(27,20)")
    return (whole + part.try_cast("decimal(32,14)")).try_cast(NOTIONAL)


def bar_notional() -> Column:
    """Quote volume of a bar; without one, close x volume."""
    product = price_times(F.col("close"), F.col("volume"))
    return F.coalesce(
        F.col("quote_volume").cast(NOTIONAL), product, F.col("volume").cast(NOTIONAL), F.lit(0).cast(NOTIONAL)
    )


def liquidation_notional() -> Column:
    """Cost of a liquidation; without one, price x amount."""
    product = price_times(F.col("price"), F.col("amount"))
    return F.coalesce(F.col("cost").cast(NOTIONAL), product, F.lit(0).cast(NOTIONAL))


def open_interest_number() -> Column:
    """Open interest value; exchanges without a value report the contract amount instead."""
    return F.coalesce(
        F.col("open_interest_value").cast(QUANTITY), F.col("open_interest_amount").cast(QUANTITY), F.lit(0).cast(QUANTITY)
    )


def notional_of_sides(sides: list[str]) -> Column:
    """`notional` of events on the given sides (lower case); a NULL or unknown side counts as zero."""
    return F.when(F.col("side").isin(sides), F.col("notional")).otherwise(F.lit(0).cast(NOTIONAL))


def rank_of(rules: list[tuple]) -> Column:
    """Rank from a rule table of (exchange, market_type, quote_asset, rank); the first match wins."""
    out = F.lit(C.UNRANKED)
    for exchange, market_type, quote, rank in reversed(rules):
        match = F.lit(True)
        for name, wanted in (("exchange", exchange), ("market_type", market_type), ("quote_asset", quote)):
            if wanted is not None:
                match = match & F.coalesce(F.col(name) == wanted, F.lit(False))
        out = F.when(match, F.lit(rank)).otherwise(out)
    return out
