"""What a fact table holds, by stream and day, and which of its days a newest-N question needs.

A summary row covers the rows of one stream and day (events: one hour of a day): first and last time, last close, how many
rows, last ingest, and for events a mask of the minutes that hold any. All of it merges, so an append adds the rows of its own
batch and readers merge. High-water marks and status come from the summary alone.

Newest-N series walk back: for each group the days from the newest on are taken until they surely hold N rows, times or
buckets, and the fact table is joined with these days, which prunes its `day` partitions when the query runs. A stream that
ended years ago costs its own last days, not the days since. Nothing is cut by this: days are only left out when newer ones
hold N already.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as C

DAY = "day"
STREAM_DAY = [*C.STREAM_KEY, DAY, "hour"]
MERGED = {
    "first_time": F.min,
    "last_time": F.max,
    "last_close": F.max,
    "row_count": F.sum,
    "last_ingested_at": F.max,
    "minutes": F.bit_or,
}
SCHEMA = (
    "exchange string, symbol string, market_type string, bar_interval string, source_dataset string, day date, hour int, "
    "first_time timestamp, last_time timestamp, last_close timestamp, row_count bigint, last_ingested_at timestamp, minutes bigint"
)
#: The bucket's first minute stands for a bucket of five; bits 0, 5, .., 55.
_FIVES = sum(1 << (5 * i) for i in range(12))


def is_summary(rows: DataFrame) -> bool:
    return {"row_count", "minutes"} <= set(rows.columns)


def summarise(
    rows: DataFrame, time: str, dataset: str | None = None, close: str | None = None, also: list[str] = ()
) -> DataFrame:
    """The summary of fact rows. Series without an interval are events; `dataset` names the rows if no column does. `also`
    are further columns to tell rows apart by."""
    events = "bar_interval" not in rows.columns
    at = F.col(time).cast("timestamp")
    keyed = rows.select(
        *C.MARKET_KEY,
        (F.lit("") if events else F.col("bar_interval")).alias("bar_interval"),
        (F.lit(dataset) if dataset is not None else F.col("source_dataset")).alias("source_dataset"),
        F.to_date(at).alias(DAY),
        (F.hour(at) if events else F.lit(0)).alias("hour"),
        at.alias("at"),
        (at if close is None else F.col(close).cast("timestamp")).alias("close"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        *also,
    )
    minute = F.expr("shiftleft(1L, minute(at))") if events else F.lit(None).cast("bigint")
    return keyed.groupBy(*STREAM_DAY, *also).agg(
        F.min("at").alias("first_time"),
        F.max("at").alias("last_time"),
        F.max("close").alias("last_close"),
        F.count(F.lit(1)).alias("row_count"),
        F.max("ingested_at").alias("last_ingested_at"),
        F.bit_or(minute).alias("minutes"),
    )


def merge(days: DataFrame) -> DataFrame:
    """One row for each stream, day and hour."""
    return days.groupBy(*STREAM_DAY).agg(*[how(c).alias(c) for c, how in MERGED.items()])


# --- walking back -------------------------------------------------------------------------


def minutes_seen(mask: Column) -> Column:
    return F.bit_count(mask)


def fives_seen(mask: Column) -> Column:
    """Five-minute buckets of an hour that hold a set minute."""
    near = reduce(Column.bitwiseOR, [F.shiftrightunsigned(mask, i) for i in range(5)])
    return F.bit_count(near.bitwiseAND(F.lit(_FIVES).cast("bigint")))


def buckets_seen(mask: Column, interval: Column) -> Column:
    """Liquidation buckets of an hour, as wide as charts of an interval show them."""
    one_hour = F.when(mask != 0, 1).otherwise(0)
    return F.when(interval == "1m", minutes_seen(mask)).when(interval == "5m", fives_seen(mask)).otherwise(one_hour)


def rows_by_day(days: DataFrame, groups: list[str]) -> DataFrame:
    """How many rows the streams of a group have on a day."""
    return days.groupBy(*groups, DAY).agg(F.sum("row_count").alias("held"))


def times_by_day(days: DataFrame, groups: list[str]) -> DataFrame:
    """How many distinct bar times a group has on a day at least: those of its fullest stream."""
    return days.groupBy(*groups, DAY).agg(F.max("row_count").alias("held"))


def minutes_by_day(days: DataFrame, groups: list[str]) -> DataFrame:
    """How many distinct minutes the events of a group take on a day."""
    hours = days.groupBy(*groups, DAY, "hour").agg(F.bit_or("minutes").alias("minutes"))
    return hours.groupBy(*groups, DAY).agg(F.sum(minutes_seen(F.col("minutes"))).alias("held"))


def buckets_by_day(days: DataFrame, groups: list[str]) -> DataFrame:
    """How many buckets the events of a group, which has a `bar_interval`, fill on a day."""
    hours = days.groupBy(*groups, DAY, "hour").agg(F.bit_or("minutes").alias("minutes"))
    return hours.groupBy(*groups, DAY).agg(F.sum(buckets_seen(F.col("minutes"), F.col("bar_interval"))).alias("held"))


def needed_days(held: DataFrame, groups: list[str], limit: Column | int) -> DataFrame:
    """The days of which some group needs rows for its newest `limit`: those whose newer days hold fewer."""
    newer = Window.partitionBy(*groups).orderBy(F.col(DAY).desc()).rowsBetween(Window.unboundedPreceding, -1)
    walked = held.withColumn("newer", F.coalesce(F.sum("held").over(newer), F.lit(0)))
    return walked.where(F.col("newer") < limit).select(DAY).distinct()


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """The rows of some days; the days are few, so they prune the partitions of a table that has `day`."""
    return rows.join(days, DAY, "left_semi")
