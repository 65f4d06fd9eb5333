"""Interval strings, the epoch bar grid, and per-interval settings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as C

def _amount_times_unit(interval: Column, units: dict[str, int], unit: Column) -> Column:
    """Whole number before the last character times the seconds of that unit; NULL when either does not parse."""
    amount = F.substr(interval, F.lit(1), F.length(interval) - 1).try_cast("bigint")
    factor = F.lit(None).cast("bigint")
    for suffix, seconds in reversed(units.items()):
        factor = F.when(unit == suffix, F.lit(seconds).cast("bigint")).otherwise(factor)
    return amount * factor


def interval_seconds_or_null(interval: Column) -> Column:
    """Seconds of an interval such as 5m or 1w (suffix is case-sensitive); NULL when it is not a positive length."""
    seconds = _amount_times_unit(interval, C.INTERVAL_UNIT_SECONDS, F.right(interval, F.lit(1)))
    return F.when(seconds > 0, seconds)


def interval_seconds(interval: Column) -> Column:
    """Seconds of an interval; raises on anything that does not parse."""
    return F.when(interval.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce(
            interval_seconds_or_null(interval),
            F.raise_error(F.concat(F.lit("Unknown interval "), interval)).cast("bigint"),
        )
    )


def cadence_seconds(dataset: Column, interval: Column) -> Column:
    """How often a stream is polled; unlike interval_seconds the suffix is case-insensitive and weeks are unknown."""
    unit = F.lower(F.right(interval, F.lit(1)))
    parsed = _amount_times_unit(interval, C.CADENCE_UNIT_SECONDS, unit)
    by_interval = F.greatest(
        F.lit(C.CADENCE_FLOOR_SECONDS).cast("bigint"),
        F.coalesce(parsed, F.lit(C.CADENCE_FALLBACK_SECONDS).cast("bigint")),
    )
    out = by_interval
    for name, seconds in C.DATASET_CADENCE_SECONDS.items():
        out = F.when(dataset == name, F.lit(seconds).cast("bigint")).otherwise(out)
    return out


def shift_seconds(ts: Column, seconds: Column) -> Column:
    """Timestamp plus a number of seconds, keeping microseconds."""
    return F.timestamp_micros(F.unix_micros(ts) + seconds * F.lit(1_000_000))


def grid_floor(ts: Column, seconds: Column) -> Column:
    """Start of the bar holding ts on the epoch grid (weeks start on Thursday)."""
    millis = seconds * F.lit(1000)
    now_ms = F.unix_millis(ts)
    return F.timestamp_millis(now_ms - F.pmod(now_ms, millis))


def floor_closed_bar(now: Column, seconds: Column) -> Column:
    """Open time of the last bar that is closed at `now`."""
    return shift_seconds(grid_floor(now, seconds), -seconds)


def chart_limit(interval: Column) -> Column:
    """Number of bars a chart shows for an interval."""
    out = F.lit(C.CHART_ROWS_OTHER)
    for name, rows in reversed(C.CHART_ROWS.items()):
        out = F.when(interval == name, F.lit(rows)).otherwise(out)
    return out


def series_interval(interval: Column) -> Column:
    """Interval of the derived series behind a chart: there is no 1m series, so 1m reads 5m."""
    return F.when(interval == "1m", F.lit("5m")).otherwise(interval)


def liquidation_bucket(ts: Column, interval: Column) -> Column:
    """Bucket start of a liquidation: the minute, the five minutes, or the hour."""
    width = F.when(interval == "1m", F.lit(60)).when(interval == "5m", F.lit(300)).otherwise(F.lit(3600))
    return grid_floor(ts, width.cast("bigint"))


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds, rounded down."""
    return F.unix_seconds(ts)


def local_time(ts: Column, zone: str = C.DISPLAY_TIME_ZONE) -> Column:
    """Wall-clock time in the display zone."""
    return F.from_utc_timestamp(ts, zone)


def local_time_text(ts: Column, zone: str = C.DISPLAY_TIME_ZONE) -> Column:
    """Short wall-clock text in the display zone, such as `Jan 31, 08:05 AM`."""
    return F.date_format(local_time(ts, zone), "MMM dd, hh:mm a")


def iso_text(ts: Column) -> Column:
    """ISO text of a UTC time; fractions only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.pmod(F.unix_micros(ts), F.lit(1_000_000)) == 0, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def as_timestamp(value: str | None) -> Column:
    """A literal UTC time, or a typed NULL."""
    return F.lit(value).cast("timestamp")
