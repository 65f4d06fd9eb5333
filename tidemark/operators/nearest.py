"""Nearest-in-time joins.

For each left time, the right point with the smallest distance; on a tie the earlier one; before the first point
the first, after the last point the last. Times are epoch seconds (BIGINT).

Both sides are cut into spans of time and one window pass runs per (key, span), so a key with a large share of all
rows spreads over many tasks. A span also receives the closest right point before it and after it, taken from a
summary with one row per key and span, so results do not depend on where the cuts fall. Several right series are
placed in the same pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400


def _point(points: DataFrame, keys: list[str]) -> Column:
    values = [c for c in points.columns if c not in (*keys, "time")]
    return F.struct("time", *values)


def _carried(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Per span that holds left rows: the last right point of earlier spans and the first of later ones, as rows."""
    ends = []
    for name in names:
        at = F.when(F.col(name).isNotNull(), F.col("time"))
        ends += [F.min_by(name, at).alias(f"first_{name}"), F.max_by(name, at).alias(f"last_{name}")]
    spans = rows.groupBy(*keys, "span").agg(F.max("is_left").alias("has_left"), *ends)
    before = Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    # a descending window looks ahead; a frame that ends at the last row would rescan it for every row
    after = Window.partitionBy(*keys).orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, -1)
    for name in names:
        spans = spans.withColumn(f"prev_{name}", F.last(f"last_{name}", ignorenulls=True).over(before))
    for name in names:
        spans = spans.withColumn(f"next_{name}", F.last(f"first_{name}", ignorenulls=True).over(after))
    types = {n: rows.schema[n].dataType for n in names}
    packed = F.array(
        *[
            F.struct(
                point["time"].alias("time"),
                *[(point if n == name else F.lit(None).cast(types[n])).alias(n) for n in names],
            )
            for name, point in [(n, F.col(f"{s}_{n}")) for n in names for s in ("prev", "next")]
        ]
    )
    return (
        spans.where(F.col("has_left") == 1)
        .select(*keys, "span", F.explode(packed).alias("c"))
        .where(F.col("c.time").isNotNull())
        .select(*keys, "span", F.col("c.time").alias("time"), F.lit(0).alias("is_left"), *[F.col(f"c.{n}").alias(n) for n in names])
    )


def stack_points(series: dict[str, DataFrame], keys: list[str], unique: bool = False) -> DataFrame:
    """Several series as one table: a row per key and time, a struct column (time, values) per series.

    Repeated times of a series keep one point, the smallest by its values. One shuffle serves all series; with
    unique=True (times known to be distinct per key and series) rows are only stacked and nothing is shuffled.
    """
    types = {n: points.select(_point(points, keys).alias("p")).schema["p"].dataType for n, points in series.items()}
    parts = []
    for name, points in series.items():
        cells = [(_point(points, keys) if n == name else F.lit(None).cast(types[n])).alias(n) for n in series]
        parts.append(points.select(*keys, "time", *cells))
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked if unique else stacked.groupBy(*keys, "time").agg(*[F.min(n).alias(n) for n in series])


def align(
    left: DataFrame, points: DataFrame, names: list[str], keys: list[str], span_seconds: int | None = DAY
) -> DataFrame:
    """Left rows with, per series, a struct column holding its nearest point (NULL when the key has none).

    left needs `time` and the keys, with times distinct per key or known to be few; `points` comes from
    `stack_points`. Pass span_seconds=None only where every key is known to be short, such as newest-N series.
    """
    span = F.lit(0).cast("bigint") if span_seconds is None else F.floor(F.col("time") / F.lit(span_seconds))
    left_values = [c for c in left.columns if c not in (*keys, "time")]
    types = {n: points.schema[n].dataType for n in names}
    row = F.struct(F.lit(1).alias("_"), *left_values)
    left_rows = left.select(
        *keys, "time", F.lit(1).alias("is_left"), row.alias("row"), *[F.lit(None).cast(types[n]).alias(n) for n in names]
    )
    no_row = F.lit(None).cast(left_rows.schema["row"].dataType).alias("row")
    right_rows = points.select(*keys, "time", F.lit(0).alias("is_left"), no_row, *names)
    rows = left_rows.unionByName(right_rows).withColumn("span", span)
    if span_seconds is not None:
        rows = rows.unionByName(_carried(rows.drop("row"), keys, names), allowMissingColumns=True)

    # right rows sort before left rows of the same time in both directions, so an exact match is seen from both
    forward = Window.partitionBy(*keys, "span").orderBy("time", "is_left")
    backward = Window.partitionBy(*keys, "span").orderBy(F.col("time").desc(), "is_left")
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    found = rows.select(
        *keys,
        "time",
        "is_left",
        "row",
        *[F.last(n, ignorenulls=True).over(forward.rowsBetween(*up_to_here)).alias(f"prev_{n}") for n in names],
        *[F.last(n, ignorenulls=True).over(backward.rowsBetween(*up_to_here)).alias(f"next_{n}") for n in names],
    ).where(F.col("is_left") == 1)

    def pick(name: str) -> Column:
        earlier, later = F.col(f"prev_{name}"), F.col(f"next_{name}")
        closer = (later["time"] - F.col("time")) < (F.col("time") - earlier["time"])
        return F.when(earlier.isNull() | F.coalesce(closer, F.lit(False)), later).otherwise(earlier).alias(name)

    return found.select(*keys, "time", *[F.col(f"row.{c}").alias(c) for c in left_values], *[pick(n) for n in names])


def within(point: str, tolerance: Column) -> Column:
    """The point if it lies within the tolerance (inclusive, seconds) of the row's time, else NULL."""
    distance = F.abs(F.col(point)["time"] - F.col("time"))
    return F.when(distance.cast("double") <= tolerance.cast("double"), F.col(point))


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    tolerance: Column | None = None,
    span_seconds: int | None = DAY,
    unique_left: bool = False,
    unique_right: bool = False,
) -> DataFrame:
    """Left rows with the nearest right point as `nearest`, optionally only within a tolerance.

    Points are searched once per distinct left time and joined back, so a window never holds more than the seconds
    of a span, however many left rows share a time (the join back is split by adaptive skew handling). Pass
    unique_left=True when left times are already distinct per key. Right times repeated within a key keep one
    point (smallest values); unique_right=True says there are none, which saves a shuffle.
    """
    points = stack_points({"nearest": right}, keys, unique=unique_right)
    if unique_left:
        out = align(left, points, ["nearest"], keys, span_seconds)
    else:
        times = left.select(*keys, "time").distinct()
        out = left.join(align(times, points, ["nearest"], keys, span_seconds), [*keys, "time"], "left")
    return out if tolerance is None else out.withColumn("nearest", within("nearest", tolerance))


def nearest_within_buckets(left: DataFrame, right: DataFrame, keys: list[str], tolerance: int) -> DataFrame:
    """`nearest_join` within a tolerance of whole seconds (inclusive), for long histories: both sides are cut into buckets of
    the tolerance, and a left row is compared with the points of its own bucket and the two beside it.

    Each side is scanned once. Points are first put together by key and bucket, one for each time (the smallest by its
    values); a right bucket stands in three lists, so a left row meets one list by an equi-join. A list holds at most three
    times the tolerance in points, one a second, whatever the history's length or how many left rows share a bucket. On a tie
    the earlier point is taken.
    """
    width = max(1, tolerance)
    bucket = F.floor(F.col("time") / F.lit(width))
    once = right.groupBy(*keys, "time").agg(F.min(_point(right, keys)).alias("point"))
    spread = F.explode(F.array(*[F.lit(i).cast("bigint") for i in (-1, 0, 1)]))
    lists = (
        once.select(*keys, bucket.alias("own"), "point", spread.alias("by"))
        .groupBy(*keys, (F.col("own") + F.col("by")).alias("bucket"))
        .agg(F.array_sort(F.collect_list("point")).alias("points"))
    )
    joined = left.withColumn("bucket", bucket).join(lists, [*keys, "bucket"], "left")
    near = F.filter("points", lambda p: F.abs(p["time"] - F.col("time")) <= F.lit(tolerance))
    ranked = F.transform(near, lambda p: F.struct(F.abs(p["time"] - F.col("time")).alias("distance"), p.alias("point")))
    return joined.withColumn("nearest", F.array_min(ranked)["point"]).select(*left.columns, "nearest")
