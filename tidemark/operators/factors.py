"""Factors on time-aligned series: ratios, per-exchange matrices, snapshots, bounds.

Dashboard series are newest-N lists (at most 1,440 points per asset, interval and exchange), so aligning them needs
no spans. The operators read their series more than once: pass a chart and derivatives that were settled (written
once, see sources/staging.py), as `settled_inputs` does, and each fact table is scanned once. `oi_volume_ratio` also
serves whole histories and takes a span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.operators import nearest as N
from tidemark.sources.staging import settle

SELECTION = ["asset", "bar_interval"]


def settled_inputs(chart: DataFrame, derivatives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two dashboard bundles, written once and in one job, so that all factors of a refresh read small results."""
    both = chart.withColumn("bundle", F.lit("chart")).unionByName(
        derivatives.withColumn("bundle", F.lit("derivatives")), allowMissingColumns=True
    )
    stored = settle(both, "bundles")
    return (
        stored.where(F.col("bundle") == "chart").select(*chart.columns),
        stored.where(F.col("bundle") == "derivatives").select(*derivatives.columns),
    )


BREAKDOWN_SERIES = {
    "volume": ("volumeBreakdown", ["value"]),
    "open_interest": ("openInterestBreakdown", ["value"]),
    "long_short": ("longShortRatioBreakdown", ["value"]),
    "taker": ("takerBuySellBreakdown", ["buy_volume", "sell_volume", "buy_sell_ratio"]),
    "liquidation": ("liquidationBreakdown", ["long_value", "short_value", "total_value", "event_count"]),
    "funding": ("fundingRateBreakdown", ["value"]),
}
POINT_SERIES = {
    "mark": ("markPrice", ["value"]),
    "index": ("indexPrice", ["value"]),
    "open_interest": ("openInterest", ["value"]),
    "long_short": ("longShortRatio", ["value"]),
    "taker": ("takerBuySell", ["buy_volume", "sell_volume", "buy_sell_ratio"]),
    "funding": ("fundingRate", ["value"]),
    "liquidation": ("liquidations", ["long_value", "short_value", "total_value", "event_count"]),
}


def candles_of(chart: DataFrame, groups: list[str] = SELECTION) -> DataFrame:
    """The candles of a chart bundle."""
    return chart.where(F.col("series") == "candles").select(*groups, "time", "close", "volume")


def series_of(
    chart: DataFrame, derivatives: DataFrame, wanted: dict[str, tuple[str, list[str]]], keys: list[str]
) -> dict[str, DataFrame]:
    """Named series of the two bundles, cut to their keys, time and values."""
    of_chart = {"markPrice", "indexPrice", "volumeBreakdown"}
    out = {}
    for name, (series, values) in wanted.items():
        bundle = chart if series in of_chart else derivatives
        out[name] = bundle.where(F.col("series") == series).select(*keys, "time", *values)
    return out


def _step(points: Column, first: Column, last: Column) -> Column:
    gaps = F.greatest(points - F.lit(1), F.lit(1)).cast("double")
    rounded = F.floor((last - first).cast("double") / gaps + F.lit(0.5))
    return F.greatest(F.lit(C.MIN_STEP_SECONDS).cast("bigint"), rounded.cast("bigint"))


def bar_step(candles: DataFrame, groups: list[str]) -> DataFrame:
    """Average step between visible candles in whole seconds, at least a minute, with the visible range."""
    return (
        candles.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("points"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))
        .withColumn("step_seconds", _step(F.col("points"), F.col("first_time"), F.col("last_time")))
    )


def time_range_filter(points: DataFrame, low: Column | int, high: Column | int) -> DataFrame:
    """Points with low <= time <= high."""
    return points.where(F.col("time").between(low, high))


def _visible(points: DataFrame, ranges: DataFrame, groups: list[str]) -> DataFrame:
    bounds = ranges.select(*groups, "first_time", "last_time")
    return time_range_filter(points.join(bounds, groups), F.col("first_time"), F.col("last_time")).select(*points.columns)


def oi_volume_ratio(
    candles: DataFrame,
    open_interest: DataFrame,
    keys: list[str],
    span_seconds: int | None = N.DAY,
    unique_right: bool = False,
) -> DataFrame:
    """Nearest open interest over candle volume; candles without volume or open interest give no row.

    candles need (keys, time, volume), one per key and time; open_interest needs (keys, time, value).
    """
    traded = candles.where(F.col("volume") > 0).select(*keys, "time", "volume")
    points = open_interest.select(*keys, "time", "value")
    aligned = N.nearest_join(
        traded, points, keys, span_seconds=span_seconds, unique_left=True, unique_right=unique_right
    )
    return aligned.where(F.col("nearest").isNotNull()).select(
        *keys, "time", (F.col("nearest.value") / F.col("volume")).alias("value")
    )


def _tolerance(rule: tuple[float, float]) -> Column:
    factor, floor = rule
    return F.greatest(F.col("step_seconds").cast("double") * F.lit(factor), F.lit(floor))


MATRIX_TOLERANCE = {
    "volume": C.TOLERANCE_VOLUME,
    "open_interest": C.TOLERANCE_SERIES,
    "long_short": C.TOLERANCE_SERIES,
    "taker": C.TOLERANCE_SERIES,
    "liquidation": C.TOLERANCE_LIQUIDATION,
    "funding": None,
}


def exchange_matrix(candles: DataFrame, breakdowns: dict[str, DataFrame], groups: list[str] = SELECTION) -> DataFrame:
    """Per candle and exchange, the nearest point of each per-exchange series within its tolerance.

    `breakdowns` maps volume, open_interest, long_short, taker, liquidation and funding to points with (groups,
    exchange, time, values). A missing liquidation is zero, so every observed exchange keeps a row per candle.
    """
    keys = [*groups, "exchange"]
    names = list(breakdowns)
    candles = candles.select(*groups, "time")
    steps = bar_step(candles, groups)
    shown = _visible(N.stack_points(breakdowns, keys), steps, groups)
    observed = shown.groupBy(*groups).agg(F.collect_set("exchange").alias("exchanges"))
    rows = (
        candles.join(steps.select(*groups, "step_seconds"), groups)
        .join(observed, groups)
        .select(*groups, "time", "step_seconds", F.explode("exchanges").alias("exchange"))
    )
    aligned = N.align(rows, shown, names, keys, span_seconds=None)
    for name, rule in MATRIX_TOLERANCE.items():
        bound = F.lit(C.TOLERANCE_FUNDING_SECONDS) if rule is None else _tolerance(rule)
        aligned = aligned.withColumn(name, N.within(name, bound))
    volume, interest = F.col("volume.value"), F.col("open_interest.value")
    return aligned.select(
        *keys,
        "time",
        volume.alias("volume"),
        interest.alias("open_interest"),
        F.when(volume > 0, interest / volume).alias("oi_volume_ratio"),
        F.col("long_short.value").alias("long_short_ratio"),
        F.col("taker.buy_volume").alias("taker_buy_volume"),
        F.col("taker.sell_volume").alias("taker_sell_volume"),
        F.col("taker.buy_sell_ratio").alias("taker_buy_sell_ratio"),
        F.coalesce("liquidation.total_value", F.lit(0.0)).alias("liquidation"),
        F.col("funding.value").alias("funding"),
    )


def liquidation_or_zero(candles: DataFrame, liquidations: DataFrame, groups: list[str] = SELECTION) -> DataFrame:
    """Per candle, the liquidation bucket within 0.45 steps; without one, a zero row at the candle's time."""
    candles = candles.select(*groups, "time")
    steps = bar_step(candles, groups)
    rows = candles.join(steps.select(*groups, "step_seconds"), groups)
    points = _visible(N.stack_points({"liquidation": liquidations}, groups), steps, groups)
    aligned = N.align(rows, points, ["liquidation"], groups, span_seconds=None)
    held = aligned.withColumn("liquidation", N.within("liquidation", _tolerance(C.TOLERANCE_LIQUIDATION)))
    return held.select(*groups, "time", *_liquidation_values())


def _liquidation_values() -> list[Column]:
    return [
        F.coalesce("liquidation.time", "time").alias("liquidation_time"),
        *[F.coalesce(f"liquidation.{c}", F.lit(0.0)).alias(c) for c in ("long_value", "short_value", "total_value")],
        F.coalesce("liquidation.event_count", F.lit(0).cast("bigint")).alias("event_count"),
    ]


def market_point(candles: DataFrame, series: dict[str, DataFrame], groups: list[str] = SELECTION) -> DataFrame:
    """Per candle, the nearest mark, index, open interest, ratio, taker flow and funding, and its liquidations.

    `series` maps mark, index, open_interest, long_short, taker, funding and liquidation to (groups, time, values).
    Series are cut to the visible candles first; only open interest over volume sees the whole series, then is cut.
    """
    candles = candles.select(*groups, "time", "close", "volume")
    points = N.stack_points(series, groups)
    steps = bar_step(candles, groups)
    interest = points.where(F.col("open_interest").isNotNull()).select(*groups, "time", "open_interest.value")
    ratio = N.stack_points({"oi_volume": oi_volume_ratio(candles, interest, groups, span_seconds=None)}, groups)
    shown = _visible(points.unionByName(ratio, allowMissingColumns=True), steps, groups)
    rows = candles.join(steps.select(*groups, "step_seconds"), groups)
    aligned = N.align(rows, shown, [*series, "oi_volume"], groups, span_seconds=None)
    aligned = aligned.withColumn("liquidation", N.within("liquidation", _tolerance(C.TOLERANCE_LIQUIDATION)))
    return aligned.select(
        *groups,
        "time",
        "close",
        "volume",
        F.col("mark.value").alias("mark"),
        F.col("index.value").alias("index"),
        F.col("open_interest.value").alias("open_interest"),
        F.col("oi_volume.value").alias("oi_volume_ratio"),
        F.col("long_short.value").alias("long_short_ratio"),
        F.col("taker.buy_volume").alias("taker_buy_volume"),
        F.col("taker.sell_volume").alias("taker_sell_volume"),
        F.col("taker.buy_sell_ratio").alias("taker_buy_sell_ratio"),
        F.col("funding.value").alias("funding"),
        *_liquidation_values(),
    )


def latest_snapshot(chart: DataFrame, derivatives: DataFrame, groups: list[str] = SELECTION) -> DataFrame:
    """Last candle against the one before, basis of mark over index, and the last point of each derived series.

    A change from a previous close of zero is NULL (a browser would show infinity). Where two quotes of an asset share
    the last time, the larger value is shown.
    """
    latest = Window.partitionBy(*groups).orderBy(F.col("time").desc())
    candles = (
        chart.where(F.col("series") == "candles")
        .withColumn("n", F.row_number().over(latest))
        .where(F.col("n") <= 2)
        .groupBy(*groups)
        .agg(
            F.max(F.when(F.col("n") == 1, F.col("time"))).alias("time"),
            F.max(F.when(F.col("n") == 1, F.col("close"))).alias("close"),
            F.max(F.when(F.col("n") == 1, F.col("volume"))).alias("volume"),
            F.max(F.when(F.col("n") == 2, F.col("close"))).alias("previous_close"),
        )
    )

    def last_of(name: str, value: str) -> Column:
        hit = F.col("series") == name
        return F.max_by(F.when(hit, F.col(value)), F.when(hit, F.struct("time", value)))

    lines = chart.groupBy(*groups).agg(
        last_of("markPrice", "value").alias("mark"), last_of("indexPrice", "value").alias("index")
    )
    derived = derivatives.groupBy(*groups).agg(
        last_of("openInterest", "value").alias("open_interest"),
        last_of("longShortRatio", "value").alias("long_short_ratio"),
        last_of("takerBuySell", "buy_sell_ratio").alias("taker_buy_sell_ratio"),
        last_of("fundingRate", "value").alias("funding"),
        last_of("liquidations", "total_value").alias("liquidation"),
    )
    both = (F.col("mark") != 0) & (F.col("index") != 0)
    return (
        candles.join(lines, groups, "left")
        .join(derived, groups, "left")
        .withColumn("move", F.try_divide(F.col("close") - F.col("previous_close"), F.col("previous_close")))
        .withColumn("basis", F.when(both, F.try_divide(F.col("mark") - F.col("index"), F.col("index"))))
        .withColumn("oi_volume_ratio", F.when(F.col("volume") > 0, F.try_divide("open_interest", "volume")))
    )


def exchange_order(exchange: Column) -> Column:
    """Sort key of exchanges: the four shown first in their fixed order, then the rest by name."""
    listed = F.array(*[F.lit(e) for e in C.EXCHANGE_DISPLAY_ORDER])
    position = F.array_position(listed, exchange)
    shown = F.when(position > 0, position).otherwise(F.lit(len(C.EXCHANGE_DISPLAY_ORDER) + 1))
    return F.struct(shown.cast("bigint").alias("position"), exchange.alias("exchange"))


def signed_flow(taker: DataFrame, liquidations: DataFrame, groups: list[str] = SELECTION) -> DataFrame:
    """Diverging series: taker sells and long liquidations point down."""
    flow = taker.select(
        *groups, "time", F.lit("taker").alias("series"), F.col("buy_volume").alias("up"), (-F.col("sell_volume")).alias("down")
    )
    forced = liquidations.select(
        *groups, "time", F.lit("liquidation").alias("series"), F.col("short_value").alias("up"), (-F.col("long_value")).alias("down")
    )
    return flow.unionByName(forced)


def axis_ranges(
    chart: DataFrame,
    derivatives: DataFrame,
    groups: list[str] = SELECTION,
    first_time: int | None = None,
    last_time: int | None = None,
) -> DataFrame:
    """Axis range of each panel of a chart, over the visible times (all, if no end is given).

    Prices span highs, lows, mark and index; volumes start at zero; taker flow and liquidations are mirrored around zero
    and reach to one at least.
    """

    def stacked(bundle: DataFrame, panels: dict[str, dict[str, list[str]]]) -> DataFrame:
        shown = bundle
        if first_time is not None:
            shown = shown.where(F.col("time") >= first_time)
        if last_time is not None:
            shown = shown.where(F.col("time") <= last_time)
        cells = [
            F.struct(F.lit(panel).alias("panel"), F.when(F.col("series") == series, F.col(value)).alias("value"))
            for panel, parts in panels.items()
            for series, values in parts.items()
            for value in values
        ]
        each = shown.select(*groups, F.explode(F.array(*cells)).alias("cell")).select(*groups, "cell.*")
        return each.where(F.col("value").isNotNull())

    prices = {"price": {"candles": ["high", "low"], "markPrice": ["value"], "indexPrice": ["value"]}, "volume": {"candles": ["volume"]}}
    plain = stacked(chart, prices)
    zero = plain.where(F.col("panel") == "volume").select(*groups, "panel", F.lit(0.0).alias("value")).distinct()
    mirrored = stacked(
        derivatives, {"taker": {"takerBuySell": ["buy_volume", "sell_volume"]}, "liquidation": {"liquidations": ["long_value", "short_value"]}}
    )
    edge = F.greatest(F.max("value"), F.lit(1.0))
    around = mirrored.groupBy(*groups, "panel").agg((-edge).alias("min"), edge.alias("max"))
    return series_bounds(plain.unionByName(zero), [*groups, "panel"]).unionByName(around)


def series_bounds(points: DataFrame, groups: list[str], symmetric: bool = False) -> DataFrame:
    """Axis range of each series: 8 % room around min and max, +-1 % when flat, or +-1.15 of the largest magnitude.

    Values that are not finite are ignored; a series without any spans 0..1.
    """
    finite = F.when(~F.isnan("value") & (F.abs("value") != float("inf")), F.col("value"))
    found = points.select(*groups, finite.alias("value")).groupBy(*groups).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.max(F.abs("value")).alias("magnitude")
    )
    if symmetric:
        edge = F.greatest("magnitude", F.lit(1e-9)) * F.lit(1.15)
        low, high = -edge, edge
    else:
        flat = F.col("low") == F.col("high")

        def nudge(name: str) -> Column:
            return F.abs(F.when(F.col(name) == 0, F.lit(1.0)).otherwise(F.col(name))) * F.lit(0.01)

        bottom = F.when(flat, F.col("low") - nudge("low")).otherwise(F.col("low"))
        top = F.when(flat, F.col("high") + nudge("high")).otherwise(F.col("high"))
        room = (top - bottom) * F.lit(0.08)
        low, high = bottom - room, top + room
    return found.select(
        *groups,
        F.coalesce(low, F.lit(0.0)).alias("min"),
        F.coalesce(high, F.lit(1.0)).alias("max"),
    )


def rolling_zscore(points: DataFrame, groups: list[str], rows: int = 24, span: int | None = None) -> DataFrame:
    """Deviation of each value from the mean of its last `rows` points, in standard deviations (our definition).

    NULL while fewer than two points are in the window or all are equal; values that are NULL take a place but no part.
    Newest-N series are short and take one window each. For long histories give `span`, in units of `time`: a series is cut
    into spans, each takes along the last rows - 1 points before it, and no task holds a whole series. A span may be empty or
    hold fewer points than that; then they come from spans further back. Where a time repeats, points follow in the order of
    their values, then of all their columns.
    """
    columns = points.columns
    order = ["time", "value", *[c for c in columns if c not in ("time", "value", *groups)]]
    if span is None:
        return _zscores(points, groups, order, rows)
    cut = points.withColumn("_span", F.floor(F.col("time") / F.lit(span))).withColumn("_own", F.lit(True))
    newest = Window.partitionBy(*groups, "_span").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        cut.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") < rows)  # trimmed in each task before the shuffle
        .groupBy(*groups, "_span").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("tail"))
    )
    # one row for each span; its lead is the end of the tails of the spans before it
    before = Window.partitionBy(*groups).orderBy("_span").rowsBetween(-(rows - 1), -1)  # a span holds one point at least
    joined = F.flatten(F.collect_list("tail").over(before))
    lead = F.when(F.size(joined) >= rows - 1, F.slice(joined, -(rows - 1), rows - 1)).otherwise(joined)
    carried = tails.select(*groups, "_span", lead.alias("lead")).select(*groups, "_span", F.inline("lead"), F.lit(False).alias("_own"))
    scored = _zscores(cut.unionByName(carried), [*groups, "_span"], order, rows)
    return scored.where(F.col("_own")).select(*columns, "zscore")


def _zscores(points: DataFrame, groups: list[str], order: list[str], rows: int) -> DataFrame:
    recent = Window.partitionBy(*groups).orderBy(*order).rowsBetween(-(rows - 1), 0)
    spread = F.stddev_samp("value").over(recent)
    return points.withColumn(
        "zscore", F.when(spread > 0, (F.col("value") - F.avg("value").over(recent)) / spread)
    )


def liquidation_ratio(liquidations: DataFrame) -> DataFrame:
    """Long share of the notional that has a known side (our definition); NULL when there is none."""
    sided = F.col("long_value") + F.col("short_value")
    return liquidations.withColumn("long_share", F.try_divide(F.col("long_value"), sided))
