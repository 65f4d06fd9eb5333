"""Quality rules over normalised bars, for every stream of a batch at once.

Inputs: `collapsed` bars (one row per stream and open time with its number of copies, see normalize.collapse_bars)
and `plan` (one row per job with anchor, target and fetch mode, see plans.requests).

A stream may hold a large share of all rows, so no rule gathers a stream in one task: lists of example times
keep only the first 20 before the shuffle, and gaps are found inside fixed spans of time whose ends are linked
through a small per-span summary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import timegrid as G
from tidemark.sources.staging import settle

EXAMPLES = 20
SPAN_BARS = 1024


def _issue(rows: DataFrame, kind: str, severity: str, expected: Column, actual: Column, detail: Column) -> DataFrame:
    return rows.select(
        *C.SERIES_KEY,
        "source_dataset",
        F.lit(kind).alias("issue_type"),
        "issue_start_time",
        "issue_end_time",
        expected.cast("bigint").alias("expected_count"),
        actual.cast("bigint").alias("actual_count"),
        F.lit(severity).alias("severity"),
        detail.alias("detail"),
    )


FLAG_SEVERITY = {"duplicate_bar": "warning", "invalid_ohlc": "error", "negative_volume": "error"}


def _flags(kinds: list[str]) -> Column:
    """The rules a bar breaks, with its weight in each (k copies of an open time weigh k-1)."""
    outside = F.col("high") < F.col("low")
    for price in ("open", "close"):
        outside = outside | (F.col(price) < F.col("low")) | (F.col(price) > F.col("high"))
    negative = (F.col("volume") < 0) | F.coalesce(F.col("quote_volume") < 0, F.lit(False))
    one = F.lit(1).cast("bigint")
    found = {
        "duplicate_bar": (F.col("copies") > 1, F.col("copies") - 1),
        "invalid_ohlc": (outside, one),
        "negative_volume": (negative, one),
    }
    flags = [
        F.when(found[kind][0], F.struct(F.lit(kind).alias("kind"), found[kind][1].alias("weight"))) for kind in kinds
    ]
    return F.array_compact(F.array(*flags))


def flagged_bars(bars: DataFrame, kinds: list[str]) -> DataFrame:
    """One issue per stream and broken rule: range, total, and the first 20 times in order.

    Totals combine on the map side; the example list is trimmed to 20 rows per task before the shuffle.
    """
    return _flag_issues(
        bars.select(*C.STREAM_KEY, "open_time", F.explode(_flags(kinds)).alias("f")).select(
            *C.STREAM_KEY, "open_time", "f.kind", "f.weight"
        )
    )


def _flag_issues(flagged: DataFrame) -> DataFrame:
    keys = [*C.STREAM_KEY, "kind"]
    totals = flagged.groupBy(*keys).agg(
        F.min("open_time").alias("first_time"),
        F.max("open_time").alias("last_time"),
        F.sum("weight").alias("total"),
    )
    in_order = Window.partitionBy(*keys).orderBy("open_time")
    firsts = (
        flagged.withColumn("position", F.row_number().over(in_order))
        .where(F.col("position") <= EXAMPLES)
        .select(*keys, F.struct("open_time", "weight").alias("example"))
    )
    # both sides are small by now (one row, or at most 20, per stream and rule): stacked, not joined
    found = (
        totals.unionByName(firsts, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.max("first_time").alias("issue_start_time"),
            F.max("last_time").alias("issue_end_time"),
            F.max("total").alias("affected"),
            F.array_sort(F.collect_list("example")).alias("firsts"),
        )
    )
    repeated = F.flatten(
        F.transform(
            "firsts",
            lambda x: F.array_repeat(
                G.iso_text(x["open_time"]), F.least(x["weight"], F.lit(EXAMPLES).cast("bigint")).cast("int")
            ),
        )
    )
    found = found.withColumn("times", F.slice(repeated, 1, EXAMPLES))
    repeats = F.col("kind") == "duplicate_bar"
    severity = F.element_at(F.create_map(*[F.lit(x) for kv in FLAG_SEVERITY.items() for x in kv]), F.col("kind"))
    as_duplicates = F.struct(F.col("affected").alias("duplicate_count"), F.col("times").alias("duplicate_open_times"))
    as_affected = F.struct(F.col("affected").alias("affected_count"), F.col("times").alias("open_times"))
    return found.select(
        *C.SERIES_KEY,
        "source_dataset",
        F.col("kind").alias("issue_type"),
        "issue_start_time",
        "issue_end_time",
        F.when(repeats, F.col("affected")).alias("expected_count"),
        F.when(repeats, F.lit(0).cast("bigint")).otherwise(F.col("affected")).alias("actual_count"),
        severity.alias("severity"),
        F.when(repeats, F.to_json(as_duplicates)).otherwise(F.to_json(as_affected)).alias("detail"),
    )


def duplicate_bar(collapsed: DataFrame) -> DataFrame:
    """One warning per stream that repeated an open time; k copies count as k-1 repeats."""
    return flagged_bars(collapsed, ["duplicate_bar"])


def invalid_ohlc(bars: DataFrame) -> DataFrame:
    """One error per stream with bars whose open or close lies outside low..high, or high below low."""
    return flagged_bars(bars, ["invalid_ohlc"])


def negative_volume(bars: DataFrame) -> DataFrame:
    """One error per stream with a negative volume or quote volume."""
    return flagged_bars(bars, ["negative_volume"])


def previous_open_times(bars: DataFrame, plan: DataFrame) -> DataFrame:
    """Each bar with the open time before it in its stream; the first bar of a stream gets its job's anchor.

    The order is taken inside spans of 1,024 intervals, so one stream spreads over many tasks. The first bar of a
    span gets the last bar of the span before it from a summary with one row per span: a stream has at most
    (time range / span) of those, however many bars it holds. Only that summary meets the plan.
    """
    span = F.floor(F.unix_seconds("open_time") / (F.col("interval_seconds") * F.lit(SPAN_BARS)))
    keyed = bars.select(*C.STREAM_KEY, "open_time", "interval_seconds").withColumn("span", span)
    last_of_span = keyed.groupBy(*C.STREAM_KEY, "span").agg(F.max("open_time").alias("last_open"))
    before = F.lag("last_open").over(Window.partitionBy(*C.STREAM_KEY).orderBy("span"))
    carried = (
        last_of_span.withColumn("before", before)
        .join(plan.select(*C.STREAM_KEY, "anchor_open_time"), C.STREAM_KEY, "left")
        .select(*C.STREAM_KEY, "span", F.coalesce("before", "anchor_open_time").alias("carried_open"))
    )
    inside = F.lag("open_time").over(Window.partitionBy(*C.STREAM_KEY, "span").orderBy("open_time"))
    linked = keyed.withColumn("inside", inside).join(carried, [*C.STREAM_KEY, "span"])
    return linked.select(
        *C.STREAM_KEY, "open_time", "interval_seconds", F.coalesce("inside", "carried_open").alias("previous_open")
    )


def missing_bar(bars: DataFrame, plan: DataFrame) -> DataFrame:
    """One warning per gap wider than the interval; the first bar is compared with the job's anchor.

    A step that is off the grid still reports a gap, with zero missing bars and an end before its start.
    """
    timed = bars.select(*C.STREAM_KEY, "open_time").withColumn(
        "interval_seconds", G.interval_seconds(F.col("bar_interval"))
    )
    return _gap_issues(previous_open_times(timed, plan))


def _width() -> Column:
    return F.unix_micros("open_time") - F.unix_micros("previous_open")


def _gap_issues(steps: DataFrame) -> DataFrame:
    """Issues of bars (`open_time`, `previous_open`, `interval_seconds`) that are further than an interval from the one before."""
    step = F.col("interval_seconds")
    gaps = (
        steps.withColumn("width", _width())
        .where(F.col("width") > step * 1_000_000)
        .withColumn("missing", F.floor(F.col("width") / (step * 1_000_000)) - 1)
        .withColumn("issue_start_time", G.shift_seconds(F.col("previous_open"), step))
        .withColumn("issue_end_time", G.shift_seconds(F.col("open_time"), -step))
    )
    detail = F.to_json(
        F.struct(
            G.iso_text(F.col("issue_start_time")).alias("gap_from"),
            G.iso_text(F.col("issue_end_time")).alias("gap_to"),
            F.col("missing").alias("missing_count"),
        )
    )
    return _issue(gaps, "missing_bar", "warning", F.col("missing"), F.lit(0), detail)


def late_data(bars: DataFrame, plan: DataFrame, late_intervals: int = C.LATE_DATA_INTERVALS) -> DataFrame:
    """One warning per incremental job whose newest bar trails its target by more than the allowed intervals."""
    return _late_issues(bars, plan, late_intervals)


def _late_issues(times: DataFrame, plan: DataFrame, late_intervals: int) -> DataFrame:
    newest = times.groupBy(*C.STREAM_KEY).agg(F.max("open_time").alias("newest"))
    latest = (
        plan.where(F.col("fetch_mode") == "incremental")
        .join(newest, C.STREAM_KEY, "left")
        .withColumn("issue_start_time", F.coalesce("newest", "anchor_open_time"))
        .withColumn("issue_end_time", F.col("target_last_open_time"))
        .withColumn("lag", F.unix_micros("issue_end_time") - F.unix_micros("issue_start_time"))
        .where(F.col("lag") > G.interval_seconds(F.col("bar_interval")) * F.lit(late_intervals * 1_000_000))
    )
    detail = F.to_json(
        F.struct(
            G.iso_text(F.col("issue_start_time")).alias("latest_observed_open_time"),
            G.iso_text(F.col("issue_end_time")).alias("expected_latest_open_time"),
            F.floor(F.col("lag") / 1_000_000).alias("lag_seconds"),
        )
    )
    return _issue(latest, "late_data", "warning", F.lit(1), F.lit(0), detail)


def checked_bars(bars: DataFrame) -> DataFrame:
    """What one sorted pass over the spans of a batch finds, as rows of a `kind`: a broken rule with its weight, a `gap` between
    two bars of a span, and the `edge` of a span (its first and last bar), by which spans are linked."""
    timed = bars.withColumn("interval_seconds", G.interval_seconds(F.col("bar_interval")))
    span = F.floor(F.unix_seconds("open_time") / (F.col("interval_seconds") * F.lit(SPAN_BARS)))
    inside = Window.partitionBy(*C.STREAM_KEY, "span").orderBy("open_time")
    walked = timed.select(*C.STREAM_KEY, "interval_seconds", "open_time", span.alias("span"), _flags(list(FLAG_SEVERITY)).alias("flags"))
    walked = walked.withColumn("previous_open", F.lag("open_time").over(inside)).withColumn("next_open", F.lead("open_time").over(inside))
    none = F.lit(0).cast("bigint")
    gap = F.when(_width() > F.col("interval_seconds") * 1_000_000, F.struct(F.lit("gap").alias("kind"), none.alias("weight")))
    at_edge = F.col("previous_open").isNull() | F.col("next_open").isNull()
    edge = F.when(at_edge, F.struct(F.lit("edge").alias("kind"), none.alias("weight")))
    found = F.concat("flags", F.array_compact(F.array(gap, edge)))
    return walked.select(*C.STREAM_KEY, "interval_seconds", "span", "open_time", "previous_open", F.inline(found))


def _span_steps(found: DataFrame, plan: DataFrame) -> DataFrame:
    """Each span's first bar with the last bar of the span before it, or its job's anchor."""
    edges = found.where(F.col("kind") == "edge").groupBy(*C.STREAM_KEY, "interval_seconds", "span")
    spans = edges.agg(F.min("open_time").alias("open_time"), F.max("open_time").alias("last_open"))
    before = F.lag("last_open").over(Window.partitionBy(*C.STREAM_KEY).orderBy("span"))
    linked = spans.withColumn("before", before).join(plan.select(*C.STREAM_KEY, "anchor_open_time"), C.STREAM_KEY, "left")
    return linked.withColumn("previous_open", F.coalesce("before", "anchor_open_time"))


def quality_issues(collapsed: DataFrame, plan: DataFrame, late_intervals: int = C.LATE_DATA_INTERVALS) -> DataFrame:
    """All rules over one batch, with common columns. The batch is read once; what that pass finds is settled, and the issues
    are made from it."""
    bars = collapsed
    if "quote_volume" not in bars.columns:
        bars = bars.withColumn("quote_volume", F.lit(None).cast("decimal(28,8)"))
    found = settle(checked_bars(bars), "checked-bars")
    steps = ["open_time", "previous_open", "interval_seconds"]
    gaps = found.where(F.col("kind") == "gap").select(*C.STREAM_KEY, *steps)
    parts = [
        _flag_issues(found.where(F.col("kind").isin(list(FLAG_SEVERITY))).select(*C.STREAM_KEY, "open_time", "kind", "weight")),
        _gap_issues(gaps.unionByName(_span_steps(found, plan).select(*C.STREAM_KEY, *steps))),
        _late_issues(found.where(F.col("kind") == "edge"), plan, late_intervals),
    ]
    return reduce(DataFrame.unionByName, parts)


def run_status(issues: DataFrame, plan: DataFrame) -> DataFrame:
    """Status of each job that ran: partial_success when any issue is an error, else success."""
    severe = issues.groupBy(*C.STREAM_KEY).agg(F.max(F.col("severity").isin("error", "critical")).alias("severe"))
    status = F.when(F.coalesce("severe", F.lit(False)), "partial_success").otherwise("success")
    return plan.join(severe, C.STREAM_KEY, "left").select("job_name", *C.STREAM_KEY, status.alias("status"))
