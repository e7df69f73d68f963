"""Operators over metric samples: rates, ratios, freshness, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.functions.thresholds import ROW_COUNT_STEPS, Steps, classify
from tiermill.sources.metrics import BRONZE_ROWS, LAST_UPDATE, ROW_COUNTS, SILVER_ROWS, latest, latest_values

_MICROS = 1_000_000


def counter_rate(samples: DataFrame, metric: str, window_seconds: int, slice_seconds: int = 3600) -> DataFrame:
    """Increase per second of a counter over the trailing window, at every sample.

    The increase runs from the first to the last sample inside `[t - window, t]`; a falling
    value is a reset and counts as an increase from zero. Null with fewer than two samples.

    A series is cut into slices of time and each slice is given the last `window_seconds` of the
    one before it. Every window then lies inside one slice, so the result is exact while a long
    or dense series still spreads over many tasks.
    """
    width = window_seconds * _MICROS
    trailing = Window.partitionBy("metric", "series", "slice").orderBy("at").rangeBetween(-width, Window.currentRow)
    # The first sample's own increase began before the window.
    gained = F.sum("increase").over(trailing) - F.first("increase").over(trailing)
    seconds = (F.col("at") - F.first("at").over(trailing)) / F.lit(float(_MICROS))
    return (
        _increases(samples, metric, width, slice_seconds, own_only=False)
        .withColumn("rate", F.try_divide(gained, seconds))
        .where(F.col("slice") == F.col("own"))
        .select("metric", "series", "ts", "value", "rate")
    )


def _increases(samples: DataFrame, metric: str, width: int, slice_seconds: int, own_only: bool = True) -> DataFrame:
    """Samples with their increase over the one before, if that is at most `width` older or in the same slice of time."""
    length = max(slice_seconds * _MICROS, width)
    one_per_time = (
        samples.where(F.col("metric") == metric).groupBy("metric", "series", "ts").agg(F.max("value").alias("value"))
    )
    at = F.unix_micros("ts")
    own = at - F.pmod(at, F.lit(length))
    near_end = F.pmod(at, F.lit(length)) >= F.lit(length - width)
    sliced = one_per_time.select(
        "*",
        at.alias("at"),
        own.alias("own"),
        F.explode(F.when(near_end, F.array(own, own + length)).otherwise(F.array(own))).alias("slice"),
    )
    previous = F.lag("value").over(Window.partitionBy("metric", "series", "slice").orderBy("at"))
    increase = F.when(previous.isNull(), 0.0).when(F.col("value") < previous, F.col("value"))
    grown = sliced.withColumn("increase", increase.otherwise(F.col("value") - previous))
    return grown.where(F.col("slice") == F.col("own")) if own_only else grown


def _steps(at: Column, reach: int, step: int) -> Column:
    """Times of the grid whose window of `reach` up to them holds `at`; all in microseconds."""
    first, last = F.ceil(at / F.lit(float(step))) * step, F.floor((at + reach) / F.lit(float(step))) * step
    return F.explode(F.when(first <= last, F.sequence(first, last, F.lit(step))))


def _pane(at: Column, step: int) -> Column:
    """The end of the pane that holds `at`: panes are as long as a step, and hold their end but not their beginning."""
    return (F.ceil(at / F.lit(float(step))) * step).cast("long")


def _slices(first: Column, last: Column, length: int) -> Column:
    """Beginnings of the slices of time from that of `first` to that of `last`."""
    start = lambda t: t - F.pmod(t, F.lit(length))
    return F.explode(F.sequence(start(first), start(last), F.lit(length)))


def _steps_in(first: Column, last: Column, step: int, begin: Column, length: int) -> Column:
    """Times of the grid from `first` to `last` within the slice that begins at `begin`."""
    a, b = F.greatest(first, begin), F.least(last, begin + (length - step))
    return F.explode(F.when(a <= b, F.sequence(a, b, F.lit(step))))


def rate_on_grid(samples: DataFrame, metric: str, window_seconds: int, step_seconds: int = 15, slice_seconds: int = 3600) -> DataFrame:
    """Increase per second of a counter over `[t - window, t]` for every t of a common grid.

    Series that are sampled at different times get values at the same times, so that they can be added up. Steps with
    fewer than two samples have no row. The samples of a step are first combined into a pane, one row; a window is put together from
    its panes, and from the sample that lies exactly at its beginning, within a slice of time. So what is shuffled is a
    pane, twice where its windows reach into the next slice, and not each sample for each window that holds it. A
    window that isn't a whole number of steps has no whole panes: its samples are spread to their steps.
    """
    width, step = window_seconds * _MICROS, step_seconds * _MICROS
    grown = _increases(samples, metric, width, slice_seconds)
    seconds = lambda first, last: (last - first) / F.lit(float(_MICROS))
    if width % step:
        spread = grown.select("metric", "series", "at", "increase", _steps(F.col("at"), width, step).alias("t"))
        gained = F.sum("increase") - F.min_by("increase", "at")
        rates = spread.groupBy("metric", "series", "t").agg((gained / seconds(F.min("at"), F.max("at"))).alias("rate"), F.count(F.lit(1)).alias("n"))
        return rates.where("n > 1").select("metric", "series", F.timestamp_micros("t").alias("ts"), "rate")
    length = -(-max(slice_seconds * _MICROS, width) // step) * step
    panes = grown.groupBy("metric", "series", "slice", _pane(F.col("at"), step).alias("p")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("increase").alias("sum"),
        F.min(F.struct("at", "increase")).alias("first"),
        F.max(F.struct("at", "increase")).alias("last"),
    )
    # a pane whose samples lay in two slices of the increases is in two rows
    in_slices = panes.select("metric", "series", "p", "n", "sum", "first", "last", _slices(F.col("p"), F.col("p") + width, length).alias("begin"))
    together = in_slices.repartition("metric", "series", "begin")
    t = _steps_in(F.col("p"), F.col("p") + width, step, F.col("begin"), length)
    sent = together.select("*", t.alias("t"))
    # at the last of its steps a pane counts by the sample at its end alone
    at_end = F.col("t") == F.col("p") + width
    sent = sent.where(~at_end | (F.col("last.at") == F.col("p")))
    held = lambda whole, end: F.when(at_end, end).otherwise(whole)
    windows = sent.groupBy("metric", "series", "begin", "t").agg(
        F.sum(held(F.col("n"), F.lit(1))).alias("n"),
        F.sum(held(F.col("sum"), F.col("last.increase"))).alias("sum"),
        F.min(held(F.col("first"), F.col("last"))).alias("first"),
        F.max("last.at").alias("last"),
    )
    rate = (F.col("sum") - F.col("first.increase")) / seconds(F.col("first.at"), F.col("last"))
    return windows.where("n > 1").select("metric", "series", F.timestamp_micros("t").alias("ts"), rate.alias("rate"))


def value_on_grid(samples: DataFrame, metrics: Sequence[str], step_seconds: int = 15, lookback_seconds: int = 300, slice_seconds: int = 3600) -> DataFrame:
    """The newest value of each series at every t of a common grid, if it is not older than the lookback."""
    found = _newest_on_grid(samples, metrics, ["metric", "series", "job_id", "query_id"], ["metric", "series", "job_id", "query_id"], step_seconds, lookback_seconds, slice_seconds)
    return found.select("metric", "series", "job_id", "query_id", F.timestamp_micros("t").alias("ts"), "value")


def _newest_on_grid(samples: DataFrame, metrics: Sequence[str], keys: list[str], together: list[str], step_seconds: int, lookback_seconds: int, slice_seconds: int) -> DataFrame:
    """The keys, begin (of the slice), t, value: rows of a slice and of the same columns `together` are in one task.

    Of the samples of a step the newest stands for all. It is the value from there on until the next pane with a sample, or
    to the end of the lookback; so nothing is added up over windows. A pane is shuffled at most twice: for the slice of
    time that it ends in, and for the next one if it holds until then.
    """
    step, reach = step_seconds * _MICROS, lookback_seconds * _MICROS
    length = -(-max(slice_seconds * _MICROS, reach) // step) * step
    at = F.unix_micros("ts")
    placed = samples.where(F.col("metric").isin(*metrics)).select(*keys, at.alias("at"), "value").withColumn("p", _pane(F.col("at"), step))
    panes = placed.groupBy(*keys, "p").agg(F.max(F.struct("at", "value")).alias("newest"))
    # the last step at which the newest sample isn't too old
    last = (F.floor((F.col("newest.at") + reach) / F.lit(float(step))) * step).cast("long")
    sliced = panes.withColumn("last", last).select(*keys, "p", "newest", "last", _slices(F.col("p"), F.greatest("p", "last"), length).alias("begin"))
    within = Window.partitionBy(*keys, "begin").orderBy("p")
    following = sliced.repartition(*together, "begin").withColumn("next", F.lead("p").over(within))
    until = F.least("last", F.coalesce(F.col("next") - step, F.col("last")))
    held = following.select(*keys, "begin", "p", until.alias("until"), F.col("newest.value").alias("value"))
    return held.select(*keys, "begin", "value", _steps_in(F.col("p"), F.col("until"), step, F.col("begin"), length).alias("t"))


def throughput_total(samples: DataFrame, metric: str, window_seconds: int = 60, step_seconds: int = 15) -> DataFrame:
    """Sum of the rates of all series, at every time of the grid."""
    rates = rate_on_grid(samples, metric, window_seconds, step_seconds)
    return rates.groupBy("ts").agg(F.sum("rate").alias("rate"))


def avg_by_label(samples: DataFrame, metric: str, label: str, step_seconds: int = 15, lookback_seconds: int = 300) -> DataFrame:
    """Mean over the series that share a label value, at every time of the grid."""
    values = value_on_grid(samples, [metric], step_seconds, lookback_seconds)
    return values.groupBy("ts", label).agg(F.avg("value").alias("value"))


def quality_pct(
    samples: DataFrame, numerator: str = SILVER_ROWS, denominator: str = BRONZE_ROWS, step_seconds: int = 15, lookback_seconds: int = 300
) -> DataFrame:
    """Silver rows in percent of bronze rows, per series, at every time of the grid.

    The one-to-one match is done by a grouped aggregate within the slices of time that both metrics' values lie in; a
    self-join would scan twice and shuffle both sides. Only times at which both metrics have a value remain; a
    denominator of zero gives null.
    """
    values = _newest_on_grid(samples, [numerator, denominator], ["metric", "series"], ["series"], step_seconds, lookback_seconds, 3600)

    def value_of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.struct("value")))["value"]

    return (
        values.groupBy("series", "begin", "t")
        .agg(value_of(numerator).alias("numerator"), value_of(denominator).alias("denominator"))
        .where(F.col("numerator").isNotNull() & F.col("denominator").isNotNull())
        .select(F.timestamp_micros("t").alias("ts"), "series", (F.try_divide("numerator", "denominator") * 100).alias("quality_pct"))
    )


def metric_status(values: DataFrame, column: str, steps: Steps, status: str = "status") -> DataFrame:
    return values.withColumn(status, classify(column, steps))


def metric_timeline(samples: DataFrame, metrics: Sequence[str] = ROW_COUNTS, step: str = "30 seconds") -> DataFrame:
    """One row per time step with each metric's last value in it, side by side."""
    columns = [latest(F.when(F.col("metric") == m, F.col("value")), _ts_of(m)).alias(m) for m in metrics]
    return (
        samples.where(F.col("metric").isin(*metrics))
        .groupBy(F.window("ts", step).alias("step"))
        .agg(*columns)
        .select(F.col("step.start").alias("ts"), *metrics)
    )


def freshness_seconds(samples: DataFrame, as_of: str | Column) -> DataFrame:
    """Seconds between the last table update and `as_of`, per series."""
    now = F.unix_timestamp(F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of)
    return latest_values(samples, [LAST_UPDATE]).select(
        "series", (now - F.col("value").cast("long")).alias("freshness_s")
    )


def pipeline_health(samples: DataFrame, metrics: Sequence[str] = ROW_COUNTS, steps: Steps = ROW_COUNT_STEPS) -> DataFrame:
    """The newest row counts side by side, each with its status."""
    columns = [latest(F.when(F.col("metric") == m, F.col("value")), _ts_of(m)).alias(m) for m in metrics]
    side_by_side = samples.where(F.col("metric").isin(*metrics)).groupBy("series").agg(*columns)
    return side_by_side.select("*", *[classify(m, steps).alias(f"{m}_status") for m in metrics])


def _ts_of(metric: str) -> Column:
    return F.when(F.col("metric") == metric, F.col("ts"))
