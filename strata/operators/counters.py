"""Scraped counters and gauges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.operators.metrics import pane_start
from strata.operators.windows import prev_sample


def counter_increase(
    samples: DataFrame,
    series: Sequence[str],
    window: int,
    per_second: bool = False,
    extrapolate: bool = False,
) -> DataFrame:
    """Growth of a counter per series and window, a drop counting as a restart at zero.

    Growth between two samples belongs to the window of the later one. Differences
    within a window are taken per series and window, the step over a window's edge from
    the window's first and the preceding window's last sample, so no task sorts all
    samples of a series.

    With ``extrapolate`` only samples inside the window count and their growth is
    extended towards its edges, by at most half the sample distance on a side that
    reaches further than 1.1 distances, and never below a counter of zero.
    """
    keys = [*series, "window_start"]
    panes = samples.withColumn("window_start", pane_start("ts", window))
    steps = panes.withColumn(
        "step", _growth(F.col("value"), prev_sample(keys, "ts", "value"))
    )
    at = F.unix_micros("ts") / 1e6
    per_window = steps.groupBy(*keys).agg(
        F.coalesce(F.sum("step"), F.lit(0.0)).alias("inside"),
        F.min_by("value", "ts").alias("first_value"),
        F.max_by("value", "ts").alias("last_value"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.count(F.lit(1)).alias("n"),
    )
    if extrapolate:
        growth = _extrapolated(window)
    else:
        before = F.lag("last_value").over(W.partitionBy(*series).orderBy("window_start"))
        growth = F.col("inside") + F.coalesce(_growth(F.col("first_value"), before), F.lit(0.0))
    if per_second:
        growth = growth / F.lit(window)
    return per_window.select(*keys, growth.alias("increase"))


def latest_gauge(samples: DataFrame, series: Sequence[str]) -> DataFrame:
    """Newest value per series; of samples at the same time the largest."""
    newest = F.max_by("value", F.struct("ts", "value"))
    return samples.groupBy(*series).agg(newest.alias("value"))


def _growth(value: Column, previous: Column) -> Column:
    return F.when(value < previous, value).otherwise(value - previous)


def _extrapolated(window: int) -> Column:
    start = F.unix_seconds("window_start").cast("double")
    sampled = F.col("last_at") - F.col("first_at")
    distance = sampled / (F.col("n") - 1)

    def reach(gap: Column) -> Column:
        return F.when(gap >= distance * 1.1, distance / 2).otherwise(gap)

    to_zero = sampled * F.col("first_value") / F.col("inside")
    head = reach(F.col("first_at") - start)
    head = F.when(
        (F.col("inside") > 0) & (F.col("first_value") >= 0), F.least(head, to_zero)
    ).otherwise(head)
    tail = reach(start + window - F.col("last_at"))
    return F.when(F.col("n") > 1, F.col("inside") * (sampled + head + tail) / sampled)
