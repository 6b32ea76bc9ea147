"""Request metrics over a log: counters, histograms, quantiles, rates.

Windows are given in seconds. A sliding window is summed from panes as long as the
slide, so a request is counted once and only the few pane rows are repeated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label set of a request series and the latency bucket bounds in seconds.
LABELS = ("method", "path", "status_code")
BUCKET_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
MIN_RATE = 0.0001

# Durations are summed as decimals, so a sum does not depend on the order of the rows.
DURATION_TYPE = "decimal(18,9)"


def is_error() -> Column:
    return F.col("status_code") >= 400


def duration_sum() -> Column:
    return F.sum(F.col("duration_s").cast(DURATION_TYPE)).cast("double")


def pane_start(ts: Column | str, seconds: int) -> Column:
    """Start of the ``seconds``-long pane a timestamp lies in."""
    at = F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)
    return F.timestamp_seconds(at - F.pmod(at, F.lit(seconds)))


def windowed_sums(
    log: DataFrame,
    counts: Mapping[str, Column],
    by: Sequence[str],
    window: int,
    slide: int | None = None,
) -> DataFrame:
    """Number of rows meeting each condition per window ``[start, start + window)``."""
    slide = slide or window
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    panes = log.groupBy(pane_start("ts", slide).alias("window_start"), *by).agg(
        *[F.count_if(condition).alias(name) for name, condition in counts.items()]
    )
    if slide == window:
        return panes
    shifts = F.explode(F.sequence(F.lit(0), F.lit(window - slide), F.lit(slide)))
    moved = panes.select(
        "*", shifts.alias("shift")
    ).withColumn(
        "window_start",
        F.timestamp_seconds(F.unix_seconds("window_start") - F.col("shift")),
    )
    return moved.groupBy("window_start", *by).agg(
        *[F.sum(name).alias(name) for name in counts]
    )


def _grouped(log: DataFrame, keys: Sequence[str], window: int | None):
    keys = list(keys)
    if window is not None:
        log = log.withColumn("window_start", pane_start("ts", window))
        keys.append("window_start")
    return log.groupBy(*keys)


def request_counters(
    log: DataFrame, window: int | None = None, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Requests and errors per label set."""
    return _grouped(log, labels, window).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(is_error()).alias("errors")
    )


def latency_histogram(
    log: DataFrame,
    bounds: Sequence[float] = BUCKET_BOUNDS,
    window: int | None = None,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Cumulative bucket counts, request count and duration sum per label set.

    One hash aggregate counts every bound; the last bucket, infinity, holds all rows.
    """
    counted = _grouped(log, labels, window).agg(
        *[F.count_if(F.col("duration_s") <= b).alias(f"le_{i}") for i, b in enumerate(bounds)],
        F.count(F.lit(1)).alias("total_count"),
        duration_sum().alias("total_sum"),
    )
    buckets = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"le_{i}").alias("bucket_count"))
        for i, b in enumerate(bounds)
    ]
    buckets.append(
        F.struct(F.lit(float("inf")).alias("le"), F.col("total_count").alias("bucket_count"))
    )
    keys = [*labels, *(["window_start"] if window is not None else [])]
    return counted.select(*keys, "total_count", "total_sum", F.inline(F.array(*buckets)))


def latency_buckets(
    log: DataFrame, bounds: Sequence[float] = BUCKET_BOUNDS, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Requests per label set whose first matching bucket has this index."""
    index = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        index = F.when(F.col("duration_s") <= bounds[i], i).otherwise(index)
    return log.groupBy(*labels, index.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


def avg_latency(log: DataFrame, window: int | None = None) -> DataFrame:
    """Mean duration over all labels; null without requests."""
    mean = duration_sum() / F.nullif(F.count(F.lit(1)), F.lit(0))
    return _grouped(log, [], window).agg(mean.alias("avg_latency"))


def error_rate(log: DataFrame, window: int | None = None) -> DataFrame:
    """Share of errors over all labels; null without requests."""
    rate = F.count_if(is_error()) / F.nullif(F.count(F.lit(1)), F.lit(0))
    return _grouped(log, [], window).agg(rate.alias("error_rate"))


def requests_in_window(log: DataFrame, at: str | Column, seconds: int) -> DataFrame:
    """Requests of the last ``seconds`` up to and including ``at``."""
    moment = F.to_timestamp(F.lit(at)) if isinstance(at, str) else at
    recent = log.filter(
        (F.col("ts") <= moment)
        & (F.col("ts") > moment - F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)")))
    )
    return recent.agg(F.count(F.lit(1)).alias("requests"))


def histogram_quantile(hist: DataFrame, quantile: float, by: Sequence[str] = ()) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that reaches the rank.

    Buckets are first summed per bound, so a group's list is as long as the bounds. The
    first bucket starts at zero; a rank in the infinite bucket gives the last finite
    bound; groups without requests give null.
    """
    summed = hist.groupBy(*by, "le").agg(F.sum("bucket_count").cast("double").alias("cum"))
    lists = summed.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("le", "cum"))).alias("b"))
    ranked = lists.withColumn("rank", F.element_at("b", -1)["cum"] * quantile)
    ranked = ranked.select(
        *by,
        "rank",
        F.element_at("b", -1)["cum"].alias("total"),
        F.get(F.filter("b", lambda x: x["cum"] >= F.col("rank")), 0).alias("hit"),
        F.try_element_at(F.filter("b", lambda x: x["cum"] < F.col("rank")), F.lit(-1)).alias("below"),
        F.try_element_at(
            F.filter("b", lambda x: x["le"] < F.lit(float("inf"))), F.lit(-1)
        )["le"].alias("last_finite"),
    )
    low = F.coalesce(F.col("below.le"), F.lit(0.0))
    before = F.coalesce(F.col("below.cum"), F.lit(0.0))
    inside = low + (F.col("hit.le") - low) * F.try_divide(
        F.col("rank") - before, F.col("hit.cum") - before
    )
    value = (
        F.when(F.col("total") == 0, F.lit(None))
        .when(F.col("hit.le") == F.lit(float("inf")), F.col("last_finite"))
        .when(F.col("below").isNull() & (F.col("hit.le") <= 0), F.col("hit.le"))
        .otherwise(inside)
    )
    return ranked.select(*by, value.alias("quantile_value"))


def request_rate(
    log: DataFrame, window: int = 300, slide: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Requests per second and per minute of every window."""
    counts = windowed_sums(log, {"requests": F.lit(True)}, by, window, slide)
    rate = F.col("requests") / F.lit(window)
    return counts.select(
        "window_start", *by, rate.alias("per_second"), (rate * 60).alias("per_minute")
    )


def error_ratio(log: DataFrame, window: int = 300, slide: int | None = None) -> DataFrame:
    """Errors by requests, both as rates, with a floor under the request rate."""
    counts = windowed_sums(
        log, {"requests": F.lit(True), "errors": is_error()}, [], window, slide
    )
    ratio = (F.col("errors") / window) / F.greatest(F.col("requests") / window, F.lit(MIN_RATE))
    return counts.select("window_start", ratio.alias("error_ratio"))


def error_ratio_by_class(log: DataFrame, window: int = 300, slide: int | None = None) -> DataFrame:
    """Share of 4xx and of 5xx answers among at least one request."""
    status = F.col("status_code").cast("string")
    counts = windowed_sums(
        log,
        {
            "requests": F.lit(True),
            "client_errors": status.rlike("^4..$"),
            "server_errors": status.rlike("^5..$"),
        },
        [],
        window,
        slide,
    )
    requests = F.greatest(F.col("requests"), F.lit(1))
    return counts.select(
        "window_start",
        (F.col("client_errors") / requests).alias("ratio_4xx"),
        (F.col("server_errors") / requests).alias("ratio_5xx"),
    )
