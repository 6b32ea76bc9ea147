"""Queries over the request log: metrics, counters, alerts, streams."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.catalog.result import plain
from strata.operators import alerts as a
from strata.operators import counters as c
from strata.operators import metrics as m
from strata.operators.filters import match_labels
from strata.operators.ordering import order_labels
from strata.operators.windows import running_bucket_sum, with_previous
from strata.session import path_exists, scratch_path, staged
from strata.sources.request_log import normalize_log, read_request_log, uninstrumented
from strata.sources.synthetic import counter_samples, request_log, request_stream
from strata.streaming.alerts import (
    alert_sink,
    dedup_alerts_stream,
    service_down_stream,
    use_state_store,
)
from strata.streaming.requests import (
    as_alert_metrics,
    every_tick,
    late_requests,
    request_metrics_stream,
)

WINDOW, QUIET = 900, 3600
SILENCE = a.Limits(silent=600)
TICK = 300
STREAM_WINDOW, STREAM_DELAY, STREAM_QUIET = "1 hour", "10 minutes", 4 * 3600
STREAM_SLIDE = "15 minutes"


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_log(request_log(spark, sf_dir))


def le_text(df: DataFrame) -> DataFrame:
    le = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    return df.withColumn("le", le)


def _forecast_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_labels(log_of(spark, sf_dir), path="/api/v1/forecast", status_code="200")


def _quantile(q: float):
    def run(spark, d):
        hist = m.latency_histogram(_forecast_ok(spark, d), window=WINDOW)
        value = m.histogram_quantile(hist, q, ["window_start"])
        return plain(value.withColumn("millis", F.col("quantile_value") * 1000).drop("quantile_value"))

    return run


def quantile_by_path(spark, d):
    hist = m.latency_histogram(log_of(spark, d), labels=["path"])
    return m.histogram_quantile(hist, 0.95, ["path"])


def _metrics(spark, d):
    return a.window_metrics(log_of(spark, d), WINDOW)


def _silence(spark, d):
    log = log_of(spark, d)
    return a.service_down_alerts(log, a.tick_grid(log, TICK), SILENCE)


def _events(spark, d):
    return a.alert_events(a.metric_alerts(_metrics(spark, d)), _silence(spark, d))


def _flat(alerts: DataFrame) -> DataFrame:
    context = F.array_join(
        F.transform(
            F.map_entries("context"),
            lambda e: F.concat(e["key"], F.lit("="), F.format_number(e["value"], 6)),
        ),
        ";",
    )
    return plain(alerts.withColumn("context", context))


def requests_before(spark, d):
    log = log_of(spark, d)
    newest = log.agg(F.max("ts")).scalar()
    return m.requests_in_window(log, newest, 6 * 3600)


def counter_steps(spark, d):
    return plain(with_previous(counter_samples(spark, d), ["series"], 6 * 3600))


def landed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request log as it is read from where it has landed."""
    path = scratch_path(spark, "log")
    request_log(spark, sf_dir).write.parquet(path)
    return plain(read_request_log(spark, path))


def late_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that read come after those that write, where their hour was final by then."""
    log, path = log_of(spark, sf_dir), scratch_path(spark, "late")
    for method in ("POST", "GET"):
        log.filter(F.col("method") == method).write.mode("append").parquet(f"{path}/log")
        stream = read_request_log(spark, f"{path}/log", streaming=True)
        writer = late_requests(stream, STREAM_WINDOW, STREAM_DELAY, path, f"{path}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    late = spark.read.parquet(f"{path}/late")
    return plain(late.groupBy(F.col("window.start").alias("window_start"), "method", "path").agg(
        F.count(F.lit(1)).alias("requests"), F.max("ts").alias("newest")
    ))


def closed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests as a stream, and one a day after the last, which closes all windows."""
    log = log_of(spark, sf_dir)
    last = log.orderBy(F.desc("ts"), *[c for c in log.columns if c != "ts"]).limit(1)
    path = scratch_path(spark, "closing")
    last.withColumn("ts", F.col("ts") + F.expr("interval 1 day")).write.parquet(path)
    closing = spark.readStream.schema(log.schema).parquet(path)
    return normalize_log(request_stream(spark, sf_dir)).union(closing)


def streamed_metrics(spark: SparkSession, sf_dir: str, slide: str | None = None) -> DataFrame:
    """Windowed metrics of the whole log, as a stream writes them."""
    path = scratch_path(spark, "stream")
    metrics = request_metrics_stream(
        closed_stream(spark, sf_dir), STREAM_WINDOW, slide, watermark=STREAM_DELAY
    )
    query = (
        metrics.writeStream.format("parquet")
        .option("path", f"{path}/metrics")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    stored = spark.read.schema(metrics.schema).parquet(f"{path}/metrics")
    return plain(
        stored.select(
            F.col("window.start").alias("window_start"),
            "requests", "errors", "avg_latency", "error_rate",
        )
    )


def streamed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the windowed stream after deduplication, read back from the sink."""
    path = scratch_path(spark, "stream")
    metrics = as_alert_metrics(
        request_metrics_stream(
            closed_stream(spark, sf_dir), STREAM_WINDOW, watermark=STREAM_DELAY
        )
    )
    sink = dedup_alerts_stream(
        a.metric_alerts(metrics), f"{path}/alerts", f"{path}/checkpoint", STREAM_QUIET
    )
    sink.trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.parquet(f"{path}/alerts")
    return plain(stored.select("ts", "key", "severity", "message"))


def _read_all(query: StreamingQuery) -> bool:
    """Whether a batch after the first found no new input."""
    progress = query.lastProgress
    return progress is not None and progress.batchId > 0 and progress.numInputRows == 0


def silent_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the log that a running stream reports as silent once their requests end.

    The log is read as a stream with one seed row per path; the stream is evaluated every
    second and stopped when its input is read and all paths have been reported, however long
    that takes. A stream that ends before raises its error.
    """
    use_state_store(spark)
    path = scratch_path(spark, "silence")
    seeds = log_of(spark, sf_dir).select("path").distinct().withColumn("seed", F.lit(True))
    seeds.write.parquet(f"{path}/seeds")
    requests = normalize_log(request_stream(spark, sf_dir)).select("path", F.lit(False).alias("seed"))
    seeded = requests.union(spark.readStream.schema(seeds.schema).parquet(f"{path}/seeds"))
    alerts = service_down_stream(seeded, "path", a.Limits(silent=2))

    writer = alert_sink(alerts, f"{path}/alerts", f"{path}/checkpoint").outputMode("update")
    query = every_tick(writer, "1 second").start()
    wanted = spark.read.parquet(f"{path}/seeds").count()
    schema = "key string, severity int, message string"
    found = spark.createDataFrame([], schema)
    try:
        while wanted and not (_read_all(query) and found.count() >= wanted):
            if not query.isActive:
                raise query.exception() or RuntimeError("the silence stream has ended")
            time.sleep(1)
            if path_exists(spark, f"{path}/alerts"):
                found = spark.read.schema(schema).parquet(f"{path}/alerts").distinct()
    finally:
        query.stop()
    return found.select("key", "severity", "message")


QUERIES = {
    "request_log": lambda spark, d: plain(log_of(spark, d)),
    "uninstrumented": lambda spark, d: plain(uninstrumented(request_log(spark, d))),
    "match_labels": lambda spark, d: plain(
        match_labels(log_of(spark, d), status_code="=~4..|5..", path="!=/docs", method="GET")
    ),
    "request_counters": lambda spark, d: m.request_counters(log_of(spark, d)),
    "request_counters_by_window": lambda spark, d: plain(
        m.request_counters(log_of(spark, d), WINDOW)
    ),
    "order_labels": lambda spark, d: order_labels(m.request_counters(log_of(spark, d)), m.LABELS),
    "latency_histogram": lambda spark, d: le_text(m.latency_histogram(log_of(spark, d))),
    "running_bucket_sum": lambda spark, d: running_bucket_sum(
        m.latency_buckets(log_of(spark, d)), m.LABELS, "bucket"
    ),
    "avg_latency": lambda spark, d: m.avg_latency(log_of(spark, d)),
    "avg_latency_by_window": lambda spark, d: plain(m.avg_latency(log_of(spark, d), WINDOW)),
    "error_rate": lambda spark, d: m.error_rate(log_of(spark, d)),
    "error_rate_by_window": lambda spark, d: plain(m.error_rate(log_of(spark, d), WINDOW)),
    "requests_in_window": requests_before,
    "histogram_quantile_p50": _quantile(0.5),
    "histogram_quantile_p95": _quantile(0.95),
    "histogram_quantile_by_path": quantile_by_path,
    "request_rate": lambda spark, d: plain(m.request_rate(log_of(spark, d), WINDOW, TICK)),
    "request_rate_by_path": lambda spark, d: plain(
        m.request_rate(log_of(spark, d), WINDOW, TICK, ["path"])
    ),
    "error_ratio": lambda spark, d: plain(m.error_ratio(log_of(spark, d), WINDOW, TICK)),
    "error_ratio_by_class": lambda spark, d: plain(
        m.error_ratio_by_class(log_of(spark, d), WINDOW, TICK)
    ),
    "prev_sample": counter_steps,
    "counter_increase": lambda spark, d: plain(
        c.counter_increase(counter_samples(spark, d), ["series"], 6 * 3600)
    ),
    "counter_rate": lambda spark, d: plain(
        c.counter_increase(counter_samples(spark, d), ["series"], 6 * 3600, per_second=True)
    ),
    "counter_increase_extrapolated": lambda spark, d: plain(
        c.counter_increase(counter_samples(spark, d), ["series"], 6 * 3600, extrapolate=True)
    ),
    "latest_gauge": lambda spark, d: c.latest_gauge(counter_samples(spark, d), ["series"]),
    "window_metrics": lambda spark, d: plain(_metrics(spark, d)),
    "latency_alerts": lambda spark, d: _flat(a.latency_alerts(_metrics(spark, d))),
    "error_rate_alerts": lambda spark, d: _flat(a.error_rate_alerts(_metrics(spark, d))),
    "metric_alerts": lambda spark, d: _flat(a.metric_alerts(_metrics(spark, d))),
    "service_down_alerts": lambda spark, d: _flat(_silence(spark, d)),
    "alert_events": lambda spark, d: _flat(_events(spark, d)),
    "dedup_alerts": lambda spark, d: _flat(
        a.dedup_alerts(staged(spark, _events(spark, d), "alerts"), QUIET)
    ),
    "render_alert": lambda spark, d: plain(
        a.render_alert(_silence(spark, d)).select("ts", "key", "payload")
    ),
    "read_request_log": landed_log,
    "request_metrics_stream": streamed_metrics,
    "request_metrics_stream_sliding": lambda spark, d: streamed_metrics(spark, d, STREAM_SLIDE),
    "late_requests": late_by_hour,
    "dedup_alerts_stream": streamed_alerts,
    "service_down_stream": silent_paths,
}
