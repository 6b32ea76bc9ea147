"""Windowed request metrics on a stream."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from strata.operators.metrics import DURATION_TYPE, is_error
from strata.session import path_exists

# Fixed value: time between two evaluations.
TICK_TRIGGER = "30 seconds"


def request_metrics_stream(
    stream: DataFrame,
    window: str = "5 minutes",
    slide: str | None = None,
    watermark: str = "10 minutes",
    by: Sequence[str] = (),
) -> DataFrame:
    """Requests, errors, mean latency and error rate per event-time window.

    A window is final once the watermark has passed its end; later rows are dropped and
    counted by ``LateRows``, or split off by ``late_requests``. Sliding windows are summed from
    panes as long as the slide, in a second stateful step, so a request is counted once and
    only the few pane rows are repeated.
    """
    sums = {
        "requests": F.count(F.lit(1)),
        "errors": F.count_if(is_error()),
        "duration": F.sum(F.col("duration_s").cast(DURATION_TYPE)),
    }
    timed = stream.withWatermark("ts", watermark)
    summed = timed.groupBy(F.window("ts", slide or window).alias("window"), *by).agg(
        *[value.alias(name) for name, value in sums.items()]
    )
    if slide is not None and slide != window:
        summed = summed.groupBy(F.window("window", window, slide).alias("window"), *by).agg(
            *[F.sum(name).alias(name) for name in sums]
        )
    return summed.select(
        "window", *by, "requests", "errors",
        (F.col("duration").cast("double") / F.col("requests")).alias("avg_latency"),
        (F.col("errors") / F.col("requests")).alias("error_rate"),
    )


def late_requests(
    stream: DataFrame, window: str, watermark: str, path: str, checkpoint: str
) -> DataStreamWriter:
    """Store the requests that come after their window was final, by micro-batch.

    A request is late where the end of its window is not after the watermark: the newest time
    of all earlier micro-batches less the delay, as for ``request_metrics_stream``. Rows go to
    ``path``/late with their window; what the watermark was made from is kept beside them per
    micro-batch, so one that is repeated after a failure replaces its own output.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = f"{path}/seen"
        before = spark.range(0).select(F.lit(None).cast("timestamp").alias("ts"))
        if batch_id and path_exists(spark, f"{seen}/batch={batch_id - 1}/_SUCCESS"):
            before = spark.read.parquet(f"{seen}/batch={batch_id - 1}")
        newest = before.agg(F.max("ts").alias("ts")).first()["ts"]
        newest = F.lit(newest).cast("timestamp")
        bound = newest - F.expr(f"interval {watermark}")
        late = batch.withColumn("window", F.window("ts", window)).filter(F.col("window.end") <= bound)
        late.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        batch.agg(F.greatest(F.max("ts"), newest).alias("ts")).write.mode("overwrite").parquet(
            f"{seen}/batch={batch_id}"
        )

    return stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)


def as_alert_metrics(metrics: DataFrame) -> DataFrame:
    """Windowed metrics with the time the detectors stamp on alerts.

    ``window_time`` is the last instant of a window and carries the watermark on to a
    further stateful operator.
    """
    return metrics.select(
        F.window_time("window").alias("ts"), "requests", "avg_latency", "error_rate"
    )


def every_tick(writer: DataStreamWriter, interval: str = TICK_TRIGGER) -> DataStreamWriter:
    """Evaluate a stream at the interval alerts are checked."""
    return writer.trigger(processingTime=interval)


class LateRows(StreamingQueryListener):
    """Counts the rows that the watermark made queries drop, over their whole life.

    Add it to a session's ``streams`` before the queries start; what a query keeps of its
    own progress is only the newest part.
    """

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._dropped[str(event.progress.id)] += sum(
            operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def count(self, query: StreamingQuery) -> int:
        """Rows dropped so far by all runs of a query, which share its id."""
        return self._dropped[str(query.id)]
