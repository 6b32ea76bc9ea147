"""Alerts on a stream: deduplication, silence detection, sink."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from strata.operators.alerts import (
    DEDUP_SECONDS,
    Limits,
    dedup_alerts,
    render_alert,
    service_down_columns,
)
from strata.session import (
    delete_path,
    path_names,
    publish_text,
    read_text,
    staged,
    staging_released,
)

STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Below the folder of notified alerts, out of sight of its readers.
STATE = "_state"
_BLOCKED = "key string, until long"


def use_state_store(spark: SparkSession) -> None:
    """Let the streams of a session keep their state where these operators need it."""
    spark.conf.set(STATE_STORE_KEY, STATE_STORE)


def check_state_store(spark: SparkSession) -> None:
    if spark.conf.get(STATE_STORE_KEY, None) != STATE_STORE:
        raise ValueError(f"set {STATE_STORE_KEY} to {STATE_STORE} for stateful alerts")


def dedup_alerts_stream(
    alerts: DataFrame, path: str, checkpoint: str, seconds: int = DEDUP_SECONDS, delay: int = 0
) -> DataStreamWriter:
    """Streaming twin of ``dedup_alerts`` that stores the notified alerts with their payload.

    A micro-batch is deduplicated as a table, so no task holds all alerts of a key. What goes
    on to the next one is a small table: until when each key is blocked. Alerts that come more
    than ``delay`` seconds of their own time after a newer one of an earlier micro-batch are
    dropped, and a key whose quiet period ended before that is forgotten; a next alert of it is
    notified with or without its row. ``path`` belongs to one checkpoint: a micro-batch that is
    repeated after a failure starts from the same table and replaces its own directory.
    """

    def notify(batch: DataFrame, batch_id: int) -> None:
        notify_batch(batch, batch_id, path, seconds, delay)

    return alerts.writeStream.foreachBatch(notify).option("checkpointLocation", checkpoint)


def notify_batch(
    batch: DataFrame, batch_id: int, path: str, seconds: int = DEDUP_SECONDS, delay: int = 0
) -> None:
    """Store the alerts of one micro-batch that are to be notified, and who is blocked then."""
    spark, quiet = batch.sparkSession, seconds * 1_000_000
    with staging_released(spark):
        blocked, newest = blocked_before(spark, path, batch_id)
        came = staged(spark, batch, "new-alerts")
        at = F.unix_micros("ts")
        first = None if newest is None else newest - delay * 1_000_000
        intime = came if first is None else came.filter(at >= first)
        # With a key's alerts before "until" away, the next one is a first alert.
        free = intime.join(blocked, "key", "left").filter(F.col("until").isNull() | (at >= F.col("until")))
        free = staged(spark, free.drop("until"), "free-alerts")
        notified = free if free.isEmpty() else staged(spark, dedup_alerts(free, seconds), "notified")
        _store(notified, path, batch_id)
        times = [t for t in (came.agg(F.max(at)).first()[0], newest) if t is not None]
        newest = max(times, default=None)
        after = blocked.unionByName(notified.select("key", (at + quiet).alias("until")))
        after = after.groupBy("key").agg(F.max("until").alias("until"))
        if newest is not None:
            after = after.filter(F.col("until") > newest - delay * 1_000_000)
        _publish_blocked(spark, path, batch_id, after, newest)


def blocked_before(spark: SparkSession, path: str, batch_id: int) -> tuple[DataFrame, int | None]:
    """Who is blocked until when (microseconds) as a micro-batch starts, and the newest time seen."""
    earlier = [n for n in path_names(spark, f"{path}/{STATE}/after-*") if int(n[6:]) < batch_id]
    if not earlier:
        return spark.createDataFrame([], _BLOCKED), None
    # Written by an earlier micro-batch only, so whole.
    told = json.loads(read_text(spark, f"{path}/{STATE}/{earlier[-1]}"))
    return spark.read.schema(_BLOCKED).parquet(f"{path}/{STATE}/{told['blocked']}"), told["newest"]


def _publish_blocked(
    spark: SparkSession, path: str, batch_id: int, blocked: DataFrame, newest: int | None
) -> None:
    """A table of its own, then the small file that names it; older ones than the last go."""
    folder, name = f"{path}/{STATE}", f"blocked-{batch_id:020d}-{uuid.uuid4().hex}"
    blocked.write.parquet(f"{folder}/{name}")
    publish_text(spark, f"{folder}/after-{batch_id:020d}", json.dumps({"blocked": name, "newest": newest}))
    # A repeat of this micro-batch needs the one before.
    old = [n for n in path_names(spark, f"{folder}/after-*") if int(n[6:]) < batch_id][:-1]
    for number in [n[6:] for n in old]:
        delete_path(spark, f"{folder}/after-{number}")
        for table in path_names(spark, f"{folder}/blocked-{number}-*"):
            delete_path(spark, f"{folder}/{table}")


class _Silence(StatefulProcessor):
    """Re-arms a timer per service and reports every interval without a request."""

    def __init__(self, seconds: int):
        self._seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._seen = handle.getValueState("last_seen_ms", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        started = self._seen.exists()
        requests = sum(int((~batch["seed"]).sum()) for batch in rows)
        if requests or not started:
            self._seen.update((now,))
        if not started:
            self._handle.registerTimer(now + self._seconds * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        self._handle.registerTimer(now + self._seconds * 1000)
        if now - self._seen.get()[0] >= self._seconds * 1000:
            yield pd.DataFrame({"service": [key[0]], "ts": [pd.Timestamp(now, unit="ms")]})

    def close(self) -> None:
        pass


def thin_requests(requests: DataFrame) -> DataFrame:
    """One row per service and input partition; a seed only if all of its rows are.

    ``requests``: service, seed. A task holds one row per service.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            least = rows.group_by("service").aggregate([("seed", "min")])
            kept = least.select(["service", "seed_min"]).rename_columns(["service", "seed"])
            kept = kept.cast(batch.schema)
        if kept is not None:
            yield from kept.to_batches()

    return requests.mapInArrow(run, requests.schema)


def service_down_stream(
    requests: DataFrame, service: str, limits: Limits = Limits()
) -> DataFrame:
    """Alerts for services that stay silent, by processing time.

    ``requests`` holds the service column and a boolean ``seed``: one seed row per
    service starts its clock, so a service that never sends a request is reported too.
    Run it with a processing-time trigger; timers fire without new input.
    """
    check_state_store(requests.sparkSession)
    # The rows of a busy service must not meet in the one task that has its state.
    thinned = thin_requests(requests.select(F.col(service).alias("service"), "seed"))
    silent = thinned.groupBy("service").transformWithStateInPandas(
        statefulProcessor=_Silence(limits.checked().silent),
        outputStructType="service string, ts timestamp",
        outputMode="Update",
        timeMode="ProcessingTime",
    )
    columns = service_down_columns(limits.checked().silent, ["service"])
    return silent.select("ts", *columns)


def alert_sink(alerts: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append notified alerts with their payload, one directory per micro-batch.

    A micro-batch that is repeated after a failure replaces its own directory, so no
    alert is stored twice.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        _store(batch, path, batch_id)

    return alerts.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def _store(alerts: DataFrame, path: str, batch_id: int) -> None:
    render_alert(alerts).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
