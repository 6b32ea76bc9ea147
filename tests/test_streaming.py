import random
import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import functions as F

from strata.operators import alerts as a
from strata.plans.silver import STG_PRODUCCION_SCHEMA
from strata.session import path_names, scratch_root
from strata.sources.snapshots import Snapshot, current
from strata.sources.request_log import REQUEST_LOG_SCHEMA, read_request_log
from strata.streaming.alerts import (
    STATE,
    blocked_before,
    dedup_alerts_stream,
    notify_batch,
    service_down_stream,
)
from strata.streaming.ingest import incremental_ingest, merge_new_loads
from strata.streaming.requests import (
    LateRows,
    as_alert_metrics,
    every_tick,
    late_requests,
    request_metrics_stream,
)
from tests.conftest import load, production

T0 = datetime(2024, 1, 1)


def write_log(spark, path, seconds, duration=6.0):
    rows = [(T0 + timedelta(seconds=s), "GET", "/f", 200, duration) for s in seconds]
    spark.createDataFrame(rows, REQUEST_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_alerts_keep_their_quiet_period_across_runs(spark, root):
    """30 s windows that all alert, arriving in two runs; the state carries over."""
    log, sink, checkpoint = f"{root}/log", f"{root}/alerts", f"{root}/checkpoint"

    def start():
        metrics = request_metrics_stream(
            read_request_log(spark, log, streaming=True), "30 seconds", watermark="0 seconds"
        )
        alerts = a.metric_alerts(as_alert_metrics(metrics))
        return run(dedup_alerts_stream(alerts, sink, checkpoint, 300))

    write_log(spark, log, range(0, 400, 10))
    start()
    write_log(spark, log, range(400, 700, 10))
    start()
    write_log(spark, log, [5000], duration=0.1)
    start()
    got = spark.read.parquet(sink).collect()
    batch = a.window_metrics(spark.read.parquet(log).filter("duration_s > 1"), 30)
    expected = a.dedup_alerts(a.metric_alerts(batch), 300).collect()
    assert sorted(r.ts + timedelta(microseconds=1) for r in got) == sorted(r.ts for r in expected)
    assert len(got) == 3 and all("payload" in r for r in got)


def alert_rows(spark, rows):
    """Alerts of (key, second, message)."""
    return spark.createDataFrame(
        [(k, T0 + timedelta(seconds=s), "latency", 2, "active", m, {"v": 1.0}) for k, s, m in rows],
        "key string, ts timestamp, alert_type string, severity int, status string, message string, "
        "context map<string,double>",
    )


def walked(batches, quiet, delay):
    """Notified (key, second, message), batch by batch, with every key remembered for ever."""
    last, newest, found = {}, None, []
    for batch in batches:
        first = float("-inf") if newest is None else newest - delay
        for k, s, m in sorted(batch):
            if s >= first and (k not in last or s - last[k] >= quiet):
                last[k] = s
                found.append((k, s, m))
        newest = max([s for _, s, _ in batch] + ([] if newest is None else [newest]), default=None)
    return sorted(found)


def test_micro_batches_of_alerts_equal_a_walk(spark, root):
    """A hot key, keys out of order, late alerts, ties, an empty micro-batch and a repeated one."""
    draw, quiet, delay = random.Random(3), 50, 20
    batches = [
        [
            (draw.choice(["hot"] * 4 + ["a", "b"]), draw.randint(200 * n - 30, 200 * n + 190), draw.choice("xy"))
            for _ in range(60)
        ]
        for n in range(3)
    ]
    batches.insert(1, [])
    batches.append([("b", 5000, "late"), ("c", 5000, "x")])
    batches.append([("a", 4985, "in time"), ("hot", 4979, "too late"), ("c", 5040, "blocked"), ("c", 5050, "x")])
    path = f"{root}/alerts"
    scratch = f"{scratch_root(spark)}/strata-*"
    before = path_names(spark, scratch)
    for number, batch in enumerate(batches):
        for _ in range(2 if number in (0, 3) else 1):
            notify_batch(alert_rows(spark, batch), number, path, quiet, delay)
    assert path_names(spark, scratch) == before
    got = spark.read.parquet(path).collect()
    assert sorted((r.key, (r.ts - T0).total_seconds(), r.message) for r in got) == walked(batches, quiet, delay)
    assert all(r.payload for r in got)
    # Keys whose quiet period is over are forgotten; the state of the last two batches stays.
    blocked, newest = blocked_before(spark, path, len(batches))
    assert {r.key for r in blocked.collect()} == {"a", "b", "c"}
    assert newest == int(T0.replace(tzinfo=timezone.utc).timestamp() + 5050) * 1_000_000
    assert len(path_names(spark, f"{path}/{STATE}/after-*")) == 2


def test_late_requests_are_dropped_and_counted(spark, root):
    log, out, checkpoint = f"{root}/log", f"{root}/out", f"{root}/checkpoint"

    def start():
        metrics = request_metrics_stream(
            read_request_log(spark, log, streaming=True), "1 minute", watermark="1 minute"
        )
        return run(
            metrics.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        )

    late = LateRows()
    spark.streams.addListener(late)
    try:
        write_log(spark, log, [0, 10, 600])
        assert late.count(start()) == 0
        write_log(spark, log, [20, 1200])
        query = start()
        deadline = time.time() + 30
        while late.count(query) < 1 and time.time() < deadline:
            time.sleep(0.2)  # progress comes to the listener a moment later
        assert late.count(query) == 1
    finally:
        spark.streams.removeListener(late)
    stored = spark.read.parquet(out).orderBy("window.start").collect()
    assert [(r.window.start, r.requests) for r in stored] == [(T0, 2), (T0 + timedelta(seconds=600), 1)]


def test_sliding_windows_are_summed_from_panes(spark, root):
    log, out, checkpoint = f"{root}/log", f"{root}/out", f"{root}/checkpoint"
    write_log(spark, log, [0, 10, 70, 130, 190, 250, 250, 9000], duration=2.0)
    metrics = request_metrics_stream(
        read_request_log(spark, log, streaming=True), "3 minutes", "1 minute", "0 seconds"
    )
    query = run(metrics.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))
    # Two stateful steps; no request is multiplied, so the second one sees panes only.
    states = query.lastProgress.stateOperators
    assert len(states) == 2
    got = {(r.window.start - T0).total_seconds(): (r.requests, r.avg_latency) for r in spark.read.parquet(out).collect()}
    at = [0, 10, 70, 130, 190, 250, 250]
    expected = {}
    for start in range(-120, 300, 60):
        n = sum(start <= s < start + 180 for s in at)
        if n:
            expected[float(start)] = (n, 2.0)
    assert {k: v for k, v in got.items() if k < 8000} == expected


def test_late_requests_are_stored_and_a_repeated_batch_replaces_its_own(spark, root):
    log, checkpoint = f"{root}/log", f"{root}/checkpoint"
    out = f"{root}/out"

    def start(to=checkpoint):
        return run(late_requests(read_request_log(spark, log, streaming=True), "1 minute", "1 minute", out, to))

    write_log(spark, log, [0, 10, 600])
    start()
    write_log(spark, log, [20, 479, 480, 1200])
    start()
    for _ in range(2):
        late = spark.read.parquet(f"{out}/late").orderBy("ts").collect()
        # The watermark is 540: windows that end by then are final.
        assert [(r.ts - T0).seconds for r in late] == [20, 479, 480]
        # The last batch again, as after a lost driver: its mark of success is gone.
        for name in ("commits/1", "commits/.1.crc"):
            (Path(checkpoint) / name).unlink(missing_ok=True)
        start()


def test_a_silent_service_is_reported_without_new_input(spark, root):
    rows = [("quiet", True), ("talking", True), ("talking", False)]
    spark.createDataFrame(rows, "service string, seed boolean").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("service string, seed boolean").parquet(f"{root}/in")
    alerts = service_down_stream(stream, "service", a.Limits(silent=2))
    writer = (
        alerts.writeStream.format("memory").queryName("silence").outputMode("update")
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    query = every_tick(writer, "1 second").start()
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            seen = spark.table("silence").groupBy("key").count().filter("count >= 2").count()
            if seen == 2:
                break
            time.sleep(1)
        found = spark.table("silence").groupBy("key").agg(F.count("*").alias("n")).collect()
    finally:
        query.stop()
    counts = {r.key: r.n for r in found}
    assert set(counts) == {"quiet:service_down:active", "talking:service_down:active"}
    assert min(counts.values()) >= 2


def test_loads_are_ingested_once_with_the_columns_they_bring(spark, root, monkeypatch):
    """A column that comes while the stream runs is read; other months are not."""
    first = production(spark, {"area": "Old"}, {"mes": "2"}).drop("tipo_recurso")
    load(first, root, "produccion_raw", "2024-02", datetime(2024, 2, 10))
    query = incremental_ingest(spark, root, "produccion_raw", f"{root}/checkpoint").trigger(
        processingTime="200 milliseconds"
    ).start()

    def wait_for(gas):
        deadline = time.time() + 60
        while time.time() < deadline:
            held = current(spark, root)
            if "silver/stg_produccion" in held.tables:
                rows = held.read("silver/stg_produccion", STG_PRODUCCION_SCHEMA).collect()
                if {float(r.prod_gas) for r in rows} == gas:
                    return {str(r.periodo): r for r in rows}
            time.sleep(0.2)
        raise AssertionError("not ingested")

    try:
        assert wait_for({59.94})["2024-01-01"].tipo_recurso == "SIN DATO"
        february = current(spark, root).parts("silver/stg_produccion")["periodo=2024-02-01"]
        load(production(spark, {"prod_gas": "7"}), root, "produccion_raw", "2024-03", datetime(2024, 3, 10))
        found = wait_for({59.94, 7.0})
        assert found["2024-01-01"].tipo_recurso == "SHALE" and found["2024-02-01"].tipo_recurso == "SIN DATO"
    finally:
        query.stop()
    assert current(spark, root).parts("silver/stg_produccion")["periodo=2024-02-01"] == february
    assert merge_new_loads(spark, root, "produccion_raw") == []
    # An older load brings no row of a key that silver has, and reads the months it is about.
    load(production(spark, {"prod_gas": "1"}, {"mes": "3"}), root, "produccion_raw", "2024-01", datetime(2024, 1, 10))
    read = []
    from_table = Snapshot.read

    def noted(self, table, schema=None, keys=None):
        read.append((table, None if keys is None else tuple(keys)))
        return from_table(self, table, schema, keys)

    monkeypatch.setattr(Snapshot, "read", noted)
    assert len(merge_new_loads(spark, root, "produccion_raw")) == 1
    monkeypatch.undo()
    assert ("silver/stg_produccion", ("periodo=2024-01-01",)) in read
    assert ("bronze/produccion_raw", ("_load_period=2024-01",)) in read
    assert set(wait_for({59.94, 7.0})) == {"2024-01-01", "2024-02-01", "2024-03-01"}
