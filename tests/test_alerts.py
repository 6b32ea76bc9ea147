import json
from datetime import datetime, timedelta

import numpy as np
import pytest

from strata.operators import alerts as a
from strata.operators.forecast import decline_forecast, forecast_rejects, wells_for_date
from strata.sources.request_log import REQUEST_LOG_SCHEMA

T0 = datetime(2024, 1, 1)


def metrics(spark, latency=None, errors=None):
    return spark.createDataFrame([(T0, latency, errors)], "ts timestamp, avg_latency double, error_rate double")


@pytest.mark.parametrize(
    "latency, message", [(3.5, None), (5.0, None), (None, None),
                         (5.001, "API latency exceeded 5.0s: 5.00s"),
                         (6.5, "API latency exceeded 5.0s: 6.50s")],
)
def test_latency_threshold_is_strict(spark, latency, message):
    rows = a.latency_alerts(metrics(spark, latency)).collect()
    assert [r.message for r in rows] == ([] if message is None else [message])
    if rows:
        assert (rows[0].severity, rows[0].key) == (3, "latency:active")
        assert rows[0].context == {"current_latency": latency, "threshold": 5.0}


@pytest.mark.parametrize(
    "rate, message", [(0.02, None), (0.05, None), (None, None),
                      (0.08, "Error rate exceeded 5.0%: 8.00%")],
)
def test_error_rate_threshold_is_strict(spark, rate, message):
    rows = a.error_rate_alerts(metrics(spark, None, rate)).collect()
    assert [r.message for r in rows] == ([] if message is None else [message])
    both = a.metric_alerts(metrics(spark, 7.2, rate)).collect()
    assert len(both) == 1 + len(rows)


@pytest.mark.parametrize(
    "wrong", [{"slow": 0}, {"failing": 1.1}, {"failing": -0.1}, {"silent": 0}],
)
def test_thresholds_are_validated(wrong):
    with pytest.raises(ValueError):
        a.Limits(**wrong).checked()
    assert a.Limits() == (5.0, 0.05, 30)


def requests(spark, *seconds, path="/f"):
    return spark.createDataFrame(
        [(T0 + timedelta(seconds=s), "GET", path, 200, 0.1) for s in seconds], REQUEST_LOG_SCHEMA
    )


def test_silent_ticks(spark):
    log = requests(spark, 0, 5, 30, 100, 100.5)
    down = a.service_down_alerts(log, a.tick_grid(log, 10))
    assert sorted((r.ts - T0).seconds for r in down.collect()) == [60, 70, 80, 90]
    row = down.first()
    assert (row.severity, row.key) == (4, "service_down:active")
    assert row.context == {"downtime_threshold_seconds": 30.0, "requests_in_window": 0.0}


def test_silence_equals_counting_per_tick(spark):
    rng = np.random.default_rng(3)
    seconds = np.round(rng.uniform(0, 5000, 150), 3).tolist()
    ticks = np.round(rng.uniform(0, 5000, 300), 3).tolist()
    grid = spark.createDataFrame([(T0 + timedelta(seconds=t),) for t in ticks], "ts timestamp")
    got = a.service_down_alerts(requests(spark, *seconds), grid, a.Limits(silent=37))
    at = np.array(seconds)
    expected = {T0 + timedelta(seconds=t) for t in ticks if not ((at <= t) & (at > t - 37)).any()}
    assert {r.ts for r in got.collect()} == expected


def alerts_at(spark, *points):
    rows = [
        (T0 + timedelta(seconds=s), "latency", 3, "active", f"m{i}", {"x": 1.0}, key)
        for i, (key, s) in enumerate(points)
    ]
    return spark.createDataFrame(rows, a.ALERT_SCHEMA)


def test_quiet_period_runs_from_the_last_notified_alert(spark):
    seconds = (0, 30, 270, 300, 330, 610)
    points = [(key, s) for key in ("latency:active", "latency:resolved") for s in seconds]
    got = a.dedup_alerts(alerts_at(spark, *points), 300).collect()
    for key in ("latency:active", "latency:resolved"):
        assert sorted((r.ts - T0).seconds for r in got if r.key == key) == [0, 300, 610]


@pytest.mark.parametrize("spacing, fan_out", [(3, 2), (40, 4), (700, 3), (5000, 64)])
def test_dedup_by_stretches_equals_a_walk_in_order(spark, spacing, fan_out, monkeypatch):
    monkeypatch.setattr(a, "FAN_OUT", fan_out)
    rng = np.random.default_rng(spacing)
    points = [
        (key, float(s))
        for key in ("a", "b", "c")
        for s in np.round(np.cumsum(rng.exponential(spacing, 400)), 1)
    ]
    points += points[:50]
    expected = set()
    for key in ("a", "b", "c"):
        last = None
        for s in sorted({s for k, s in points if k == key}):
            at = T0 + timedelta(seconds=s)
            if last is None or at - last >= timedelta(seconds=300):
                expected.add((key, at))
                last = at
    chosen = a.dedup_alerts(alerts_at(spark, *points), 300)
    got = chosen.collect()
    assert {(r.key, r.ts) for r in got} == expected and len(got) == len(expected)
    assert "Pandas" not in chosen._jdf.queryExecution().executedPlan().toString()


def test_dedup_of_no_alerts_and_of_times_before_1970(spark):
    assert a.dedup_alerts(alerts_at(spark, ("k", 0)).limit(0)).collect() == []
    early = alerts_at(spark, *[("k", -2e9 + s) for s in (0, 100, 299, 300, 599.5, 601)])
    assert len(a.dedup_alerts(early, 300).collect()) == 3


def test_payload(spark):
    rows = a.render_alert(a.latency_alerts(metrics(spark, 7.25))).collect()
    payload = json.loads(rows[0].payload)
    assert payload["text"] == "Alert: Latency - API latency exceeded 5.0s: 7.25s"
    header, body, context = payload["blocks"]
    assert header["text"] == {"type": "plain_text", "text": "🔴 Alert: Latency"}
    assert body["text"]["text"] == "*Status:* active\n*Message:* API latency exceeded 5.0s: 7.25s"
    assert context["text"]["text"] == "*Context:*\n• *current_latency:* 7.25\n• *threshold:* 5.0"


def test_payload_without_context(spark):
    bare = alerts_at(spark, ("k", 0)).withColumn("context", a.F.lit(None).cast("map<string,double>"))
    payload = json.loads(a.render_alert(bare.withColumn("severity", a.F.lit(9))).first().payload)
    assert len(payload["blocks"]) == 2
    assert payload["blocks"][0]["text"]["text"] == "⚠️ Alert: Latency"


WELLS = [("POZO-001", 1200.0), ("POZO-002", 980.0), ("POZO-003", 760.0)]


def forecast(spark, well, start, end):
    wells = spark.createDataFrame(WELLS, "id_well string, base_rate double")
    asked = spark.createDataFrame([(well, start, end)], "id_well string, s string, e string").selectExpr(
        "id_well", "date(s) as date_start", "date(e) as date_end"
    )
    daily = decline_forecast(wells, asked).orderBy("date").collect()
    return [r.oil_bopd for r in daily], [r.reason for r in forecast_rejects(asked, wells).collect()]


def test_forecast(spark):
    assert forecast(spark, "POZO-001", "2025-02-10", "2025-02-12") == ([1200.0, 1192.5, 1185.0], [])
    assert forecast(spark, "POZO-002", "2025-02-10", "2025-02-10") == ([980.0], [])
    long, _ = forecast(spark, "POZO-003", "2026-01-01", "2026-06-01")
    assert len(long) == 152 and min(long) == 0 and long[101] > 0 and not any(long[102:])
    assert forecast(spark, "POZO-999", "2025-02-10", "2025-02-10") == ([], ["unknown well"])
    assert forecast(spark, "POZO-001", "2025-02-10", "2025-02-09") == ([], ["date_end before date_start"])


def test_wells_of_a_day(spark):
    dim = spark.sql(
        """select * from values (1, 'a', timestamp '2024-01-02 10:00:00', cast(null as timestamp)),
        (2, 'b', timestamp '2024-01-01 00:00:00', timestamp '2024-01-02 00:00:00')
        as t(id_pozo, sigla, valid_from, valid_to)"""
    )
    assert [r.sigla for r in wells_for_date(dim, "2024-01-02").collect()] == ["a"]
    assert [r.sigla for r in wells_for_date(dim, "2024-01-01").collect()] == ["b"]
