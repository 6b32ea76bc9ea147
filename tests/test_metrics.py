import math
from datetime import datetime, timedelta

import numpy as np
import pytest

from strata.operators import counters as c
from strata.operators import metrics as m
from strata.operators.filters import match_labels
from strata.operators.windows import prev_sample, with_previous
from strata.sources.request_log import REQUEST_LOG_SCHEMA, normalize_log, read_request_log

T0 = datetime(2024, 1, 1)


def log_of(spark, *rows):
    return spark.createDataFrame(
        [(T0 + timedelta(seconds=s), "GET", path, status, float(d)) for s, path, status, d in rows],
        REQUEST_LOG_SCHEMA,
    )


def test_log_drops_probes_and_collapses_docs(spark, root):
    log_of(
        spark, (0, "/metrics", 200, 1), (1, "/healthz", 200, 1), (2, "/docs/x", 200, 1),
        (3, "/wells", 403, 1),
    ).write.parquet(f"{root}/log")
    found = read_request_log(spark, f"{root}/log").select("path", "status_code").collect()
    assert sorted(map(tuple, found)) == [("/docs", 200), ("/wells", 403)]


def test_every_status_from_400_is_an_error(spark):
    log = log_of(spark, (0, "/f", 200, 1), (1, "/f", 200, 1), (2, "/w", 403, 1), (3, "/w", 500, 1))
    found = {(r.path, r.status_code): (r.requests, r.errors) for r in m.request_counters(log).collect()}
    assert found == {("/f", 200): (2, 0), ("/w", 403): (1, 1), ("/w", 500): (1, 1)}
    assert m.error_rate(log).first()[0] == 0.5
    assert m.avg_latency(log).first()[0] == 1.0


def test_no_requests_give_null(spark):
    empty = log_of(spark, (0, "/f", 200, 1)).limit(0)
    assert m.error_rate(empty).first()[0] is None
    assert m.avg_latency(empty).first()[0] is None


def test_buckets_are_cumulative_and_inclusive(spark):
    log = log_of(spark, *[(i, "/f", 200, d) for i, d in enumerate((0.004, 0.005, 0.3, 12))])
    rows = m.latency_histogram(log).orderBy("le").collect()
    assert [r.bucket_count for r in rows] == [2] * 6 + [3] * 5 + [4]
    assert math.isinf(rows[-1].le) and rows[0].total_count == 4
    assert rows[0].total_sum == pytest.approx(12.309)


def quantile(spark, counts, q):
    hist = spark.createDataFrame(counts, "le double, bucket_count long")
    return m.histogram_quantile(hist, q).first().quantile_value


INF = float("inf")


@pytest.mark.parametrize(
    "counts, q, expected",
    [
        ([(0.1, 10), (0.5, 20), (INF, 20)], 0.25, 0.05),
        ([(0.1, 10), (0.5, 20), (INF, 20)], 0.75, 0.3),
        ([(0.1, 0), (0.5, 1), (INF, 20)], 0.95, 0.5),
        ([(0.1, 0), (0.5, 0), (INF, 0)], 0.5, None),
        ([(0.1, 4), (0.1, 6), (0.5, 20), (INF, 20)], 0.5, 0.1),
    ],
)
def test_quantiles(spark, counts, q, expected):
    got = quantile(spark, counts, q)
    assert got == (None if expected is None else pytest.approx(expected))


def test_sliding_windows_from_panes_equal_direct_counting(spark):
    rng = np.random.default_rng(1)
    seconds = rng.integers(0, 3600, 400).tolist()
    log = log_of(spark, *[(s, "/f" if s % 3 else "/w", 500 if s % 5 == 0 else 200, 1) for s in seconds])
    got = {r.window_start: r.error_ratio for r in m.error_ratio(log, 300, 60).collect()}
    starts = {T0 + timedelta(seconds=s // 60 * 60 - k * 60) for s in seconds for k in range(5)}
    assert set(got) == starts
    for start in starts:
        inside = [s for s in seconds if start <= T0 + timedelta(seconds=s) < start + timedelta(seconds=300)]
        errors = sum(s % 5 == 0 for s in inside)
        assert got[start] == pytest.approx(errors / len(inside))


def test_rates_and_classes(spark):
    log = log_of(spark, (0, "/f", 200, 1), (10, "/f", 404, 1), (20, "/w", 500, 1), (299, "/w", 200, 1))
    assert m.request_rate(log, 300).first().per_minute == pytest.approx(4 / 5)
    row = m.error_ratio_by_class(log, 300).first()
    assert (row.ratio_4xx, row.ratio_5xx) == (0.25, 0.25)
    by_path = {r.path: r.per_second for r in m.request_rate(log, 300, by=["path"]).collect()}
    assert by_path == {"/f": 2 / 300, "/w": 2 / 300}
    with pytest.raises(ValueError):
        m.request_rate(log, 300, 70)


def test_requests_of_the_last_seconds(spark):
    log = log_of(spark, *[(s, "/f", 200, 1) for s in (0, 10, 11, 40, 41)])
    assert m.requests_in_window(log, "2024-01-01 00:00:40", 30).first().requests == 2


def test_label_matchers(spark):
    log = log_of(spark, (0, "/a", 404, 1), (1, "/b", 503, 1), (2, "/b", 200, 1))
    assert match_labels(log, status_code="=~4..").count() == 1
    assert match_labels(log, status_code="!~2..", path="!=/a").count() == 1
    assert match_labels(log, status_code="=~0").count() == 0


def samples(spark, *points, series="s"):
    return spark.createDataFrame(
        [(series, T0 + timedelta(seconds=s), float(v)) for s, v in points],
        "series string, ts timestamp, value double",
    )


def test_increase_survives_resets_and_window_edges(spark):
    df = samples(spark, (0, 5), (100, 9), (250, 2), (310, 4), (900, 3), (901, 3))
    got = {r.window_start.minute: r.increase for r in c.counter_increase(df, ["series"], 300).collect()}
    assert got == {0: 4 + 2, 5: 2, 15: 3}
    rate = c.counter_increase(df, ["series"], 300, per_second=True).agg({"increase": "sum"}).first()[0]
    assert rate == pytest.approx(11 / 300)


def test_increase_over_windows_adds_up_to_the_whole(spark):
    rng = np.random.default_rng(2)
    points, value = [], 0
    for s in np.sort(rng.choice(20000, 500, replace=False)):
        value = int(rng.integers(0, 3)) if rng.random() < 0.05 else value + int(rng.integers(0, 9))
        points.append((int(s), value))
    whole = sum(b if b < a else b - a for (_, a), (_, b) in zip(points, points[1:]))
    got = c.counter_increase(samples(spark, *points), ["series"], 300).agg({"increase": "sum"}).first()[0]
    assert got == whole


def test_extrapolated_increase(spark):
    df = samples(spark, *[(s, s) for s in range(15, 300, 30)])
    assert c.counter_increase(df, ["series"], 300, extrapolate=True).first().increase == pytest.approx(300)
    single = samples(spark, (10, 5))
    assert c.counter_increase(single, ["series"], 300, extrapolate=True).first().increase is None


def test_newest_gauge(spark):
    df = samples(spark, (0, 9), (5, 1), (5, 2)).union(samples(spark, (1, 7), series="t"))
    assert {r.series: r.value for r in c.latest_gauge(df, ["series"]).collect()} == {"s": 2.0, "t": 7.0}


def test_normalizing_keeps_other_paths(spark):
    log = log_of(spark, (0, "/document", 200, 1), (1, "/docsx", 200, 1))
    assert [r.path for r in normalize_log(log).orderBy("ts").collect()] == ["/document", "/docs"]


def test_previous_values_by_panes_equal_one_sort(spark):
    rows = [(s, T0 + timedelta(seconds=int(t)), float(t)) for s in "ab" for t in (0, 5, 61, 400, 401, 3000)]
    samples = spark.createDataFrame(rows, "series string, ts timestamp, value double")
    got = with_previous(samples, ["series"], 60).collect()
    expected = samples.withColumn("previous", prev_sample(["series"])).collect()
    assert sorted(map(str, got)) == sorted(map(str, expected)) and len(got) == 12
