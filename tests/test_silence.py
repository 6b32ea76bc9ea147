from __future__ import annotations

import itertools
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strata.catalog import observability
from strata.streaming import alerts
from tests.conftest import SF_DIR


def test_silence_stream_reports_every_path_however_late(spark, monkeypatch):
    """A clock that leaps ahead stands for a first batch that takes long."""
    leaps = itertools.count(0, 1000)
    clock = SimpleNamespace(sleep=time.sleep, monotonic=lambda: next(leaps))
    monkeypatch.setattr(observability, "time", clock)
    paths = observability.log_of(spark, SF_DIR).select("path").distinct().count()
    assert observability.silent_paths(spark, SF_DIR).count() == paths > 1


def test_a_silence_stream_that_dies_raises(spark, monkeypatch):
    def broken(requests, service, limits):
        return requests.select(
            F.raise_error(F.lit("broken")).cast("string").alias("key"),
            F.lit(1).alias("severity"), F.lit("").alias("message"),
        )

    monkeypatch.setattr(observability, "service_down_stream", broken)
    with pytest.raises(Exception, match="broken"):
        observability.silent_paths(spark, SF_DIR).collect()


def test_requests_are_thinned_before_the_state(spark):
    service = F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") == 2, "quiet")
    rows = spark.range(30_000, numPartitions=4).select(
        service.alias("service"), (F.col("id") % 3 != 0).alias("seed")
    )
    thin = alerts.thin_requests(rows)
    assert thin.schema == rows.schema
    got = sorted(((r.service or "", r.seed) for r in thin.collect()))
    assert got == [("", True)] * 4 + [("hot", False)] * 4 + [("quiet", True)]
