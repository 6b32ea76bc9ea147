"""Merges by month with one shuffle."""

from __future__ import annotations

from datetime import date, datetime

from strata.sources.bronze import load_bytes, load_months
from strata.sources.snapshots import current
from strata.sources.tables import newer_rows, upsert_rows
from tests.conftest import load_fixture
from tests.test_scale import _plan

KEYS = ["id_pozo", "periodo"]
SCHEMA = "id_pozo bigint, periodo date, v int, _loaded_at timestamp"


def _rows(spark, *rows):
    return spark.createDataFrame(
        [(well, month and date(2024, month, 1), v, datetime(2024, 6, day)) for well, month, v, day in rows],
        SCHEMA,
    )


def test_upsert_moves_rows_once_and_keeps_rows_without_a_key(spark):
    target = _rows(spark, (1, 1, 1, 1), (1, 1, 2, 1), (2, 1, 3, 1), (None, 1, 4, 1), (1, None, 5, 1))
    source = _rows(spark, (1, 1, 10, 2), (None, 1, 11, 2), (1, None, 12, 2), (3, 2, 13, 2))
    merged = upsert_rows(target, source, KEYS, 2, 4)
    assert _plan(merged).count("Exchange") == 1
    old = target.join(source.select(*KEYS), KEYS, "left_anti").select(*target.columns).unionByName(source)
    assert sorted(merged.collect(), key=repr) == sorted(old.collect(), key=repr)


def test_newer_rows_replace_older_ones_only(spark):
    target = _rows(spark, (1, 1, 1, 2), (2, 1, 2, 2), (None, 1, 3, 1))
    source = _rows(spark, (1, 1, 10, 1), (2, 1, 11, 3), (3, 1, 12, 1), (None, 1, 13, 2))
    merged = newer_rows(target, source, KEYS, 1, 4)
    assert _plan(merged).count("Exchange") == 1
    assert sorted(row.v for row in merged.collect()) == [1, 11, 12, 13]


def test_manifest_tells_months_and_bytes_of_loads(spark, root):
    load_fixture(spark, root)
    held = current(spark, root)
    assert load_months(held, "produccion_raw") == 2
    assert load_months(held, "pozos_raw") == 1
    assert load_bytes(held, "produccion_raw") > 0
