"""Versions ranked where they are merged, columns that are not moved, files read as a whole."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from strata.catalog.operations import land_month
from strata.operators.windows import latest_per_key
from strata.session import scratch_root
from strata.sources.csv_text import read_csv_text
from strata.sources.snapshots import Transaction
from strata.sources.tables import read_layer, stage_merge, upsert_newest, upsert_rows, write_layer
from tests.test_scale import _plan

KEYS = ["id_pozo", "periodo"]
SCHEMA = "id_pozo bigint, periodo date, v int, _loaded_at timestamp"


def _rows(spark, *rows):
    return spark.createDataFrame(
        [
            (well, month and date(2024, month, 1), v, day and datetime(2024, 6, day), tie)
            for well, month, v, day, tie in rows
        ],
        SCHEMA + ", tie string",
    )


def test_versions_are_ranked_and_merged_by_one_shuffle(spark):
    target = _rows(
        spark, (1, 1, 1, 1, ""), (1, 1, 2, 1, ""), (2, 1, 3, 9, ""), (4, 1, 4, 1, ""),
        (None, 1, 5, 1, ""), (1, None, 6, 1, ""), (7, 1, 7, 1, ""),
    ).drop("tie")
    versions = _rows(
        spark, (1, 1, 10, 2, "b"), (1, 1, 11, 2, "a"), (1, 1, 12, 1, "a"), (2, 1, 13, 2, "a"),
        # A null time is the newest.
        (3, 2, 14, 2, "a"), (3, 2, 15, None, "a"),
        # The newest version of these is not kept, so neither is an older one.
        (4, 1, -1, 3, "a"), (4, 1, 16, 2, "a"), (5, 1, -2, 3, "a"), (5, 1, 17, 2, "a"),
        (6, 1, None, 2, None), (None, 1, 18, 2, "a"), (None, 1, 19, 3, "a"), (1, None, 20, 2, "a"),
    )
    keep = F.coalesce(F.col("v"), F.lit(0)) >= 0
    merged = upsert_newest(target, versions, KEYS, ["tie"], keep, 2, 4)
    assert _plan(merged).count("Exchange") == 1
    newest = latest_per_key(versions, KEYS, "_loaded_at", ["tie"]).filter(keep).drop("tie")
    want = upsert_rows(target, newest, KEYS)
    assert sorted(merged.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert sorted(str(row.v) for row in merged.collect()) == sorted(
        str(v) for v in (11, 13, 15, 4, 5, 19, 6, 20, 7, None)
    )


def test_derived_columns_are_computed_for_what_is_written(spark, root):
    schema = SCHEMA + ", label string"
    label = F.concat_ws("-", "id_pozo", "v")
    held = _rows(spark, (1, 1, 1, 1, ""), (2, 1, 2, 1, ""), (1, 2, 3, 1, "")).drop("tie")
    write_layer(held.withColumn("label", label), root, "gold", "facts", "periodo")
    batches = set(Path(scratch_root(spark).removeprefix("file:")).glob("strata-batch-*"))
    change = Transaction(spark, root)
    batch = _rows(spark, (2, 1, 5, 2, ""), (3, 1, 6, 2, "")).drop("tie")
    stage_merge(
        change, batch, "gold", "facts", KEYS, schema, unique=True, derived={"label": label}
    )
    change.commit()
    found = read_layer(spark, root, "gold", "facts").select("id_pozo", "v", "label").collect()
    assert sorted(map(tuple, found)) == [(1, 1, "1-1"), (1, 3, "1-3"), (2, 5, "2-5"), (3, 6, "3-6")]
    assert set(Path(scratch_root(spark).removeprefix("file:")).glob("strata-batch-*")) == batches


def test_landed_cells_may_span_lines(spark, tmp_path):
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "AFRICA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "ALGERIA", 0)]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(1, 'a "b"\n \nc', 0)]),
        "part": (
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
            [(1, "well\n1", "Brand#1", "SMALL", 1)],
        ),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
            "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
            "l_returnflag string, l_shipdate timestamp",
            [(1, 1, 1, n, 1.0, 2.0, 0.0, 0.0, "N", datetime(1995, 3, 4)) for n in (1, 2, 5)],
        ),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    production, wells = land_month(spark, str(tmp_path), "dias_produccion in ('1', '2')")
    read = [read_csv_text(spark, x.paths, x.multi_line) for x in (production, wells)]
    reports = read[0].select("idpozo", "empresa", "dias_produccion", "prod_agua").collect()
    assert sorted(map(tuple, reports)) == [
        (" 1 ", 'a "b"\n \nc', n, "0") for n in ("1", "2")
    ]
    assert [row.sigla for row in read[1].collect()] == [" well\n1-1"] * 2
