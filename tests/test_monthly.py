from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.plans import monthly, quality
from strata.plans.gold import GOLD_SCHEMAS
from strata.plans.silver import STG_PRODUCCION_SCHEMA, stg_produccion
from strata.session import child_directories
from strata.sources import tables
from strata.sources.snapshots import Transaction
from strata.sources.tables import DuplicateKeyError, merge_upsert, read_layer, write_layer
from tests.conftest import PRODUCTION_COLUMNS, PRODUCTION_ROWS, bronze, load, load_fixture, production, text_frame

NOW = datetime(2024, 3, 20)
KEYS = ["id_pozo", "periodo"]


def silver(spark, root):
    return read_layer(spark, root, "silver", "stg_produccion", STG_PRODUCCION_SCHEMA)


def fact(spark, root):
    return read_layer(spark, root, "gold", "fct_produccion", GOLD_SCHEMAS["fct_produccion"])


def gas(df, well=135204, month="2024-01-01"):
    found = df.filter((F.col("id_pozo") == well) & (F.col("periodo") == F.lit(month).cast("date")))
    return [float(row.prod_gas) for row in found.collect()]


def merge_load(spark, root, df, period, at, reprocess=None):
    load(df, root, "produccion_raw", period, at)
    change = Transaction(spark, root)
    monthly._reports(change, reprocess, False)
    change.commit()


def test_a_correction_replaces_and_a_negative_one_keeps_the_old_row(spark, root):
    merge_load(spark, root, production(spark, {"prod_gas": "10"}), "a", datetime(2024, 2, 1))
    merge_load(spark, root, production(spark, {"prod_gas": "12"}), "b", datetime(2024, 3, 1))
    assert gas(silver(spark, root)) == [12.0]
    merge_load(spark, root, production(spark, {"prod_gas": "-1"}), "c", datetime(2024, 4, 1))
    assert gas(silver(spark, root)) == [12.0]
    assert stg_produccion(bronze(spark, root)).count() == 0


def test_a_target_without_rows_takes_only_the_reprocessed_month(spark, root):
    write_layer(
        spark.createDataFrame([], STG_PRODUCCION_SCHEMA), root, "silver", "stg_produccion", "periodo"
    )
    rows = production(spark, {}, {"mes": "2"})
    merge_load(spark, root, rows, "a", datetime(2024, 2, 1))
    assert silver(spark, root).count() == 0
    merge_load(spark, root, rows, "a", datetime(2024, 2, 1), reprocess="2024-02-01")
    assert [r.periodo for r in silver(spark, root).collect()] == [date(2024, 2, 1)]


def test_merging_leaves_other_months_alone(spark, root):
    def files(month):
        return {f for f in silver(spark, root).inputFiles() if f"periodo={month}" in f}

    merge_load(spark, root, production(spark, {}, {"mes": "2"}), "a", datetime(2024, 2, 1))
    january, february = files("2024-01-01"), files("2024-02-01")
    merge_load(spark, root, production(spark, {"prod_gas": "1"}), "b", datetime(2024, 3, 1))
    assert files("2024-02-01") == february and not files("2024-01-01") & january


def test_repeated_source_keys_are_an_error(spark, root):
    one = spark.createDataFrame([], STG_PRODUCCION_SCHEMA)
    write_layer(one, root, "silver", "stg_produccion", "periodo")
    load(production(spark, {}), root, "produccion_raw", "a", datetime(2024, 2, 1))
    batch = stg_produccion(bronze(spark, root))
    with pytest.raises(DuplicateKeyError):
        merge_upsert(
            batch.union(batch), root, "silver", "stg_produccion", KEYS, STG_PRODUCCION_SCHEMA
        )


def test_a_late_well_needs_its_month_reprocessed(spark, root):
    from tests.conftest import WELL_ROWS

    load_fixture(spark, root, wells=WELL_ROWS[1:])
    monthly.transform(spark, root, now=NOW)
    assert gas(fact(spark, root)) == []
    load_fixture(spark, root, period="2024-02", at=datetime(2024, 3, 2), rows=PRODUCTION_ROWS[3:])
    monthly.transform(spark, root, now=NOW)
    assert gas(fact(spark, root)) == []
    monthly.transform(spark, root, reprocess="2024-01-01", now=NOW)
    assert gas(fact(spark, root)) == [59.94]
    assert gas(fact(spark, root), month="2024-02-01") == []


def test_an_impossible_day_count_is_stored_and_stops_the_run(spark, root):
    bad = [tuple("999" if c == "dias_produccion" else v for c, v in zip(PRODUCTION_COLUMNS, PRODUCTION_ROWS[0]))]
    load_fixture(spark, root, rows=bad + PRODUCTION_ROWS[1:])
    with pytest.raises(quality.QualityGateError) as stopped:
        monthly.transform(spark, root, now=NOW)
    assert stopped.value.tests == ["between_fct_produccion_dias_produccion"]
    stored = tables.stored_failures(spark, root)
    assert [r.dias_produccion for r in stored["between_fct_produccion_dias_produccion"].collect()] == [999]
    # Nothing of the run that failed is published, and nothing of it is left.
    for layer, name in (("silver", "stg_produccion"), ("gold", "fct_produccion")):
        assert not tables.layer_exists(spark, root, layer, name)
        assert child_directories(spark, f"{root}/{layer}/{name}", "*") == []
    load_fixture(spark, root, at=datetime(2024, 3, 2))
    monthly.transform(spark, root, now=NOW)
    assert fact(spark, root).count() == 4
    # The test passes again, so its failures are gone.
    assert tables.stored_failures(spark, root) == {}


def test_a_stale_source_stops_before_silver(spark, root):
    load_fixture(spark, root)
    with pytest.raises(quality.StaleSourceError):
        monthly.transform(spark, root, now=datetime(2024, 5, 10))
    assert not tables.layer_exists(spark, root, "silver", "stg_produccion")


def test_a_silver_failure_keeps_gold_unbuilt(spark, root):
    rows = [tuple("" if c == "prod_pet" else v for c, v in zip(PRODUCTION_COLUMNS, PRODUCTION_ROWS[0]))]
    load_fixture(spark, root, rows=rows)
    with pytest.raises(quality.QualityGateError, match="not_null_stg_produccion_prod_petroleo"):
        monthly.transform(spark, root, now=NOW)
    assert not tables.layer_exists(spark, root, "gold", "dim_pozo")


def test_running_a_period_from_csv_twice_converges(spark, root, tmp_path):
    from tests.conftest import WELL_COLUMNS, WELL_ROWS

    def land(name, columns, rows):
        path = str(tmp_path / name)
        text_frame(spark, columns, rows).coalesce(1).write.option("header", True).csv(path)
        return monthly.Landed(path, f"file:{name}", name)

    production_csv = land("production", PRODUCTION_COLUMNS, PRODUCTION_ROWS)
    wells_csv = land("wells", WELL_COLUMNS, WELL_ROWS)
    results = []
    for hour in (1, 2):
        star = monthly.run_period(
            spark, root, "2024-01-01", production_csv, wells_csv,
            loaded_at=datetime(2024, 3, 1, hour), now=NOW,
        )
        results.append(sorted(map(tuple, star.fct_produccion.drop("_loaded_at").collect())))
    assert results[0] == results[1] and len(results[0]) == 4
    checks = {r.check_name: r.value for r in monthly.verify_reload(spark, root, "2024-01-01").collect()}
    assert checks == {
        "rows_produccion_raw": "4", "rows_pozos_raw": "3", "duplicate_grain": "0", "fact_rows": "3",
        "last_loaded_at": "2024-03-01 02:00:00",
    }


def test_periods(spark):
    assert monthly.months(spark, "2026-01-01", "2026-03-01") == ["2026-01-01", "2026-02-01", "2026-03-01"]
    assert monthly.latest_closed_period(date(2026, 6, 1)) == "2026-05-01"
    assert monthly.latest_closed_period(date(2026, 1, 31)) is None
