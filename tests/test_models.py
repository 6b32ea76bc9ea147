from datetime import date, datetime

import pytest

from strata.plans import cards
from strata.plans.gold import Gold, build_gold, fct_produccion
from strata.plans.quality import quality_marks
from strata.plans.silver import stg_pozos, stg_produccion
from strata.operators.windows import latest_per_key
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tests.conftest import bronze, load, load_fixture, production


@pytest.fixture(scope="module")
def fixture_gold(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="strata-test-")
    load_fixture(spark, root)
    pozos = stg_pozos(bronze(spark, root, "pozos_raw"))
    return build_gold(pozos, stg_produccion(bronze(spark, root)))


def rows(df):
    return [tuple(float(v) if hasattr(v, "quantize") else v for v in row) for row in df.collect()]


JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def test_row_counts_and_marks(fixture_gold):
    counts = {name: getattr(fixture_gold, name).count() for name in Gold.__annotations__}
    assert counts == {
        "dim_pozo": 3, "dim_empresa": 3, "dim_area": 3, "dim_cuenca": 2, "dim_tipo_recurso": 3,
        "dim_fecha": 2, "fct_produccion": 4,
    }
    marks = quality_marks(fixture_gold).collect()
    assert len(marks) == 8
    assert {(m.status, m.failed_rows) for m in marks} == {("PASS", 0)}


@pytest.mark.parametrize(
    "card, expected",
    [
        ("gas_total", [(170.04,)]),
        ("oil_total", [(373.5,)]),
        ("active_wells", [(1,)]),
        ("last_period", [(FEB,)]),
        ("gas_by_basin", [(JAN, "Golfo San Jorge", 12.0), (JAN, "Neuquina", 99.94), (FEB, "Neuquina", 58.1)]),
        (
            "oil_by_operator",
            [(JAN, "CAPSA Petroleum", 55.0), (JAN, "Pampa Energia", 80.0), (JAN, "YPF S.A.", 120.5),
             (FEB, "YPF S.A.", 118.0)],
        ),
        (
            "total_by_resource",
            [(JAN, "CONVENCIONAL", 67.0), (JAN, "SHALE", 180.44), (JAN, "TIGHT", 120.0),
             (FEB, "SHALE", 176.1)],
        ),
        ("top_wells", [("APA.Nq.ACO-13(d)", 356.54), ("PAM.Nq.X-1", 120.0), ("CAP.GSJ.CS-1", 67.0)]),
        ("monthly_totals", [(JAN, 111.94, 255.5, 23.0), (FEB, 58.1, 118.0, 9.5)]),
    ],
)
def test_cards(fixture_gold, card, expected):
    assert rows(getattr(cards, card)(fixture_gold)) == expected


def test_period_filter_is_inclusive_and_ranking_ignores_it(fixture_gold):
    assert rows(cards.gas_total(fixture_gold, "2024-02-01", "2024-02-01")) == [(58.1,)]
    assert rows(cards.gas_total(fixture_gold, "2025-01-01")) == [(None,)]
    assert rows(cards.oil_by_operator(fixture_gold, end="2024-01-31"))[0] == (JAN, "CAPSA Petroleum", 55.0)


def test_fact_by_joins_equals_fact_by_derived_keys(spark, root):
    load_fixture(spark, root)
    pozos = stg_pozos(bronze(spark, root, "pozos_raw"))
    load(
        production(spark, {"idpozo": "999"}, {"idempresa": " ", "mes": "3"}),
        root, "produccion_raw", "2024-02", datetime(2024, 3, 5),
    )
    produccion = stg_produccion(bronze(spark, root))
    gold = build_gold(pozos, produccion)
    by_join = fct_produccion(produccion, gold)
    assert by_join.exceptAll(gold.fct_produccion).count() == 0
    assert gold.fct_produccion.exceptAll(by_join).count() == 0
    assert by_join.count() == 5
    assert by_join.filter("id_empresa = ''").count() == 1


def test_blank_keys_are_dropped_and_garbage_stops_the_run(spark, root):
    at = datetime(2024, 3, 1)
    load(production(spark, {"idpozo": " "}, {"mes": ""}, {"anio": " "}, {}), root, "produccion_raw", "a", at)
    assert stg_produccion(bronze(spark, root)).count() == 1
    load(production(spark, {"prod_gas": "x"}), root, "produccion_raw", "b", at)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stg_produccion(bronze(spark, root)).collect()


def test_a_new_area_column_replaces_the_flat_one_for_all_rows(spark, root):
    at = datetime(2024, 3, 1)
    load(production(spark, {}), root, "produccion_raw", "2024-01", at)
    assert stg_produccion(bronze(spark, root)).first().area == "Loma Campana"
    wider = production(spark, {"idpozo": "7"}).selectExpr("*", "'Real' as areayacimiento")
    load(wider, root, "produccion_raw", "2024-02", at)
    found = {r.id_pozo: r.area for r in stg_produccion(bronze(spark, root)).collect()}
    assert found == {135204: "SIN DATO", 7: "Real"}


def test_a_negative_newest_row_hides_the_older_one(spark, root):
    load(production(spark, {"prod_gas": "10"}), root, "produccion_raw", "a", datetime(2024, 1, 1))
    load(production(spark, {"prod_gas": "-1"}), root, "produccion_raw", "b", datetime(2024, 2, 1))
    assert stg_produccion(bronze(spark, root)).count() == 0


def test_null_measures_are_not_active_and_pass_the_range(spark, root):
    load_fixture(spark, root)
    load(production(spark, {"prod_gas": "", "mes": "3"}), root, "produccion_raw", "2024-03", datetime(2024, 4, 1))
    gold = build_gold(stg_pozos(bronze(spark, root, "pozos_raw")), stg_produccion(bronze(spark, root)))
    assert rows(cards.active_wells(gold)) == [(0,)]
    assert {m.status for m in quality_marks(gold).collect()} == {"PASS"}


def test_nine_operators_make_an_others_series(spark, root):
    changes = [
        {"idempresa": f"E{i}", "empresa": f"Empresa {i}", "idpozo": str(i), "prod_pet": str(100 - i)}
        for i in range(11)
    ]
    wells = [
        (str(i), f"W{i}", "F", f"E{i}", f"Empresa {i}", "a", "c", "t", "") for i in range(11)
    ]
    load_fixture(spark, root, wells=wells)
    load(production(spark, *changes), root, "produccion_raw", "2024-01", datetime(2024, 3, 1))
    gold = build_gold(stg_pozos(bronze(spark, root, "pozos_raw")), stg_produccion(bronze(spark, root)))
    series = rows(cards.oil_by_operator(gold))
    assert [s[1] for s in series] == [f"Empresa {i}" for i in range(8)] + ["Otras"]
    assert series[-1][2] == 92.0 + 91.0 + 90.0


def test_newest_row_by_aggregate_equals_row_number(spark):
    df = spark.range(3000).selectExpr(
        "id % 37 as k", "timestamp_seconds(id * 7919 % 11) as at", "string(id * 31 % 1000) as tie", "id"
    ).withColumn("tie", F.concat("tie", F.col("id").cast("string")))
    order = W.partitionBy("k").orderBy(F.col("at").desc_nulls_first(), "tie")
    expected = df.withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")
    got = latest_per_key(df, ["k"], "at", ["tie"])
    assert got.exceptAll(expected).count() == 0 and got.count() == 37
