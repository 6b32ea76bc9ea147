"""Shuffles whose tasks and bytes do not outgrow the input."""

from __future__ import annotations

from datetime import datetime

from strata.operators.windows import SHARE, deal, latest_per_key
from strata.plans.gold import fct_produccion_conformed, unknown_wells
from strata.plans.silver import stg_produccion
from strata.session import SHUFFLE_KEY, SPLIT_KEY, sized
from strata.sources.snapshots import Transaction
from tests.conftest import bronze, load_fixture


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def test_sized_raises_partitions_and_restores_what_was_set(spark):
    before = spark.conf.get(SHUFFLE_KEY), spark.conf.get(SPLIT_KEY)
    with sized(spark, 7):
        assert spark.conf.get(SHUFFLE_KEY) == "7"
        assert int(spark.conf.get(SPLIT_KEY)) <= 16 << 20
    assert (spark.conf.get(SHUFFLE_KEY), spark.conf.get(SPLIT_KEY)) == before


def test_dealt_reports_are_shuffled_once(spark, root):
    load_fixture(spark, root)
    dealt = stg_produccion(bronze(spark, root), months=2, tasks=3)
    assert _plan(dealt).count("Exchange") == 1
    plain = stg_produccion(bronze(spark, root))
    assert sorted(dealt.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_dealt_rows_of_a_key_meet_whatever_number_of_partitions_is_expected(spark):
    rows = [(k % 50 or None, m, v) for k in range(100) for m in (1, 2, None) for v in range(3)]
    df = spark.createDataFrame(rows, "id bigint, month int, v int")
    want = sorted(latest_per_key(df, ["month", "id"], "v").collect(), key=repr)
    for partitions in (1, 3, 40):
        dealt = deal(df, "month", ["id"], partitions, 8)
        got = latest_per_key(dealt, ["month", SHARE, "id"], "v").drop(SHARE)
        assert sorted(got.collect(), key=repr) == want


def test_a_dealt_table_is_written_without_another_shuffle(spark, root):
    load_fixture(spark, root)
    change = Transaction(spark, root)
    rows = stg_produccion(bronze(spark, root), months=2, tasks=4)
    written = change.write(rows, "silver/t", "periodo", in_place=True)
    assert sorted(written.collect(), key=repr) == sorted(
        rows.select(*written.columns).collect(), key=repr
    )


def test_facts_without_unknown_wells_equal_the_semi_join(spark):
    schema = (
        "id_pozo bigint, id_empresa string, area string, cuenca string, tipo_recurso string, "
        "periodo date, prod_gas decimal(20,6), prod_petroleo decimal(20,6), "
        "prod_agua decimal(20,6), dias_produccion int, _loaded_at timestamp"
    )
    at = datetime(2024, 1, 1)
    reports = spark.createDataFrame(
        [(n, "c", "a", "b", "r", at.date(), None, None, None, 1, at) for n in (1, 2, 2, 3, None)], schema
    )
    wells = spark.createDataFrame([(1,), (2,), (None,)], "id_pozo bigint")
    want = fct_produccion_conformed(reports, wells)
    got = fct_produccion_conformed(reports, wells, unknown=unknown_wells(reports, wells))
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.count() == 3
