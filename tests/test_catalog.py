import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from strata import catalog
from tests.conftest import SF_DIR

CHECKED = [
    "bronze_produccion", "stg_produccion", "fct_produccion", "gas_by_basin", "oil_by_operator",
    "top_wells", "request_counters", "latency_histogram", "histogram_quantile_p95",
    "counter_increase", "dedup_alerts", "quality_marks", "decline_forecast", "read_csv_text",
    "replace_partition", "merge_upsert", "summarize_text", "incremental_ingest",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in (
        "region nation customer supplier part orders lineitem events documents labels conversations"
    ).split():
        con.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(catalog.oracles()) == set(catalog.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["periodo", "cuenca", "prod_gas"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    twin = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(twin.columns)
    columns = sorted(df.columns)
    got = sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
    want = sorted(twin.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall(), key=repr)
    assert got == want


BLOCKED = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {names}:
            raise ImportError(name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("names", [("strata.llm", "corpus_pipeline"), ("public_tokenizers",)])
def test_other_queries_stay_where_the_optional_part_cannot_be_imported(names):
    ran = subprocess.run(
        [sys.executable, "-c", BLOCKED.format(names=names)], capture_output=True, text=True,
        cwd=entry.__file__.rsplit("/", 1)[0],
    )
    assert ran.stdout.split() == [str(len(catalog.queries())), str(len(catalog.oracles()))], ran.stderr
