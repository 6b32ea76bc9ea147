from __future__ import annotations

import tempfile
from datetime import datetime

import pytest

from strata.session import local_session
from strata.sources.bronze import bronze_path, replace_partition, scan_bronze, with_load_metadata
from strata.streaming.alerts import STATE_STORE, STATE_STORE_KEY

SF_DIR = "/root/testdata/sf0.001"

# Fixed test data: columns and rows of the described seed.
PRODUCTION_COLUMNS = (
    "idempresa", "empresa", "area", "cuenca", "tipo_recurso", "anio", "mes", "idpozo",
    "prod_pet", "prod_gas", "prod_agua", "dias_produccion", "fecha_data",
)
PRODUCTION_ROWS = [
    ("YPF", "YPF S.A.", "Loma Campana", "Neuquina", "SHALE", "2024", "1", "135204", "120.500",
     "59.940", "10.000", "31", "2024-01-31"),
    ("YPF", "YPF S.A.", "Loma Campana", "Neuquina", "SHALE", "2024", "2", "135204", "118.000",
     "58.100", "9.500", "29", "2024-02-29"),
    ("PAMPA", "Pampa Energia", "El Mangrullo", "Neuquina", "TIGHT", "2024", "1", "200001",
     "80.000", "40.000", "5.000", "31", "2024-01-31"),
    ("CAPSA", "CAPSA Petroleum", "Cañadon Seco", "Golfo San Jorge", "CONVENCIONAL", "2024", "1",
     "300001", "55.000", "12.000", "8.000", "31", "2024-01-31"),
]
WELL_COLUMNS = (
    "idpozo", "sigla", "formprod", "idempresa", "empresa", "area", "cuenca", "tipo_recurso",
    "fecha_data",
)
WELL_ROWS = [
    ("135204", "APA.Nq.ACO-13(d)", "FIMP", "YPF", "YPF S.A.", "Loma Campana", "Neuquina", "SHALE",
     "2024-01-31"),
    ("200001", "PAM.Nq.X-1", "VMUT", "PAMPA", "Pampa Energia", "El Mangrullo", "Neuquina", "TIGHT",
     "2024-01-31"),
    ("300001", "CAP.GSJ.CS-1", "CONV", "CAPSA", "CAPSA Petroleum", "Cañadon Seco",
     "Golfo San Jorge", "CONVENCIONAL", "2024-01-31"),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "strata-tests", "8",
        {
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "2",
            # Compiling plans takes longer than running them on a handful of rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            STATE_STORE_KEY: STATE_STORE,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="strata-test-")


def text_frame(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def production(spark, *changes: dict, base: int = 0):
    """Fixture rows with some cells replaced, one row per dict."""
    rows = []
    for change in changes:
        cells = dict(zip(PRODUCTION_COLUMNS, PRODUCTION_ROWS[base]), **change)
        rows.append(tuple(cells[c] for c in PRODUCTION_COLUMNS))
    return text_frame(spark, PRODUCTION_COLUMNS, rows)


def load(df, root, name, period, at):
    loaded = with_load_metadata(df, period, "file:test", "test", at)
    return replace_partition(loaded, bronze_path(root, name), period)


def load_fixture(spark, root, period="2024-01", at=datetime(2024, 3, 1), rows=None, wells=None):
    load(text_frame(spark, PRODUCTION_COLUMNS, rows or PRODUCTION_ROWS), root, "produccion_raw",
         period, at)
    load(text_frame(spark, WELL_COLUMNS, wells or WELL_ROWS), root, "pozos_raw", period, at)


def bronze(spark, root, name="produccion_raw"):
    return scan_bronze(spark, root, name)
