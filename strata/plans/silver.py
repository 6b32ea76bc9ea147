"""Silver models: typed, normalised, one row per key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import (
    blank_to_null,
    first_existing,
    month_start,
    normalize_key,
    typed_cast,
    unknown_member,
)
from strata.operators.filters import incremental_filter, non_negative, required_keys
from strata.operators.windows import SHARE, deal, latest_per_key

VOLUMES = ("prod_gas", "prod_petroleo", "prod_agua")
VOLUME_TYPE = "decimal(20,6)"

# Names the sources have used for the same attribute, best first.
COMPANY_COLUMNS = ("empresa", "operador")
AREA_COLUMNS = ("areayacimiento", "areapermisoconcesion", "area")
BASIN_COLUMNS = ("cuenca",)
PRODUCTION_RESOURCE_COLUMNS = (
    "tipo_de_recurso", "sub_tipo_recurso", "tipo_recurso", "tiporecurso", "recurso",
)
WELL_RESOURCE_COLUMNS = (
    "tipo_de_recurso", "tipo_reservorio", "sub_tipo_recurso", "subtipo_reservorio",
    "tipo_recurso", "tiporecurso", "recurso",
)
DAYS_COLUMNS = ("dias_produccion", "diasprod", "diasefectivos")

STG_PRODUCCION_SCHEMA = (
    "id_pozo bigint, id_empresa string, empresa string, area string, cuenca string, "
    "tipo_recurso string, periodo date, prod_gas decimal(20,6), prod_petroleo decimal(20,6), "
    "prod_agua decimal(20,6), dias_produccion int, _loaded_at timestamp"
)
STG_POZOS_SCHEMA = (
    "id_pozo bigint, sigla string, formacion_productiva string, id_empresa string, "
    "empresa string, area string, cuenca string, tipo_recurso string, _loaded_at timestamp"
)
PRODUCTION_KEYS = ("id_pozo", "periodo")
PRODUCTION_COLUMNS = (
    "id_pozo", "id_empresa", "empresa", "area", "cuenca", "tipo_recurso", "periodo",
    "prod_gas", "prod_petroleo", "prod_agua", "dias_produccion", "_loaded_at",
)
WELL_COLUMNS = (
    "id_pozo", "sigla", "formacion_productiva", "id_empresa", "empresa", "area",
    "cuenca", "tipo_recurso", "_loaded_at",
)


def stg_produccion(
    bronze: DataFrame,
    target: DataFrame | int | None = None,
    reprocess: str | date | None = None,
    months: int | None = None,
    tasks: int = 1,
) -> DataFrame:
    """Monthly production, the newest row per well and month.

    With the number of ``months`` expected, rows are dealt by month and a share of its wells
    (see ``deal``), so the result can be written by month as it lies.

    Without ``target`` this is the full table, with it (or the time of its newest row) the
    batch to merge. A newest
    row with a negative volume is dropped after it has won, so it hides older rows of
    its key within the batch.
    """
    typed = report_versions(bronze, target, reprocess)
    if months:
        newest = newest_dealt(typed, months, tasks)
    else:
        newest = latest_per_key(typed, PRODUCTION_KEYS, "_loaded_at", ["_row_hash"])
    return non_negative(newest, VOLUMES).select(*PRODUCTION_COLUMNS)


def report_versions(
    bronze: DataFrame,
    target: DataFrame | int | None = None,
    reprocess: str | date | None = None,
) -> DataFrame:
    """Typed reports, all versions of a well and month; for ``target`` see ``stg_produccion``."""
    rows = required_keys(bronze, ["idpozo", "anio", "mes"])
    rows = incremental_filter(
        rows, target, period_col=month_start("anio", "mes"), reprocess=reprocess
    )
    return type_production(rows)


def newest_dealt(typed: DataFrame, months: int, tasks: int) -> DataFrame:
    """The newest row per well and month, dealt by month; see ``deal``."""
    dealt = deal(short_hashes(typed), "periodo", ["id_pozo"], months, tasks)
    keys = ["periodo", SHARE, "id_pozo"]
    return latest_per_key(dealt, keys, "_loaded_at", ["_row_hash"]).drop(SHARE, "_row_hash")


def short_hashes(typed: DataFrame) -> DataFrame:
    """Rows with their hash as bytes: half as many, in the same order as lower-case hex text."""
    digest = F.when(F.length("_row_hash") == 64, F.unhex("_row_hash"))
    return typed.withColumn("_row_hash", F.coalesce(digest, F.encode("_row_hash", "UTF-8")))


def type_production(rows: DataFrame) -> DataFrame:
    null_text = F.lit(None).cast("string")
    return rows.select(
        typed_cast("idpozo", "bigint").alias("id_pozo"),
        normalize_key("idempresa").alias("id_empresa"),
        blank_to_null(first_existing(rows, COMPANY_COLUMNS, F.col("idempresa"))).alias("empresa"),
        _member(rows, AREA_COLUMNS).alias("area"),
        _member(rows, BASIN_COLUMNS).alias("cuenca"),
        _member(rows, PRODUCTION_RESOURCE_COLUMNS).alias("tipo_recurso"),
        month_start("anio", "mes").alias("periodo"),
        typed_cast("prod_gas", VOLUME_TYPE).alias("prod_gas"),
        typed_cast("prod_pet", VOLUME_TYPE).alias("prod_petroleo"),
        typed_cast("prod_agua", VOLUME_TYPE).alias("prod_agua"),
        typed_cast(first_existing(rows, DAYS_COLUMNS, null_text), "int", 0).alias(
            "dias_produccion"
        ),
        "_loaded_at",
        "_row_hash",
    )


def newer_pozos(held: DataFrame, bronze: DataFrame) -> DataFrame:
    """The well list after loads that are all newer than every row of it.

    Equals a full rebuild while the loads that the list was made from are unchanged.
    """
    both = held.withColumn("_held", F.lit(1)).unionByName(stg_pozos(bronze).withColumn("_held", F.lit(0)))
    return latest_per_key(both, ["id_pozo"], "_loaded_at", ["_held"]).select(*WELL_COLUMNS)


def stg_pozos(bronze: DataFrame) -> DataFrame:
    """Well list, the newest row per well, rebuilt in full."""
    rows = required_keys(bronze, ["idpozo"])
    typed = rows.select(
        typed_cast("idpozo", "bigint").alias("id_pozo"),
        blank_to_null("sigla").alias("sigla"),
        unknown_member(blank_to_null("formprod")).alias("formacion_productiva"),
        normalize_key("idempresa").alias("id_empresa"),
        blank_to_null(first_existing(rows, COMPANY_COLUMNS, F.col("idempresa"))).alias("empresa"),
        _member(rows, AREA_COLUMNS).alias("area"),
        _member(rows, BASIN_COLUMNS).alias("cuenca"),
        _member(rows, WELL_RESOURCE_COLUMNS).alias("tipo_recurso"),
        "_loaded_at",
        "_row_hash",
    )
    return latest_per_key(typed, ["id_pozo"], "_loaded_at", ["_row_hash"]).select(*WELL_COLUMNS)


def _member(rows: DataFrame, names: tuple[str, ...]):
    column = first_existing(rows, names, F.lit(None).cast("string"))
    return unknown_member(blank_to_null(column))
