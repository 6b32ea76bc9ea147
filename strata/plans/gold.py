"""Gold models: six dimensions and the production fact."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import (
    calendar_attrs,
    fallback_name,
    scd2_current,
    surrogate_key,
)
from strata.operators.aggregates import select_distinct, union_all, union_distinct
from strata.operators.filters import incremental_filter, member_filter
from strata.operators.joins import star_lookup
from strata.operators.windows import latest_per_key
from strata.session import staged

GOLD_SCHEMAS = {
    "dim_pozo": (
        "pozo_key string, id_pozo bigint, sigla string, formacion_productiva string, "
        "id_empresa string, area string, cuenca string, tipo_recurso string, "
        "valid_from timestamp, valid_to timestamp, is_current boolean"
    ),
    "dim_empresa": (
        "empresa_key string, id_empresa string, empresa string, valid_from timestamp, "
        "valid_to timestamp, is_current boolean"
    ),
    "dim_area": "area_key string, area string",
    "dim_cuenca": "cuenca_key string, cuenca string",
    "dim_tipo_recurso": "tipo_recurso_key string, tipo_recurso string",
    "dim_fecha": "fecha_key string, periodo date, anio int, mes int, trimestre int",
    "fct_produccion": (
        "produccion_key string, pozo_key string, empresa_key string, area_key string, "
        "cuenca_key string, tipo_recurso_key string, fecha_key string, id_pozo bigint, "
        "id_empresa string, periodo date, prod_gas decimal(20,6), prod_petroleo decimal(20,6), "
        "prod_agua decimal(20,6), dias_produccion int, _loaded_at timestamp"
    ),
}
MEMBER_KINDS = ("area", "cuenca", "tipo_recurso")
MEMBERS_SCHEMA = "periodo date, kind string, member string, name string, _loaded_at timestamp"
MEMBER_COLUMNS = ("periodo", "kind", "member", "name", "_loaded_at")
FACT_KEYS = ("id_pozo", "periodo")
FACT_COLUMNS = (
    "produccion_key", "pozo_key", "empresa_key", "area_key", "cuenca_key",
    "tipo_recurso_key", "fecha_key", "id_pozo", "id_empresa", "periodo",
    "prod_gas", "prod_petroleo", "prod_agua", "dias_produccion", "_loaded_at",
)


@dataclass(frozen=True)
class Gold:
    """The tables of the star schema."""

    dim_pozo: DataFrame
    dim_empresa: DataFrame
    dim_area: DataFrame
    dim_cuenca: DataFrame
    dim_tipo_recurso: DataFrame
    dim_fecha: DataFrame
    fct_produccion: DataFrame


def dim_pozo(pozos: DataFrame, unique: bool = False) -> DataFrame:
    """Wells; ``unique`` skips the search for the newest row where a test proved it."""
    latest = pozos if unique else latest_per_key(
        pozos, ["id_pozo"], "_loaded_at", ["sigla", "formacion_productiva"]
    )
    return scd2_current(latest).select(
        surrogate_key("id_pozo").alias("pozo_key"),
        "id_pozo", "sigla", "formacion_productiva", "id_empresa", "area", "cuenca",
        "tipo_recurso", "valid_from", "valid_to", "is_current",
    )


def dim_empresa(pozos: DataFrame, produccion: DataFrame) -> DataFrame:
    """Companies under the name of their newest row; ties go to the smaller name.

    Rows are first reduced to the newest load of every name a company has used, a hash
    aggregate that also runs before the shuffle; what is left to rank is small.
    """
    sources = [
        df.select("id_empresa", fallback_name("empresa", "id_empresa").alias("empresa"), "_loaded_at")
        for df in (pozos, produccion)
    ]
    names = (
        member_filter(union_all(*sources), "id_empresa")
        .groupBy("id_empresa", "empresa")
        .agg(F.max("_loaded_at").alias("_loaded_at"))
    )
    latest = latest_per_key(names, ["id_empresa"], "_loaded_at", ["empresa"])
    return scd2_current(latest).select(
        surrogate_key("id_empresa").alias("empresa_key"),
        "id_empresa", "empresa", "valid_from", "valid_to", "is_current",
    )


def member_dimension(pozos: DataFrame, produccion: DataFrame, column: str) -> DataFrame:
    """Area, basin or resource type: the members either silver table uses."""
    members = member_filter(union_distinct(pozos, produccion, column), column)
    return members.select(surrogate_key(column).alias(f"{column}_key"), column)


def dim_fecha(produccion: DataFrame) -> DataFrame:
    months = member_filter(select_distinct(produccion, ["periodo"]), "periodo")
    return months.select(
        surrogate_key("periodo").alias("fecha_key"), "periodo", *calendar_attrs("periodo")
    )


def fct_produccion(
    produccion: DataFrame,
    dims: Gold,
    target: DataFrame | None = None,
    reprocess: str | date | None = None,
) -> DataFrame:
    """Fact rows by joins with all six dimensions, whatever members those hold."""
    rows = incremental_filter(produccion, target, reprocess=reprocess)
    joined = star_lookup(
        rows,
        {
            "id_pozo": (dims.dim_pozo, "pozo_key"),
            "id_empresa": (dims.dim_empresa, "empresa_key"),
            "area": (dims.dim_area, "area_key"),
            "cuenca": (dims.dim_cuenca, "cuenca_key"),
            "tipo_recurso": (dims.dim_tipo_recurso, "tipo_recurso_key"),
            "periodo": (dims.dim_fecha, "fecha_key"),
        },
    )
    return joined.withColumn("produccion_key", surrogate_key(*FACT_KEYS)).select(*FACT_COLUMNS)


def fct_produccion_conformed(
    produccion: DataFrame,
    pozos: DataFrame,
    target: DataFrame | int | None = None,
    reprocess: str | date | None = None,
    unknown: DataFrame | None = None,
) -> DataFrame:
    """The same rows where the dimensions were just rebuilt from this silver data.

    Such dimensions hold every non-null member, and a surrogate key is a function of
    its natural key, so five joins reduce to null tests. Only the well list can drop
    rows: one semi-join on ``id_pozo`` instead of six joins. With the ``unknown_wells`` of
    ``produccion`` it is an anti-join with those, which are few as a rule, so that no report moves.
    """
    rows = incremental_filter(produccion, target, reprocess=reprocess)
    for column in ("id_empresa", "area", "cuenca", "tipo_recurso", "periodo"):
        rows = rows.filter(F.col(column).isNotNull())
    if unknown is None:
        known = rows.join(pozos.select("id_pozo"), "id_pozo", "left_semi")
    else:
        known = rows.filter(F.col("id_pozo").isNotNull()).join(unknown, "id_pozo", "left_anti")
    return known.withColumns(
        {f"{kind}_key": surrogate_key(kind) for kind in MEMBER_KINDS} | fact_surrogates()
    ).select(*FACT_COLUMNS)


def fact_surrogates() -> dict[str, Column]:
    """The surrogate keys of a fact that are functions of its other columns."""
    return {
        "produccion_key": surrogate_key(*FACT_KEYS), "pozo_key": surrogate_key("id_pozo"),
        "empresa_key": surrogate_key("id_empresa"), "fecha_key": surrogate_key("periodo"),
    }


def unknown_wells(produccion: DataFrame, pozos: DataFrame) -> DataFrame:
    """Wells that report and are not in the well list, staged, so that their number is known."""
    wells = select_distinct(produccion, ["id_pozo"]).join(pozos.select("id_pozo"), "id_pozo", "left_anti")
    return staged(produccion.sparkSession, wells, "unknown-wells")


def month_members(produccion: DataFrame) -> DataFrame:
    """What the dimensions need of each month: its members, and each name's newest load.

    A few rows per month, whatever the number of reports; a month whose reports change gets
    its members anew, so one that is used no more is gone as in a full rebuild.
    """
    no_name, no_time = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    # A pass for each kind over its own column; such rows are narrow and counted as they are read.
    members = [
        produccion.select("periodo", F.col(kind).alias("member")).distinct().select(
            "periodo", F.lit(kind).alias("kind"), "member", no_name.alias("name"),
            no_time.alias("_loaded_at"),
        )
        for kind in MEMBER_KINDS
    ]
    companies = produccion.groupBy("periodo", "id_empresa", "empresa").agg(
        F.max("_loaded_at").alias("_loaded_at")
    )
    return union_all(*members, companies.select(
        "periodo", F.lit("empresa").alias("kind"), F.col("id_empresa").alias("member"),
        F.col("empresa").alias("name"), "_loaded_at",
    ))


def dimensions(pozos: DataFrame, members: DataFrame) -> dict[str, DataFrame]:
    """The six dimensions by table name, from the wells and the members of all months.

    The well list must hold each well once.
    """
    companies = members.filter("kind = 'empresa'").select(
        F.col("member").alias("id_empresa"), F.col("name").alias("empresa"), "_loaded_at"
    )
    found = {"dim_pozo": dim_pozo(pozos, unique=True), "dim_empresa": dim_empresa(pozos, companies)}
    for kind in MEMBER_KINDS:
        of_kind = members.filter(F.col("kind") == kind).select(F.col("member").alias(kind))
        found[f"dim_{kind}"] = member_dimension(pozos, of_kind, kind)
    return found | {"dim_fecha": dim_fecha(members)}


def build_gold(pozos: DataFrame, produccion: DataFrame) -> Gold:
    """Full rebuild of the star schema from silver, as lazy plans."""
    return Gold(
        dim_pozo=dim_pozo(pozos, unique=True),
        dim_empresa=dim_empresa(pozos, produccion),
        **{f"dim_{kind}": member_dimension(pozos, produccion, kind) for kind in MEMBER_KINDS},
        dim_fecha=dim_fecha(produccion),
        fct_produccion=fct_produccion_conformed(produccion, pozos),
    )
