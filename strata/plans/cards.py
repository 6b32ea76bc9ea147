"""Reporting queries over gold (C1-C9); C10 is in ``strata.plans.marks``.

Sums are taken per surrogate key before a dimension is joined, so the join and the
shuffle see one row per key and month instead of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregates import count_distinct, max_value, sum_by, sum_total
from strata.operators.filters import active_rows, latest_period, period_filter
from strata.operators.joins import fact_dim
from strata.operators.ordering import order_keys, top_k_sum, top_n_others
from strata.plans.gold import Gold


def gas_total(gold: Gold, start=None, end=None) -> DataFrame:
    return sum_total(period_filter(gold.fct_produccion, start, end), "prod_gas", "gas_acumulado")


def oil_total(gold: Gold, start=None, end=None) -> DataFrame:
    return sum_total(
        period_filter(gold.fct_produccion, start, end), "prod_petroleo", "petroleo_acumulado"
    )


def active_wells(gold: Gold) -> DataFrame:
    """Wells that produced gas or oil in the latest month."""
    rows = active_rows(latest_period(gold.fct_produccion), ["prod_gas", "prod_petroleo"])
    return count_distinct(rows, "id_pozo", "pozos_activos")


def last_period(gold: Gold) -> DataFrame:
    return max_value(gold.fct_produccion, "periodo", "ultimo_periodo")


def gas_by_basin(gold: Gold, start=None, end=None) -> DataFrame:
    rows = period_filter(gold.fct_produccion, start, end)
    sums = sum_by(rows, ["periodo", "cuenca_key"], {"prod_gas": "prod_gas"})
    named = fact_dim(sums, gold.dim_cuenca, "cuenca_key")
    return order_keys(
        sum_by(named, ["periodo", "cuenca"], {"prod_gas": "prod_gas"}), "periodo", "cuenca"
    )


def oil_by_operator(gold: Gold, start=None, end=None) -> DataFrame:
    """Oil of the eight largest companies by name, the rest as one series.

    The companies are ranked over all months; only the series follow the filter.
    """
    def by_name(rows: DataFrame) -> DataFrame:
        sums = sum_by(rows, ["periodo", "empresa_key"], {"prod_petroleo": "prod_petroleo"})
        names = gold.dim_empresa.select("empresa_key", "empresa")
        return fact_dim(sums, names, "empresa_key")

    labelled = top_n_others(
        by_name(period_filter(gold.fct_produccion, start, end)),
        "empresa", "prod_petroleo", "operadora",
        totals=by_name(gold.fct_produccion),
    )
    return order_keys(
        sum_by(labelled, ["periodo", "operadora"], {"prod_petroleo": "prod_petroleo"}),
        "periodo", "operadora",
    )


def total_by_resource(gold: Gold, start=None, end=None) -> DataFrame:
    rows = period_filter(gold.fct_produccion, start, end)
    sums = sum_by(
        rows,
        ["periodo", "tipo_recurso_key"],
        {"produccion_total": F.col("prod_gas") + F.col("prod_petroleo")},
    )
    named = fact_dim(sums, gold.dim_tipo_recurso, "tipo_recurso_key")
    return order_keys(
        sum_by(named, ["periodo", "tipo_recurso"], {"produccion_total": "produccion_total"}),
        "periodo", "tipo_recurso",
    )


def top_wells(gold: Gold, start=None, end=None, k: int = 20) -> DataFrame:
    """The wells, by name, with the largest gas plus oil."""
    rows = period_filter(gold.fct_produccion, start, end)
    sums = sum_by(
        rows, ["pozo_key"], {"total": F.col("prod_gas") + F.col("prod_petroleo")}
    )
    names = gold.dim_pozo.select("pozo_key", F.col("sigla").alias("pozo"))
    return top_k_sum(fact_dim(sums, names, "pozo_key"), "pozo", "total", "produccion_total", k)


def monthly_totals(gold: Gold, start=None, end=None) -> DataFrame:
    rows = period_filter(gold.fct_produccion, start, end)
    volumes = ("prod_gas", "prod_petroleo", "prod_agua")
    return order_keys(sum_by(rows, ["periodo"], {v: v for v in volumes}), "periodo")
