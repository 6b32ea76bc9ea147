"""Queries over bronze, silver and gold, each with its SQL twin."""

from __future__ import annotations

from strata.catalog.result import plain
from strata.catalog.warehouse import gold_of, silver_of
from strata.plans import cards
from strata.sources.synthetic import pozos_raw, produccion_raw

START, END = "1996-01-01", "1998-12-01"


def _card(name, *period):
    def run(spark, sf_dir):
        return plain(getattr(cards, name)(gold_of(spark, sf_dir), *period))

    return run


QUERIES = {
    "bronze_produccion": lambda spark, d: plain(produccion_raw(spark, d)),
    "bronze_pozos": lambda spark, d: plain(pozos_raw(spark, d)),
    "stg_produccion": lambda spark, d: plain(silver_of(spark, d)[1]),
    "stg_pozos": lambda spark, d: plain(silver_of(spark, d)[0]),
    "dim_pozo": lambda spark, d: plain(gold_of(spark, d).dim_pozo),
    "dim_empresa": lambda spark, d: plain(gold_of(spark, d).dim_empresa),
    "dim_area": lambda spark, d: plain(gold_of(spark, d).dim_area),
    "dim_cuenca": lambda spark, d: plain(gold_of(spark, d).dim_cuenca),
    "dim_tipo_recurso": lambda spark, d: plain(gold_of(spark, d).dim_tipo_recurso),
    "dim_fecha": lambda spark, d: plain(gold_of(spark, d).dim_fecha),
    "fct_produccion": lambda spark, d: plain(gold_of(spark, d).fct_produccion),
    "gas_total": _card("gas_total"),
    "gas_total_in_period": _card("gas_total", START, END),
    "oil_total": _card("oil_total"),
    "oil_total_in_period": _card("oil_total", START, END),
    "active_wells": _card("active_wells"),
    "last_period": _card("last_period"),
    "gas_by_basin": _card("gas_by_basin"),
    "gas_by_basin_in_period": _card("gas_by_basin", START, END),
    "oil_by_operator": _card("oil_by_operator"),
    "oil_by_operator_in_period": _card("oil_by_operator", START, END),
    "total_by_resource": _card("total_by_resource"),
    "total_by_resource_in_period": _card("total_by_resource", START, END),
    "top_wells": _card("top_wells"),
    "top_wells_in_period": _card("top_wells", START, END),
    "monthly_totals": _card("monthly_totals"),
    "monthly_totals_in_period": _card("monthly_totals", START, END),
}
