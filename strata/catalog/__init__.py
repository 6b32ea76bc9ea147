"""All queries by name, with the SQL that checks them."""

from __future__ import annotations

from strata.catalog import (
    medallion,
    medallion_sql,
    observability,
    observability_sql,
    operations,
    operations_sql,
)
from strata.session import prepare


def queries() -> dict:
    found = {**medallion.QUERIES, **observability.QUERIES, **operations.QUERIES}
    return {name: _prepared(run) for name, run in found.items()}


def _prepared(run):
    def call(spark, sf_dir):
        prepare(spark)
        return run(spark, sf_dir)

    return call


def oracles() -> dict[str, str]:
    return {**medallion_sql.ORACLES, **observability_sql.ORACLES, **operations_sql.ORACLES}
