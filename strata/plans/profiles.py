"""Column profiles of bronze tables, kept per load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.aggregates import profile_parts, united_profile
from strata.sources.bronze import LOAD_PERIOD, loads, scan_bronze, source_columns
from strata.sources.snapshots import Transaction


def bronze_profile(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Profile of all loads of a bronze table; only loads without one are read.

    Sketches of distinct values are stored per load, so a new load costs one pass over itself
    however many loads there are, and a load that is replaced is profiled again.
    """
    change, table = Transaction(spark, root), f"profiles/{name}"
    held, made = loads(change, name), change.parts(table)
    stale = [key for key, load in held.items() if made.get(key, {}).get("made_from") != load["path"]]
    gone = [key for key in made if key not in held]
    if not (stale or gone or table not in change.tables):
        return united_profile(change.read(table))
    bronze = scan_bronze(spark, root, name, stale, change)
    rows = profile_parts(bronze.select(*source_columns(bronze), LOAD_PERIOD), name, [LOAD_PERIOD])
    change.write(rows, table, LOAD_PERIOD, replace=[*stale, *gone])
    for key in change.written(table):
        change.note(table, key, made_from=held[key]["path"])
    return united_profile(change.commit().read(table))
