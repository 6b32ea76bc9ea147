"""Joins between facts and dimensions.

No dimension is hinted as broadcast: Spark broadcasts a side whose measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges it otherwise, with AQE
splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import OTHER_MEMBER


def star_lookup(facts: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Add surrogate keys by inner joins on natural keys.

    ``dims`` maps the natural key column to the dimension and its surrogate key
    column. Rows without a member in every dimension are dropped.
    """
    for natural_key, (dim, key) in dims.items():
        facts = join_current(facts, dim, natural_key, [key])
    return facts


def join_current(
    facts: DataFrame, dim: DataFrame, on: str, columns: Sequence[str]
) -> DataFrame:
    """Equi-join with the current rows of a dimension, taking only ``columns`` of it."""
    if "is_current" in dim.columns:
        dim = dim.filter("is_current")
    return facts.join(dim.select(on, *columns), on, "inner")


def fk_orphans(fact: DataFrame, dim: DataFrame, key: str, alias: str = "failed_rows") -> DataFrame:
    """Number of fact rows whose key, null included, has no dimension row.

    Rows are counted per key before the join, so a frequent key costs one row.
    """
    return orphan_counts(fact, {key: (dim, key)}).withColumnRenamed(key, alias)


def orphan_counts(
    fact: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], null_fails: bool = True
) -> DataFrame:
    """``fk_orphans`` for several keys in one pass: one row, a column per key.

    ``parents`` maps a key column to the table and column it refers to. The keys of a
    row become (key name, value) pairs, which are counted before the shuffle; one
    anti-join with the members of all parents leaves the orphans.
    """
    pairs = ", ".join(f"'{key}', string(`{key}`)" for key in parents)
    counted = (
        fact.selectExpr(f"stack({len(parents)}, {pairs}) as (fk, value)")
        .groupBy("fk", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if not null_fails:
        counted = counted.filter(F.col("value").isNotNull())
    members = reduce(
        DataFrame.union,
        [
            parent.selectExpr(f"'{key}' as fk", f"string(`{column}`) as value")
            for key, (parent, column) in parents.items()
        ],
    )
    orphans = counted.join(members, ["fk", "value"], "left_anti")
    return orphans.agg(
        *[F.expr(f"coalesce(sum(n) filter (where fk = '{key}'), 0L) as `{key}`") for key in parents]
    )


def fact_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return fact.join(dim, key, "inner")


def join_label(
    fact: DataFrame, labels: DataFrame, on: str, label: str, default: str = OTHER_MEMBER
) -> DataFrame:
    """Attach the label of a member; members that have none get ``default``.

    ``labels`` is a top-n list, a handful of rows, hence the broadcast.
    """
    joined = fact.join(F.broadcast(labels.select(on, label)), on, "left")
    return joined.withColumn(label, F.coalesce(label, F.lit(default)))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key does not occur in the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def reject_unknown(
    requests: DataFrame,
    known: DataFrame,
    on: str = "id_well",
    invalid: Column | None = None,
    unknown_reason: str = "unknown well",
    invalid_reason: str = "date_end before date_start",
) -> tuple[DataFrame, DataFrame]:
    """Split requests into accepted rows and rejects with a ``reason``.

    An unknown key is reported before an invalid range.
    """
    if invalid is None:
        invalid = F.col("date_end") < F.col("date_start")
    keys = known.select(on).distinct()
    unknown = requests.join(keys, on, "left_anti").withColumn("reason", F.lit(unknown_reason))
    found = requests.join(keys, on, "left_semi")
    bad = found.filter(invalid).withColumn("reason", F.lit(invalid_reason))
    return found.filter(~invalid), unknown.unionByName(bad)
