"""Sorts, limits and top-k (O1-O6). Null placement is always explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import OTHER_MEMBER, other_bucket
from strata.operators.joins import join_label
from strata.operators.windows import rank_total


def order_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def top_k_sum(df: DataFrame, key: str, measure: str, alias: str, k: int = 20) -> DataFrame:
    """The ``k`` members with the largest sum; null sums first, ties by member."""
    totals = df.groupBy(key).agg(F.sum(measure).alias(alias))
    return totals.orderBy(F.col(alias).desc_nulls_first(), F.col(key).asc_nulls_last()).limit(k)


def errors_first(marks: DataFrame) -> DataFrame:
    return marks.orderBy(F.when(F.col("status") == "ERROR", 0).otherwise(1), "check_name")


def top_n_others(
    detail: DataFrame,
    name: str,
    measure: str,
    label: str,
    n: int = 8,
    other: str = OTHER_MEMBER,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Add ``label``: the member itself if it is among the ``n`` largest, else ``other``.

    The ranking comes from ``totals`` (columns ``name`` and ``measure``) when given, so
    that a filter on ``detail`` does not change who is ranked. Rows without a member
    are dropped.
    """
    ranked_from = detail if totals is None else totals
    sums = (
        ranked_from.filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.sum(measure).alias("total"))
    )
    top = rank_total(sums, name, "total", n)
    labels = top.select(name, other_bucket(name, "rn", n, other).alias(label))
    return join_label(detail.filter(F.col(name).isNotNull()), labels, name, label, other)


def latest_first(df: DataFrame, column: str, k: int = 20, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(
        F.col(column).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties]
    ).limit(k)


def order_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Sort series by their label text, ``name="value"`` pairs joined by commas."""
    pairs = [
        F.concat(F.lit(f'{label}="'), F.col(label).cast("string"), F.lit('"'))
        for label in labels
    ]
    return df.orderBy(F.concat_ws(",", *pairs))
