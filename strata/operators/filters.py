"""Row filters (F1-F8)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import blank_to_null


# Stands for the newest row of a target that has none.
NO_ROWS = -(1 << 63)


def required_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose text keys are all non-blank."""
    for name in columns:
        df = df.filter(blank_to_null(name).isNotNull())
    return df


def is_non_negative(columns: Sequence[str]) -> Column:
    """True for rows without a negative measure; a null measure passes."""
    return reduce(Column.__and__, [F.coalesce(F.col(name), F.lit(0)) >= 0 for name in columns])


def non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a negative measure; a null measure passes."""
    return df.filter(is_non_negative(columns)) if columns else df


def incremental_filter(
    source: DataFrame,
    target: DataFrame | int | None,
    ts_col: str = "_loaded_at",
    period_col: Column | str = "periodo",
    reprocess: str | date | None = None,
) -> DataFrame:
    """Rows newer than the newest target row, and all rows of a reprocessed month.

    ``target=None`` is a first build and keeps everything. A target without rows has
    no newest row, so only the reprocessed month passes. The bound is an uncorrelated
    scalar subquery, which reaches the Parquet scan as a filter. Where the newest row is known,
    its time in microseconds may stand for the target (or ``NO_ROWS``), and nothing is read.
    """
    if target is None:
        return source
    if isinstance(target, DataFrame):
        newer = F.col(ts_col) > target.agg(F.max(ts_col)).scalar()
    else:
        newer = F.lit(False) if target == NO_ROWS else F.col(ts_col) > F.timestamp_micros(F.lit(target))
    if reprocess is None:
        return source.filter(newer)
    period = F.col(period_col) if isinstance(period_col, str) else period_col
    return source.filter(newer | (period == F.lit(reprocess).cast("date")))


def period_filter(
    df: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    column: str = "periodo",
) -> DataFrame:
    """Optional inclusive range; an open side filters nothing."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast("date"))
    return df


def latest_period(df: DataFrame, column: str = "periodo") -> DataFrame:
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def active_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose measures add up to more than zero; a null measure makes a row inactive."""
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return df.filter(total > 0)


def member_filter(df: DataFrame, column: str) -> DataFrame:
    """Current rows for a flag column, non-null members for any other column."""
    if df.schema[column].dataType.simpleString() == "boolean":
        return df.filter(F.col(column))
    return df.filter(F.col(column).isNotNull())


def match_labels(df: DataFrame, **matchers: str) -> DataFrame:
    """Label matchers: ``"value"``, ``"!=value"``, ``"=~regex"`` or ``"!~regex"``.

    A regex must match the whole label.
    """
    for label, matcher in matchers.items():
        value = F.col(label).cast("string")
        if matcher.startswith("=~"):
            df = df.filter(value.rlike(f"^(?:{matcher[2:]})$"))
        elif matcher.startswith("!~"):
            df = df.filter(~value.rlike(f"^(?:{matcher[2:]})$"))
        elif matcher.startswith("!="):
            df = df.filter(value != matcher[2:])
        else:
            df = df.filter(value == matcher)
    return df
