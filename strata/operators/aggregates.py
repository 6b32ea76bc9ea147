"""Aggregations over the star schema (A1-A9, A20) and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import path_bytes, sized, staged, tasks_for

PROFILE_SCHEMA = (
    "table_name string, column_name string, rows bigint, null_count bigint, min_value string, "
    "max_value string, distinct_count bigint"
)


def sum_total(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.sum(column).alias(alias))


def sum_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column | str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(alias) for alias, c in sums.items()])


def count_distinct(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(alias))


def max_value(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.max(column).alias(alias))


def count_filter(condition: Column, alias: str) -> Column:
    """Rows for which the condition is true; unknown does not count."""
    return F.count_if(condition).cast("long").alias(alias)


def duplicate_excess(df: DataFrame, keys: Sequence[str], alias: str = "failed_rows") -> DataFrame:
    """Rows beyond the first of every key."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    excess = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long")
    return groups.agg(excess.alias(alias))


def select_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def partition_counts(tables: Mapping[str, DataFrame], period: str) -> DataFrame:
    """Rows each bronze table holds for one load period."""
    return union_all(
        *[
            df.filter(F.col("_load_period") == period).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")
            )
            for name, df in tables.items()
        ]
    )


def month_counts(fact: DataFrame, period: str | None = None) -> DataFrame:
    """Rows and newest load per production month."""
    if period is not None:
        fact = fact.filter(F.col("periodo") == F.lit(period).cast("date"))
    return fact.groupBy("periodo").agg(
        F.count(F.lit(1)).alias("rows"), F.max("_loaded_at").alias("last_loaded_at")
    )


def distinct_count_gt(df: DataFrame, column: str, n: int) -> DataFrame:
    """One row telling whether the column has more than ``n`` distinct values."""
    found = df.agg(F.countDistinct(column).alias("distinct_values"))
    return found.withColumn("passed", F.col("distinct_values") > n)


# Size of a distinct-count sketch as a power of two, and the relative error that it keeps to
# with a probability of more than 99 %: three times its standard error of 0.83 / sqrt(2^14).
SKETCH_BITS = 14
DISTINCT_ERROR = 0.02


def profile_parts(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """What ``united_profile`` needs of a part of a table: a row per column (and ``by``).

    One pass without a further shuffle for distinct values: each task sends one sketch per
    column. Parts of a table that grows are profiled once, stored, and united later.
    """
    columns = [column for column in df.columns if column not in by]
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, column in enumerate(columns):
        value = F.col(f"`{column}`")
        parts += [
            F.count(value).alias(f"filled_{i}"),
            F.min(value).cast("string").alias(f"min_{i}"),
            F.max(value).cast("string").alias(f"max_{i}"),
            F.hll_sketch_agg(_sketchable(df, column), SKETCH_BITS).alias(f"sketch_{i}"),
        ]
    entries = [
        F.struct(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), F.col("rows"),
            (F.col("rows") - F.col(f"filled_{i}")).alias("null_count"),
            F.col(f"min_{i}").alias("min_value"), F.col(f"max_{i}").alias("max_value"),
            F.col(f"sketch_{i}").alias("sketch"),
        )
        for i, column in enumerate(columns)
    ]
    return df.groupBy(*by).agg(*parts).select(*by, F.inline(F.array(*entries)))


def _sketchable(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    value = F.col(f"`{column}`")
    # Sketches skip empty text, so text gets a mark before it.
    return value if kind in ("int", "bigint") else F.concat(F.lit("="), value.cast("string"))


def united_profile(parts: DataFrame) -> DataFrame:
    """One row per column of a table from the profiles of its parts.

    Smallest and largest values are compared as text, which is right for text columns and for
    a single part.
    """
    return parts.groupBy("table_name", "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"),
    )


def column_profile(df: DataFrame, name: str, exact: bool = False) -> DataFrame:
    """Rows, nulls, smallest, largest and distinct values of every column in one pass.

    Distinct counts are estimates within ``DISTINCT_ERROR`` unless ``exact`` is set; then the
    values of all columns are counted, by the task that reads them first, and the profile is
    staged, as its shuffles are sized by the files of ``df``.
    """
    if not exact:
        estimate = F.hll_sketch_estimate("sketch").alias("distinct_count")
        return profile_parts(df, name).select("*", estimate).drop("sketch")
    if all(_from_text(field.dataType, "value") is not None for field in df.schema):
        spark = df.sparkSession
        with sized(spark, tasks_for(path_bytes(spark, df.inputFiles()))):
            return staged(spark, _counted_profile(df, name), "profile")
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, column in enumerate(df.columns):
        value = F.col(f"`{column}`")
        parts += [
            F.count(value).alias(f"filled_{i}"),
            F.min(value).cast("string").alias(f"min_{i}"),
            F.max(value).cast("string").alias(f"max_{i}"),
            F.countDistinct(value).alias(f"distinct_{i}"),
        ]
    entries = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col("rows"),
            (F.col("rows") - F.col(f"filled_{i}")).alias("null_count"),
            F.col(f"min_{i}").alias("min_value"),
            F.col(f"max_{i}").alias("max_value"),
            F.col(f"distinct_{i}").alias("distinct_count"),
        )
        for i, column in enumerate(df.columns)
    ]
    return df.agg(*parts).select(F.inline(F.array(*entries)))


def _from_text(kind: T.DataType, value: str) -> str | None:
    """A value of a type from its text, for types whose equal values have equal texts."""
    if isinstance(kind, T.StringType):
        return f"`{value}`" if kind == T.StringType() else None
    if isinstance(kind, T.TimestampType):
        return f"timestamp_micros(cast(`{value}` as bigint))"
    if isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType, T.BooleanType)):
        return f"cast(`{value}` as {kind.simpleString()})"
    return None


def _counted_profile(df: DataFrame, name: str) -> DataFrame:
    """The exact profile from the number of rows of every value of every column.

    A row becomes one narrow row per column, which are counted before the shuffle; one
    column's values are not carried beside another's, and no text is held but as a key.
    """
    def text(field: T.StructField) -> str:
        value = f"`{field.name}`"
        return f"string(unix_micros({value}))" if isinstance(field.dataType, T.TimestampType) else f"string({value})"

    if not df.columns:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    cells = ", ".join(f"{i}, {text(field)}" for i, field in enumerate(df.schema))
    values = (
        df.selectExpr(f"stack({len(df.columns)}, {cells}) as (at, value)")
        .groupBy("at", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per column: a value is read in its column's type only.
    typed = [(i, field, _from_text(field.dataType, "value")) for i, field in enumerate(df.schema)]
    ends = [
        f"string({end}(case when at = {i} then {value} end)) as {end}_{i}"
        for i, _, value in typed for end in ("min", "max")
    ]
    counts = [
        part for i, _, _ in typed for part in (
            f"coalesce(sum(n) filter (where at = {i}), 0L) as rows_{i}",
            f"coalesce(sum(n) filter (where at = {i} and value is null), 0L) as null_{i}",
            f"count(value) filter (where at = {i}) as distinct_{i}",
        )
    ]
    rows = ", ".join(
        f"'{name}', '{field.name}', rows_{i}, null_{i}, min_{i}, max_{i}, distinct_{i}"
        for i, field, _ in typed
    )
    return values.agg(*[F.expr(part) for part in (*counts, *ends)]).selectExpr(
        f"stack({len(typed)}, {rows}) as "
        "(table_name, column_name, rows, null_count, min_value, max_value, distinct_count)"
    )


def union_distinct(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Members of both sides once each; null is a member like any other."""
    return left.select(column).union(right.select(column)).distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
