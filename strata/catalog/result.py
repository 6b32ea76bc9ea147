"""Brings results into types every SQL engine prints alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and timestamps as text."""
    return df.selectExpr(*[_plain(field) for field in df.schema])


def _plain(field: T.StructField) -> str:
    name = f"`{field.name}`"
    if isinstance(field.dataType, T.DecimalType):
        return f"double({name}) as {name}"
    if isinstance(field.dataType, T.DateType):
        return f"string({name}) as {name}"
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss') as {name}"
    return name
