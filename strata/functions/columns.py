"""Column expressions shared by the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels and the null token that results must carry unchanged.
UNKNOWN_MEMBER = "SIN DATO"
OTHER_MEMBER = "Otras"
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def blank_to_null(column: Column | str) -> Column:
    """Trimmed text, null when nothing is left. Only spaces are trimmed."""
    return F.nullif(F.trim(_col(column)), F.lit(""))


def first_existing(df: DataFrame, names: Sequence[str], default: Column) -> Column:
    """The first of ``names`` that is a column of ``df``, else ``default``.

    The choice depends on the schema alone, never on the cells of a row.
    """
    present = {column.lower(): column for column in df.columns}
    for name in names:
        if name.lower() in present:
            return F.col(f"`{present[name.lower()]}`")
    return default


def unknown_member(column: Column | str, label: str = UNKNOWN_MEMBER) -> Column:
    return F.coalesce(_col(column), F.lit(label))


def normalize_key(column: Column | str) -> Column:
    """Upper-case trimmed key. A blank key stays the empty text, not null."""
    return F.upper(F.trim(_col(column)))


def typed_cast(column: Column | str, to: str, default: object | None = None) -> Column:
    """Blank text to null, everything else cast; text that does not parse raises."""
    value = blank_to_null(column).cast(to)
    return value if default is None else F.coalesce(value, F.lit(default).cast(to))


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), F.lit(1))


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the text of the key columns; null parts count as a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def calendar_attrs(column: Column | str) -> list[Column]:
    day = _col(column)
    return [
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.quarter(day).alias("trimestre"),
    ]


def scd2_current(df: DataFrame, loaded_at: str = "_loaded_at") -> DataFrame:
    """Validity columns of a dimension that keeps current members only."""
    open_end = F.lit(None).cast(df.schema[loaded_at].dataType)
    return df.withColumnRenamed(loaded_at, "valid_from").withColumns(
        {"valid_to": open_end, "is_current": F.lit(True)}
    )


def fallback_name(name: Column | str, key: Column | str) -> Column:
    return F.coalesce(_col(name), _col(key))


def pass_error(failed_rows: Column | str) -> Column:
    return F.when(_col(failed_rows) == 0, "PASS").otherwise("ERROR")


def other_bucket(
    name: Column | str, rank: Column | str, n: int, label: str = OTHER_MEMBER
) -> Column:
    return F.when(_col(rank) <= n, _col(name)).otherwise(F.lit(label))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
