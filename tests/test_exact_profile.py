"""Exact column profiles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from strata.operators.aggregates import column_profile
from tests.test_scale import _plan


def test_exact_profile_holds_no_column_beside_another(spark):
    rows = [(i % 3 or None, f"t{i % 4}" if i % 5 else None, i % 2 == 0, datetime(2024, 1, 1 + i % 6))
            for i in range(60)]
    df = spark.createDataFrame(rows, "n int, t string, b boolean, at timestamp").withColumns(
        {"d": F.col("at").cast("date"), "m": (F.col("n") / 4).cast("decimal(20,6)"),
         "none": F.lit(None).cast("string")}
    )
    got = {row.column_name: row for row in column_profile(df, "x", exact=True).collect()}
    for column in df.columns:
        value = F.col(column)
        want = df.agg(
            F.lit("x"), F.lit(column), F.count(F.lit(1)), F.count_if(value.isNull()),
            F.min(value).cast("string"), F.max(value).cast("string"), F.countDistinct(value),
        ).first()
        assert tuple(got[column]) == tuple(want)
    assert "Expand" not in _plan(column_profile(df, "x", exact=True))
    empty = column_profile(df.filter("false"), "x", exact=True).first()
    assert (empty.rows, empty.null_count, empty.min_value, empty.distinct_count) == (0, 0, None, 0)
