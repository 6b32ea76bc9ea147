"""Declarative data tests (Q1-Q8): what a failing row is, and how many there are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregates import distinct_count_gt
from strata.operators.joins import orphan_counts, relationships

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class DataTest:
    """One test of a table. ``kind`` is the name of the function that declares it.

    ``within`` names a column that the tested key determines, so that equal keys have equal
    values of it: rows with other values need not be looked at together.
    """

    kind: str
    table: str
    columns: tuple[str, ...]
    options: Mapping[str, object] = field(default_factory=dict)
    severity: str = ERROR
    within: str | None = None

    @property
    def name(self) -> str:
        return "_".join((self.kind, self.table, *self.columns))


def not_null(table: str, *columns: str) -> list[DataTest]:
    return [DataTest("not_null", table, (column,)) for column in columns]


def unique(table: str, *columns: str, within: str | None = None) -> list[DataTest]:
    return [DataTest("unique", table, (column,), within=within) for column in columns]


def holds_by_part(test: DataTest, partition_by: str) -> bool:
    """Whether a table passes the test if each of its partitions passes it alone."""
    if test.kind == "unique_combination":
        return partition_by in test.columns
    if test.kind == "unique":
        return test.within == partition_by or test.columns == (partition_by,)
    return failing_predicate(test) is not None


def unique_combination(table: str, *columns: str) -> list[DataTest]:
    return [DataTest("unique_combination", table, columns)]


def relationship(
    table: str, column: str, parent: str, parent_column: str, severity: str = ERROR
) -> list[DataTest]:
    options = {"parent": parent, "parent_column": parent_column}
    return [DataTest("relationships", table, (column,), options, severity)]


def accepted_values(table: str, column: str, values: Sequence[object]) -> list[DataTest]:
    return [DataTest("accepted_values", table, (column,), {"values": list(values)})]


def between(
    table: str, column: str, low: object | None = None, high: object | None = None
) -> list[DataTest]:
    return [DataTest("between", table, (column,), {"low": low, "high": high})]


def column_exists(table: str, *columns: str) -> list[DataTest]:
    return [DataTest("column_exists", table, (column,)) for column in columns]


def distinct_more_than(table: str, column: str, n: int) -> list[DataTest]:
    return [DataTest("distinct_count_gt", table, (column,), {"n": n})]


def failing_predicate(test: DataTest) -> str | None:
    """The test as a SQL condition on a single row, where it is one.

    Suites are long; SQL text keeps building their plans short.
    """
    column = f"`{test.columns[0]}`"
    if test.kind == "not_null":
        return f"{column} is null"
    if test.kind == "accepted_values":
        return f"{column} not in ({', '.join(_literal(v) for v in test.options['values'])})"
    if test.kind == "between":
        low, high = test.options["low"], test.options["high"]
        outside = [] if low is None else [f"{column} < {_literal(low)}"]
        outside += [] if high is None else [f"{column} > {_literal(high)}"]
        return " or ".join(outside) or "false"
    return None


def _literal(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, (date, datetime)):
        return f"{'timestamp' if isinstance(value, datetime) else 'date'} '{value}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def failing_rows(tables: Mapping[str, DataFrame], test: DataTest) -> DataFrame:
    """The rows, keys or result row that make a test fail."""
    df = tables[test.table]
    if test.kind == "column_exists":
        missing = df.sparkSession.createDataFrame(
            [(test.table, test.columns[0])], "table_name string, column_name string"
        )
        return missing.filter(F.lit(test.columns[0] not in df.columns))
    predicate = failing_predicate(test)
    if predicate is not None:
        return df.filter(predicate)
    if test.kind in ("unique", "unique_combination"):
        return repeated_keys(df, test.columns, skip_null=test.kind == "unique")
    if test.kind == "relationships":
        parent = tables[test.options["parent"]]
        return relationships(df, test.columns[0], parent, test.options["parent_column"])
    if test.kind == "distinct_count_gt":
        return distinct_count_gt(df, test.columns[0], test.options["n"]).filter("not passed")
    raise ValueError(f"unknown test kind {test.kind}")


def repeated_keys(df: DataFrame, columns: Sequence[str], skip_null: bool) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    if skip_null:
        df = df.filter(F.col(columns[0]).isNotNull())
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def repeated_counts(df: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """Numbers of repeated keys of several uniqueness tests: one row, a column per test.

    Each test reads and shuffles its own columns only, in their own types, and counts
    before the shuffle.
    """
    each = [
        repeated_keys(df, test.columns, skip_null=test.kind == "unique").agg(
            F.lit(i).alias("test"), F.count(F.lit(1)).alias("n")
        )
        for i, test in enumerate(tests)
    ]
    counted = reduce(DataFrame.unionByName, each)
    return counted.agg(
        *[F.max(F.when(F.col("test") == i, F.col("n"))).alias(f"failed_{i}") for i in range(len(tests))]
    )


def related_counts(
    tables: Mapping[str, DataFrame], child: DataFrame, tests: Sequence[DataTest]
) -> DataFrame:
    """Child rows without a parent for several relationship tests: one row."""
    parents = {
        test.columns[0]: (tables[test.options["parent"]], test.options["parent_column"])
        for test in tests
    }
    counted = orphan_counts(child, parents, null_fails=False)
    return counted.toDF(*[f"failed_{i}" for i in range(len(tests))])
