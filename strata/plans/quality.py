"""Test suites of silver and gold, their results, and the gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import pass_error
from strata.operators import quality as q
from strata.operators.aggregates import count_filter, duplicate_excess, union_all
from strata.operators.joins import orphan_counts
from strata.operators.ordering import errors_first
from strata.operators.quality import DataTest
from strata.plans.gold import Gold
from strata.sources.tables import store_failures

# The declared tests of silver and gold.
SILVER_SUITE: tuple[DataTest, ...] = (
    *q.unique_combination("stg_produccion", "id_pozo", "periodo"),
    *q.not_null(
        "stg_produccion", "id_pozo", "id_empresa", "area", "cuenca", "tipo_recurso", "periodo",
        "prod_gas", "prod_petroleo", "dias_produccion",
    ),
    *q.relationship("stg_produccion", "id_pozo", "stg_pozos", "id_pozo", severity=q.WARN),
    *q.not_null("stg_pozos", "id_pozo"),
    *q.unique("stg_pozos", "id_pozo"),
)

GOLD_SUITE: tuple[DataTest, ...] = (
    *q.column_exists("dim_pozo", "pozo_key", "id_pozo", "is_current"),
    *q.not_null(
        "dim_pozo", "pozo_key", "id_pozo", "sigla", "formacion_productiva", "id_empresa", "area",
        "cuenca", "tipo_recurso", "valid_from", "is_current",
    ),
    *q.unique("dim_pozo", "pozo_key", "id_pozo"),
    *q.accepted_values("dim_pozo", "is_current", [True, False]),
    *q.column_exists("dim_empresa", "empresa_key", "id_empresa", "is_current"),
    *q.not_null("dim_empresa", "empresa_key", "id_empresa", "empresa", "valid_from", "is_current"),
    *q.unique("dim_empresa", "empresa_key", "id_empresa"),
    *q.accepted_values("dim_empresa", "is_current", [True, False]),
    *[
        test
        for member in ("area", "cuenca", "tipo_recurso")
        for test in (
            *q.distinct_more_than(f"dim_{member}", member, 1),
            *q.not_null(f"dim_{member}", f"{member}_key", member),
            *q.unique(f"dim_{member}", f"{member}_key", member),
        )
    ],
    *q.column_exists("dim_fecha", "fecha_key", "periodo", "mes"),
    *q.not_null("dim_fecha", "fecha_key", "periodo", "anio", "mes", "trimestre"),
    *q.unique("dim_fecha", "fecha_key", "periodo"),
    *q.between("dim_fecha", "mes", 1, 12),
    *q.unique_combination("fct_produccion", "id_pozo", "periodo"),
    *q.column_exists(
        "fct_produccion", "produccion_key", "pozo_key", "empresa_key", "fecha_key", "prod_gas",
        "prod_petroleo", "prod_agua", "dias_produccion",
    ),
    *q.not_null(
        "fct_produccion", "produccion_key", "pozo_key", "empresa_key", "area_key", "cuenca_key",
        "tipo_recurso_key", "fecha_key", "id_pozo", "id_empresa", "periodo", "prod_gas",
        "prod_petroleo", "prod_agua", "dias_produccion", "_loaded_at",
    ),
    # A surrogate of well and month.
    *q.unique("fct_produccion", "produccion_key", within="periodo"),
    *[
        test
        for name in ("pozo", "empresa", "area", "cuenca", "tipo_recurso", "fecha")
        for test in q.relationship("fct_produccion", f"{name}_key", f"dim_{name}", f"{name}_key")
    ],
    *q.between("fct_produccion", "prod_gas", 0),
    *q.between("fct_produccion", "prod_petroleo", 0),
    *q.between("fct_produccion", "prod_agua", 0),
    *q.between("fct_produccion", "dias_produccion", 0, 31),
)

# Age limits of a source in days.
WARN_AFTER_DAYS, ERROR_AFTER_DAYS = 35, 60
FAILED = "data tests failed: "


class QualityGateError(RuntimeError):
    """Tests of error severity failed; ``tests`` names them."""

    def __init__(self, tests: Sequence[str]):
        self.tests = sorted(tests)
        super().__init__(FAILED + ", ".join(self.tests))


class StaleSourceError(RuntimeError):
    """A bronze source is older than its error limit."""


def run_tests(
    tables: Mapping[str, DataFrame],
    suite: Sequence[DataTest],
    untested: Mapping[str, DataFrame] | None = None,
    partition_by: str = "periodo",
) -> DataFrame:
    """Result row per test: test, table_name, severity, failed_rows, status.

    Tests of a table share passes over it: one for all row conditions and distinct
    counts, one for all uniqueness tests, one for all relationships. ``untested`` has the rows
    of those partitions of a table that have not passed the suite before: tests that hold for a
    table if they hold for each partition look at these only.
    """
    frames = []
    groups = []
    for table in dict.fromkeys(test.table for test in suite):
        tests = [test for test in suite if test.table == table]
        if table in (untested or {}):
            by_part = [test for test in tests if q.holds_by_part(test, partition_by)]
            groups.append((untested[table], by_part))
            tests = [test for test in tests if test not in by_part]
        groups.append((tables[table], tests))
    for df, tests in groups:
        by_schema = [test for test in tests if test.kind == "column_exists"]
        by_key = [test for test in tests if test.kind in ("unique", "unique_combination")]
        by_parent = [test for test in tests if test.kind == "relationships"]
        by_scan = [test for test in tests if test not in (*by_schema, *by_key, *by_parent)]
        if by_schema:
            present = set(df.columns)
            missing = [
                f"{int(t.columns[0] not in present)}L as failed_{i}" for i, t in enumerate(by_schema)
            ]
            frames.append(_results(by_schema, df.sparkSession.range(1).selectExpr(*missing)))
        if by_scan:
            counts = [F.expr(f"{_scan_count(t)} as failed_{i}") for i, t in enumerate(by_scan)]
            frames.append(_results(by_scan, df.agg(*counts)))
        if by_key:
            frames.append(_results(by_key, q.repeated_counts(df, by_key)))
        if by_parent:
            frames.append(_results(by_parent, q.related_counts(tables, df, by_parent)))
    outcome = F.when(F.col("failed_rows") == 0, "pass").otherwise(
        F.when(F.col("severity") == q.WARN, "warn").otherwise("fail")
    )
    return union_all(*frames).withColumn("status", outcome)


def _scan_count(test: DataTest) -> str:
    if test.kind == "distinct_count_gt":
        return f"bigint(count(distinct `{test.columns[0]}`) <= {test.options['n']})"
    return f"count_if({q.failing_predicate(test)})"


def failures(
    tables: Mapping[str, DataFrame], suite: Sequence[DataTest], failed: Sequence[str]
) -> dict[str, DataFrame]:
    return {test.name: q.failing_rows(tables, test) for test in suite if test.name in failed}


def quality_gate(
    tables: Mapping[str, DataFrame],
    suite: Sequence[DataTest],
    root: str | None = None,
    untested: Mapping[str, DataFrame] | None = None,
) -> list[tuple[str, int, str]]:
    """Run a suite, store the failing rows and raise if an error-severity test failed.

    Only the result rows, one per declared test, come to the driver. For ``untested`` see
    ``run_tests``.
    """
    results = [
        (row.test, row.failed_rows, row.status)
        for row in run_tests(tables, suite, untested).collect()
    ]
    not_passed = [test for test, _, status in results if status != "pass"]
    if root is not None:
        spark = next(iter(tables.values())).sparkSession
        failed = failures(tables, suite, not_passed)
        store_failures(spark, failed, [t.name for t in suite], root)
    blocking = [test for test, _, status in results if status == "fail"]
    if blocking:
        raise QualityGateError(blocking)
    return results


def quality_marks(gold: Gold) -> DataFrame:
    """Eight named checks of the star schema with status and number of failed rows."""
    fact = gold.fct_produccion
    ranges = (
        (F.col("prod_gas") < 0)
        | (F.col("prod_petroleo") < 0)
        | (F.col("prod_agua") < 0)
        | (F.col("dias_produccion") < 0)
        | (F.col("dias_produccion") > 31)
    )
    month = F.col("mes")
    orphans = orphan_counts(
        fact,
        {
            "pozo_key": (gold.dim_pozo, "pozo_key"),
            "empresa_key": (gold.dim_empresa, "empresa_key"),
            "fecha_key": (gold.dim_fecha, "fecha_key"),
        },
    )
    checks = {
        ("dim_pozo_completeness", "dim_pozo"): _count(
            gold.dim_pozo,
            _any_null(
                "pozo_key", "id_pozo", "sigla", "formacion_productiva", "id_empresa", "area",
                "cuenca", "tipo_recurso", "is_current",
            ),
        ),
        ("dim_empresa_completeness", "dim_empresa"): _count(
            gold.dim_empresa, _any_null("empresa_key", "id_empresa", "empresa", "is_current")
        ),
        ("dim_fecha_valid_month", "dim_fecha"): _count(
            gold.dim_fecha, _any_null("fecha_key", "periodo", "mes") | (month < 1) | (month > 12)
        ),
        ("fct_produccion_measure_ranges", "fct_produccion"): _count(fact, ranges),
        ("fct_produccion_fact_grain", "fct_produccion"): duplicate_excess(
            fact, ["id_pozo", "periodo"]
        ),
    }
    rows = [
        counted.select(
            F.lit(name).alias("check_name"), F.lit(dimension).alias("dimension"), "failed_rows"
        )
        for (name, dimension), counted in checks.items()
    ]
    related = [
        F.struct(
            F.lit(f"fct_produccion_rel_{name}").alias("check_name"),
            F.lit("fct_produccion").alias("dimension"),
            F.col(f"{name}_key").alias("failed_rows"),
        )
        for name in ("pozo", "empresa", "fecha")
    ]
    rows.append(orphans.select(F.inline(F.array(*related))))
    return union_all(*rows).select(
        "check_name",
        "dimension",
        pass_error("failed_rows").alias("status"),
        "failed_rows",
        F.current_timestamp().alias("checked_at"),
    )


def quality_table(gold: Gold) -> DataFrame:
    return errors_first(quality_marks(gold))


def source_freshness(
    sources: Mapping[str, DataFrame],
    now: datetime | Column | None = None,
    warn_days: int = WARN_AFTER_DAYS,
    error_days: int = ERROR_AFTER_DAYS,
) -> DataFrame:
    """Age of the newest load of every source: pass, warn or error. No load is an error."""
    moment = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    newest = union_all(
        *[
            df.agg(F.lit(name).alias("source"), F.max("_loaded_at").alias("max_loaded_at"))
            for name, df in sources.items()
        ]
    )
    limit = {
        days: F.col("max_loaded_at") < moment - F.make_dt_interval(F.lit(days))
        for days in (warn_days, error_days)
    }
    status = (
        F.when(F.col("max_loaded_at").isNull() | limit[error_days], "error")
        .when(limit[warn_days], "warn")
        .otherwise("pass")
    )
    return newest.withColumn("status", status)


def check_freshness(sources: Mapping[str, DataFrame], now: datetime | None = None) -> None:
    """Raise before any transformation if a source is past its error limit."""
    stale = [
        row.source for row in source_freshness(sources, now).filter("status = 'error'").collect()
    ]
    if stale:
        raise StaleSourceError(f"stale sources: {', '.join(stale)}")


def publish_gate(marks: DataFrame, freshness: DataFrame) -> DataFrame:
    """One row: whether to publish, and the names of what stands against it.

    Both inputs are a fixed handful of rows, one per check and per source.
    """
    against = (
        marks.filter("status = 'ERROR'")
        .select(F.col("check_name").alias("name"))
        .union(freshness.filter("status <> 'pass'").select(F.concat(F.lit("freshness_"), "source")))
    )
    names = F.array_join(F.sort_array(F.collect_list("name")), ",")
    return against.agg(
        (F.count(F.lit(1)) == 0).alias("publish"), names.alias("failing_checks")
    )


def quality_alert(results: DataFrame, job_name: str, op_name: str, run_id: str) -> DataFrame:
    """Structured record of a run that its tests stop, with its JSON payload, keys in order.

    ``results`` are those of ``run_tests``; without a failed one there is no record.
    """
    names = F.array_sort(F.collect_list("test"))
    failed = results.filter("status = 'fail'").agg(names.alias("tests")).filter(F.size("tests") > 0)
    record = failed.select(
        # Fixed value: the name of the event.
        F.lit("data_quality_job_failed").alias("event"), F.lit(job_name).alias("job_name"),
        F.lit(op_name).alias("op_name"), F.lit(run_id).alias("run_id"),
        F.concat(F.lit(FAILED), F.array_join("tests", ", ")).alias("error"),
    )
    return record.withColumn("payload", F.to_json(F.struct(*sorted(record.columns))))


def _results(tests: Sequence[DataTest], counted: DataFrame) -> DataFrame:
    """A row per test from one row that holds the counts as ``failed_0``, ``failed_1``, ..."""
    rows = [
        f"'{test.name}', '{test.table}', '{test.severity}', failed_{i}"
        for i, test in enumerate(tests)
    ]
    return counted.selectExpr(
        f"stack({len(tests)}, {', '.join(rows)}) as (test, table_name, severity, failed_rows)"
    )


def _count(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(count_filter(condition, "failed_rows"))


def _any_null(*columns: str) -> Column:
    condition = F.col(columns[0]).isNull()
    for column in columns[1:]:
        condition = condition | F.col(column).isNull()
    return condition
