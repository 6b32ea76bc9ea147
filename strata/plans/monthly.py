"""The monthly run: bronze, freshness, silver, tests, gold, tests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.aggregates import duplicate_excess, month_counts, partition_counts
from strata.operators.filters import NO_ROWS, is_non_negative
from strata.operators.quality import DataTest
from strata.plans import gold as g
from strata.plans import quality
from strata.plans import silver as s
from strata.session import SPLIT_BYTES, in_parallel, sized, tasks_for
from strata.sources.bronze import (
    load_bytes,
    load_months,
    loads,
    loads_since,
    newest_loads,
    scan_bronze,
    stage_load,
    with_load_metadata,
)
from strata.sources.csv_text import read_csv_text
from strata.sources.snapshots import Snapshot, Transaction, current, part_key, part_value
from strata.sources.tables import (
    PERIOD,
    publish_view,
    read_layer,
    stage_merge,
    stage_newest,
    table_name,
)

PRODUCTION_RAW, WELLS_RAW = "produccion_raw", "pozos_raw"
FIRST_PERIOD = "2026-01-01"


@dataclass(frozen=True)
class Landed:
    """Landed files of one load of one resource."""

    paths: str | Sequence[str]
    source_url: str
    resource_id: str
    # Whether a cell may span lines; without such cells, files are read in splits.
    multi_line: bool = True


def load_bronze(
    change: Transaction,
    name: str,
    landed: Landed,
    period: str,
    loaded_at: datetime | None = None,
) -> int:
    """Stage one load of a resource and return its rows."""
    rows = read_csv_text(change.spark, landed.paths, landed.multi_line)
    loaded = with_load_metadata(rows, period, landed.source_url, landed.resource_id, loaded_at)
    return stage_load(change, loaded, name, period)


def run_period(
    spark: SparkSession,
    root: str,
    period: str,
    production: Landed,
    wells: Landed,
    loaded_at: datetime | None = None,
    now: datetime | None = None,
) -> g.Gold:
    """Load one period and bring silver and gold up to date with it.

    The period also names the production month that is reprocessed from all loads.
    Running a period again converges to the same tables. Both loads become visible at once,
    and so do, after all tests, the tables of silver and gold.
    """
    change = Transaction(spark, root)
    in_parallel(
        lambda: load_bronze(change, PRODUCTION_RAW, production, period, loaded_at),
        lambda: load_bronze(change, WELLS_RAW, wells, period, loaded_at),
    )
    change.commit()
    return transform(spark, root, period, now)


def transform(
    spark: SparkSession,
    root: str,
    reprocess: str | None = None,
    now: datetime | None = None,
    full_refresh: bool = False,
) -> g.Gold:
    """Bronze to gold. A stale source or a failed test stops everything after it.

    What is read is what changed: loads newer than silver and those that may report on the
    reprocessed month, the months their reports are about, and the members of each month. All
    tables are staged and tested, and one commit makes them visible. Shuffles have tasks by the
    size of the bronze tables.
    """
    change = Transaction(spark, root)
    size = sum(load_bytes(change, name) for name in (PRODUCTION_RAW, WELLS_RAW))
    with sized(spark, tasks_for(size, SPLIT_BYTES)):
        return _transform(change, reprocess, now, full_refresh)


def _transform(
    change: Transaction, reprocess: str | None, now: datetime | None, full_refresh: bool
) -> g.Gold:
    spark, root = change.spark, change.root
    sources = {
        name: scan_bronze(spark, root, name, newest_loads(change, name), change)
        for name in (PRODUCTION_RAW, WELLS_RAW)
    }
    quality.check_freshness(sources, now)

    pozos, _ = in_parallel(
        lambda: _wells(change, full_refresh), lambda: _reports(change, reprocess, full_refresh)
    )
    _, members = in_parallel(
        lambda: _gate(change, "silver", ("stg_pozos", "stg_produccion"), quality.SILVER_SUITE),
        lambda: _members(change, full_refresh),
    )
    models = g.dimensions(pozos, members)
    in_parallel(
        *[
            partial(change.write, frame, table_name("gold", name), schema=g.GOLD_SCHEMAS[name])
            for name, frame in models.items()
        ],
        lambda: _facts(change, pozos, reprocess, full_refresh),
    )
    _gate(change, "gold", tuple(g.GOLD_SCHEMAS), quality.GOLD_SUITE)
    held = change.commit()
    star = g.Gold(**gold_frames(held))
    publish_view(quality.quality_marks(star), "gold", "quality_marks")
    return star


def _since(change: Transaction, table: str, full_refresh: bool) -> int | None:
    """Newest load that a table holds; none where it is to be built in full."""
    if full_refresh or table not in change.tables:
        return None
    newest = change.newest(table)
    return NO_ROWS if newest is None else newest


def _wells(change: Transaction, full_refresh: bool) -> DataFrame:
    """The well list: newer loads on top of it, or all loads where one of its own has gone."""
    table = table_name("silver", "stg_pozos")
    made_from = {load["path"]: load["newest"] for load in loads(change, WELLS_RAW).values()}
    held = {} if full_refresh else change.info(table).get("made_from", {})
    added = {path: newest for path, newest in made_from.items() if path not in held}
    times = [t for t in held.values() if t is not None]
    grown = held.items() <= made_from.items() and all(
        t is None or t > max(times, default=NO_ROWS) for t in added.values()
    )
    if held and grown:
        keys = [k for k, load in loads(change, WELLS_RAW).items() if load["path"] in added]
        if not keys:
            return change.read(table, s.STG_POZOS_SCHEMA)
        bronze = scan_bronze(change.spark, change.root, WELLS_RAW, keys, change)
        rows = s.newer_pozos(change.read(table, s.STG_POZOS_SCHEMA), bronze)
    else:
        rows = s.stg_pozos(scan_bronze(change.spark, change.root, WELLS_RAW, snapshot=change))
    return change.write(rows, table, schema=s.STG_POZOS_SCHEMA, info={"made_from": made_from})


def _reports(change: Transaction, reprocess: str | None, full_refresh: bool) -> DataFrame:
    table = table_name("silver", "stg_produccion")
    since = _since(change, table, full_refresh)
    keys = None if since is None else loads_since(change, PRODUCTION_RAW, since, reprocess)
    bronze = scan_bronze(change.spark, change.root, PRODUCTION_RAW, keys, change)
    if since is None:
        tasks = tasks_for(load_bytes(change, PRODUCTION_RAW), SPLIT_BYTES)
        batch = s.stg_produccion(
            bronze, None, reprocess, load_months(change, PRODUCTION_RAW), tasks
        )
        return change.write(batch, table, PERIOD, schema=s.STG_PRODUCCION_SCHEMA, in_place=True)
    versions = s.short_hashes(s.report_versions(bronze, since, reprocess))
    return stage_newest(
        change, versions, "silver", "stg_produccion", s.PRODUCTION_KEYS, s.STG_PRODUCCION_SCHEMA,
        ["_row_hash"], is_non_negative(s.VOLUMES), load_bytes(change, PRODUCTION_RAW, keys),
    )


def _members(change: Transaction, full_refresh: bool) -> DataFrame:
    """Members of all months; those of months whose reports are unchanged are kept.

    Only changed months of silver are read. The table itself is small and written whole.
    """
    table, source = table_name("silver", "members"), table_name("silver", "stg_produccion")
    reports, made_from = change.parts(source), change.info(table).get("made_from", {})
    if full_refresh:
        made_from = {}
    stale = [key for key, part in reports.items() if made_from.get(key) != part["path"]]
    rows = g.month_members(change.read(source, s.STG_PRODUCCION_SCHEMA, stale))
    kept = [part_value(key) for key in reports if key not in stale]
    if kept:
        held = change.read(table, g.MEMBERS_SCHEMA)
        rows = held.filter(F.col(PERIOD).cast("string").isin(kept)).unionByName(rows)
    paths = {key: part["path"] for key, part in reports.items()}
    return change.write(rows, table, schema=g.MEMBERS_SCHEMA, info={"made_from": paths})


def _facts(
    change: Transaction, pozos: DataFrame, reprocess: str | None, full_refresh: bool
) -> DataFrame:
    """The fact table; months of silver without a newer load are not read."""
    table, source = table_name("gold", "fct_produccion"), table_name("silver", "stg_produccion")
    since = _since(change, table, full_refresh)
    keys = None
    if since is not None:
        again = None if reprocess is None else part_key(PERIOD, str(reprocess)[:10])
        keys = [
            key for key, part in change.parts(source).items()
            if key == again or (part.get("newest") or NO_ROWS) > since
        ]
    produccion = change.read(source, s.STG_PRODUCCION_SCHEMA, keys)
    unknown = g.unknown_wells(produccion, pozos)
    batch = g.fct_produccion_conformed(produccion, pozos, since, reprocess, unknown)
    schema = g.GOLD_SCHEMAS["fct_produccion"]
    if since is None:
        # Each file of silver is of one month.
        return change.write(batch, table, PERIOD, schema=schema, in_place=True)
    return stage_merge(
        change, batch, "gold", "fct_produccion", g.FACT_KEYS, schema, unique=True,
        derived=g.fact_surrogates(),
    )


def _gate(change: Transaction, layer: str, names: Sequence[str], suite: Sequence[DataTest]) -> None:
    """Test staged tables; months that have passed the suite before are not tested again.

    A failed gate ends the transaction, so nothing of it is ever seen.
    """
    mark = f"passed_{layer}"
    tables = {name: change.read(table_name(layer, name)) for name in names}
    untested, keys = {}, {}
    for name in names:
        table = table_name(layer, name)
        if change.tables[table]["partition_by"]:
            keys[table] = [k for k, part in change.parts(table).items() if not part.get(mark)]
            untested[name] = change.read(table, keys=keys[table])
    try:
        quality.quality_gate(tables, suite, change.root, untested)
    except quality.QualityGateError:
        change.discard()
        raise
    for table, tested in keys.items():
        for key in tested:
            change.note(table, key, **{mark: True})


def gold_frames(held: Snapshot) -> dict[str, DataFrame]:
    return {
        name: held.read(table_name("gold", name), schema) for name, schema in g.GOLD_SCHEMAS.items()
    }


def months(spark: SparkSession, start: str, end: str) -> list[str]:
    """First days of the months from ``start`` to ``end``."""
    span = spark.range(1).select(
        F.explode(
            F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 month"))
        ).alias("month")
    )
    return [row.month.isoformat() for row in span.collect()]


def latest_closed_period(today: date, first: str = FIRST_PERIOD) -> str | None:
    """Newest month that is over on ``today``; none before the first one has ended."""
    year, month = (today.year, today.month - 1) if today.month > 1 else (today.year - 1, 12)
    period = date(year, month, 1).isoformat()
    return period if period >= first else None


def backfill(
    spark: SparkSession,
    root: str,
    periods: Sequence[str],
    landed: dict[str, tuple[Landed, Landed]],
    loaded_at: dict[str, datetime] | None = None,
    now: datetime | None = None,
) -> g.Gold | None:
    """Run closed months in order; every run builds on the tables of the one before."""
    star = None
    for period in sorted(periods):
        production, wells = landed[period]
        at = (loaded_at or {}).get(period)
        star = run_period(spark, root, period, production, wells, at, now)
    return star


def closed_periods(
    spark: SparkSession, root: str, today: date, first: str = FIRST_PERIOD
) -> list[str]:
    """Months that are over on ``today`` and have no load yet, oldest first."""
    newest = latest_closed_period(today, first)
    if newest is None:
        return []
    held = current(spark, root)
    loaded = [
        {load["period"] for load in loads(held, name).values()} for name in (PRODUCTION_RAW, WELLS_RAW)
    ]
    return [month for month in months(spark, first, newest) if not all(month in own for own in loaded)]


def catch_up(
    spark: SparkSession,
    root: str,
    today: date,
    landed: Callable[[str], tuple[Landed, Landed]],
    first: str = FIRST_PERIOD,
    loaded_at: dict[str, datetime] | None = None,
    now: datetime | None = None,
) -> g.Gold | None:
    """Run every closed month that has not been loaded, as a schedule does each month.

    A month whose run failed after its load is tried again by ``run_period``.
    """
    periods = closed_periods(spark, root, today, first)
    return backfill(spark, root, periods, {p: landed(p) for p in periods}, loaded_at, now)


def verify_reload(spark: SparkSession, root: str, period: str) -> DataFrame:
    """What a reload left: rows per bronze table, duplicate grain, month rows, newest load."""
    held = current(spark, root)
    tables = {
        name: scan_bronze(spark, root, name, snapshot=held) for name in (PRODUCTION_RAW, WELLS_RAW)
    }
    schema = g.GOLD_SCHEMAS["fct_produccion"]
    fact = read_layer(spark, root, "gold", "fct_produccion", schema, held)
    month = fact.filter(F.col("periodo") == F.lit(period).cast("date"))
    counts = partition_counts(tables, period).select(
        F.concat(F.lit("rows_"), "table_name").alias("check_name"),
        F.col("rows").cast("string").alias("value"),
    )
    grain = duplicate_excess(month, ["id_pozo", "periodo"]).select(
        F.lit("duplicate_grain").alias("check_name"), F.col("failed_rows").cast("string").alias("value")
    )
    loaded = month_counts(fact, period).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("fact_rows").alias("check_name"), F.col("rows").cast("string").alias("value")
                ),
                F.struct(
                    F.lit("last_loaded_at").alias("check_name"),
                    F.col("last_loaded_at").cast("string").alias("value"),
                ),
            )
        )
    )
    return counts.unionByName(grain).unionByName(loaded)
