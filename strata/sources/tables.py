"""Silver and gold tables: layer writes, upsert, stored test failures."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.windows import SHARE, deal, latest_per_key
from strata.session import SPLIT_BYTES, TASK_BYTES, path_bytes, sized, staged, tasks_for
from strata.sources.snapshots import LOADED_AT, Snapshot, Transaction, current, part_key

PERIOD = "periodo"
FAILURES = "test_failures"


class DuplicateKeyError(ValueError):
    """An upsert batch holds a key more than once."""


def table_name(layer: str, name: str) -> str:
    return f"{layer}/{name}"


def write_layer(
    df: DataFrame, root: str, layer: str, name: str, partition_by: str | None = None,
    in_place: bool = False,
) -> None:
    """Materialise a model as a table of its layer, replacing what was there.

    For ``in_place`` see ``Transaction.write``.
    """
    change = Transaction(df.sparkSession, root)
    change.write(df, table_name(layer, name), partition_by, in_place=in_place)
    change.commit()


def publish_view(df: DataFrame, layer: str, name: str) -> None:
    """Expose a model as a view that is evaluated on every read."""
    df.createOrReplaceTempView(f"{layer}_{name}")


def read_layer(
    spark: SparkSession, root: str, layer: str, name: str, schema: str | None = None,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """Read a table as the newest snapshot, or a given one, has it.

    Tables that belong together are read from one snapshot. With a schema a table that was
    never written has no rows.
    """
    return (snapshot or current(spark, root)).read(table_name(layer, name), schema)


def layer_exists(spark: SparkSession, root: str, layer: str, name: str) -> bool:
    """Whether the table was published; folders alone do not count."""
    return table_name(layer, name) in current(spark, root).tables


def _dealt_union(
    target: DataFrame, source: DataFrame, keys: Sequence[str], months: int, tasks: int
) -> tuple[DataFrame, list[str]]:
    """Rows of both, those of the source with 1 as ``_came``, dealt by month; the keys to group by."""
    both = target.withColumn("_came", F.lit(0)).unionByName(source.withColumn("_came", F.lit(1)))
    others = [key for key in keys if key != PERIOD]
    return deal(both, PERIOD, others, months, tasks), [PERIOD, SHARE, *others]


def upsert_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], months: int = 1, tasks: int = 1
) -> DataFrame:
    """``target`` with the rows of ``source`` replacing those of equal key; no deletes.

    As in a join, a null is no key: such rows of the target stay. Rows come dealt by month.
    """
    both, groups = _dealt_union(target, source, keys, months, tasks)
    # The row of the source comes first in its group.
    replaced = F.max("_came").over(_so_far(groups, [F.col("_came").desc()]))
    stays = (F.col("_came") == 1) | (F.col("_replaced") == 0)
    for key in keys:
        stays = stays | F.col(key).isNull()
    return both.withColumn("_replaced", replaced).filter(stays).select(*target.columns)


def upsert_newest(
    target: DataFrame, versions: DataFrame, keys: Sequence[str], ties: Sequence[str],
    keep: Column, months: int = 1, tasks: int = 1,
) -> DataFrame:
    """``upsert_rows`` with the newest row per key of ``versions``, where it meets ``keep``.

    A newest row that does not meet it is dropped after it has won, so neither it nor an older
    version of its key replaces anything. Versions are ranked where they meet the target, behind
    the one shuffle of both. For ``ties`` see ``latest_per_key``.
    """
    none = [F.lit(None).cast(versions.schema[name].dataType).alias(name) for name in ties]
    both, groups = _dealt_union(
        target.select("*", *none), versions.select(*target.columns, *ties), keys, months, tasks
    )
    by = [F.col("_came").desc(), F.col(LOADED_AT).desc_nulls_first()]
    order = [*by, *[F.col(name).asc_nulls_first() for name in ties]]
    so_far, came = _so_far(groups, order), F.col("_came") == 1
    won = came & F.coalesce(keep, F.lit(False))
    placed = both.withColumns(
        {"_place": F.row_number().over(so_far), "_replaced": F.first(won).over(so_far)}
    )
    stays = ~F.col("_replaced")
    for key in keys:
        stays = stays | F.col(key).isNull()
    stays = F.when(came, won & (F.col("_place") == 1)).otherwise(stays)
    return placed.filter(stays).select(*target.columns)


def _so_far(groups: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    return W.partitionBy(*groups).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)


def newer_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], months: int = 1, tasks: int = 1
) -> DataFrame:
    """``target`` with rows of ``source`` where it has none, or an older one, of their key."""
    both, groups = _dealt_union(target, source, keys, months, tasks)
    return latest_per_key(both, groups, LOADED_AT, ["_came"]).select(*target.columns)


def check_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    repeated = source.groupBy(*keys).count().filter("count > 1").limit(1)
    if not repeated.isEmpty():
        raise DuplicateKeyError(f"more than one source row per {list(keys)}")


def stage_merge(
    change: Transaction,
    source: DataFrame,
    layer: str,
    name: str,
    keys: Sequence[str],
    schema: str,
    unique: bool = False,
    only_newer: bool = False,
    info: dict | None = None,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Stage an upsert of ``source`` into a table partitioned by month.

    Only the months that occur in the batch are read and written, once, so the month must
    be one of the keys. The batch is written to the scratch folder first, as it may derive
    from the table and is read several times. With ``only_newer`` a row replaces one of its
    key only if it comes from a later load.

    ``derived`` are columns that are functions of the others. They are not moved: neither side
    needs them, and they are computed for what is written. Such a batch is read where it lies, so
    it must not derive from the table.
    """
    derived = derived or {}
    columns = StructType.fromDDL(schema)
    moved = [column for column in columns.names if column not in derived]
    batch = source.select(*moved)
    if not derived:
        batch = staged(source.sparkSession, batch, "batch")
    if not unique:
        check_unique_keys(batch, keys)
    merge = newer_rows if only_newer else upsert_rows

    def merged(target: DataFrame, months: int, tasks: int) -> DataFrame:
        rows = merge(target.select(*moved), batch, keys, months, tasks)
        return rows.withColumns(dict(derived)) if derived else rows

    size = path_bytes(source.sparkSession, batch.inputFiles())
    return _merge_months(change, batch, layer, name, keys, columns, merged, size, TASK_BYTES, info)


def stage_newest(
    change: Transaction,
    versions: DataFrame,
    layer: str,
    name: str,
    keys: Sequence[str],
    schema: str,
    ties: Sequence[str],
    keep: Column,
    size: int,
) -> DataFrame:
    """Stage an upsert of the newest row per key of ``versions``; see ``upsert_newest``.

    Versions are read where they lie, so they must not derive from the table; ``size`` are the
    bytes of the loads that they come from.
    """
    columns = StructType.fromDDL(schema)

    def merged(target: DataFrame, months: int, tasks: int) -> DataFrame:
        return upsert_newest(target, versions, keys, ties, keep, months, tasks)

    return _merge_months(change, versions, layer, name, keys, columns, merged, size, SPLIT_BYTES)


def _merge_months(
    change: Transaction,
    batch: DataFrame,
    layer: str,
    name: str,
    keys: Sequence[str],
    columns: StructType,
    merged: Callable[[DataFrame, int, int], DataFrame],
    size: int,
    each: int,
    info: dict | None = None,
) -> DataFrame:
    """Write what ``merged`` makes of the months of a table that occur in the batch.

    It gets those months, their number, and tasks for ``each`` bytes of the ``size`` of the batch.
    """
    if PERIOD not in keys:
        raise ValueError(f"{PERIOD} must be one of the merge keys")
    spark, table = change.spark, table_name(layer, name)
    # One row per month of the batch.
    touched = [part_key(PERIOD, row[0]) for row in batch.select(PERIOD).distinct().collect()]
    if not touched:
        return change.put(table, {}, columns, PERIOD, replace=[], info=info)
    held = [key for key in touched if key in change.parts(table)]
    target = change.read(table, columns, held)
    folders = [f"{change.root}/{table}/{change.parts(table)[key]['path']}" for key in held]
    tasks = tasks_for(path_bytes(spark, folders)) + tasks_for(size, each)
    with sized(spark, tasks):
        rows = merged(target, len(touched), tasks)
        return change.write(
            rows, table, PERIOD, replace=touched, schema=columns, info=info, in_place=True
        )


def merge_upsert(
    source: DataFrame,
    root: str,
    layer: str,
    name: str,
    keys: Sequence[str],
    schema: str,
    unique: bool = False,
) -> None:
    """Upsert ``source`` into a table partitioned by month; see ``stage_merge``."""
    change = Transaction(source.sparkSession, root)
    stage_merge(change, source, layer, name, keys, schema, unique)
    change.commit()


def store_failures(
    spark: SparkSession, failures: Mapping[str, DataFrame], tests: Sequence[str], root: str
) -> list[str]:
    """Make the stored failures of ``tests`` those of the newest run, all at once.

    The failing rows of a test go to a table of its own; a test without any loses the
    table an earlier run has left.
    """
    change = Transaction(spark, root)
    for test in tests:
        if test in failures:
            change.write(failures[test], table_name(FAILURES, test))
        elif table_name(FAILURES, test) in change.tables:
            change.remove(table_name(FAILURES, test))
    change.commit()
    return [test for test in tests if test in failures]


def stored_failures(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Failing rows of the newest run by test."""
    held = current(spark, root)
    names = [name for name in held.tables if name.startswith(f"{FAILURES}/")]
    return {name.split("/", 1)[1]: held.read(name) for name in sorted(names)}
