"""Picks up new bronze loads and merges them into silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from strata.plans.silver import PRODUCTION_KEYS, STG_PRODUCCION_SCHEMA, stg_produccion
from strata.session import SPLIT_BYTES, sized, tasks_for
from strata.sources.bronze import load_bytes, load_months, loads, scan_bronze
from strata.sources.snapshots import POINTERS, Transaction
from strata.sources.tables import PERIOD, stage_merge, table_name

INGESTED = "ingested"


def incremental_ingest(
    spark: SparkSession, root: str, name: str, checkpoint: str
) -> DataStreamWriter:
    """Stream over the pointers of a warehouse; start it with ``availableNow`` or a trigger.

    A new pointer says that something was published; the loads of the bronze table that silver
    was not made from yet are merged then, whole and with the columns their manifest has, so a
    column that a load brings while the stream runs is read. Of their rows the newest per key
    is merged where silver has none or an older one for the key; only the months of the batch
    are read and written. Which loads were merged is published with their rows, so a batch that
    is repeated after a failure changes nothing. Between rows of one load time that come apart,
    the one that came first stays.
    """
    stream = spark.readStream.text(f"{root}/{POINTERS}", wholetext=True)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_new_loads(batch.sparkSession, root, name)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def merge_new_loads(spark: SparkSession, root: str, name: str) -> list[str]:
    """Merge the loads that silver was not made from; their folders."""
    change = Transaction(spark, root)
    table = table_name("silver", "stg_produccion")
    done = set(change.info(table).get(INGESTED, []))
    new = {key: load["path"] for key, load in loads(change, name).items() if load["path"] not in done}
    if not new:
        return []
    info = {INGESTED: sorted(done | set(new.values()))}
    bronze, tasks = scan_bronze(spark, root, name, list(new), change), tasks_for(
        load_bytes(change, name, new), SPLIT_BYTES
    )
    with sized(spark, tasks):
        if table in change.tables:
            stage_merge(
                change, stg_produccion(bronze), "silver", "stg_produccion", PRODUCTION_KEYS,
                STG_PRODUCCION_SCHEMA, unique=True, only_newer=True, info=info,
            )
        else:
            fresh = stg_produccion(bronze, months=load_months(change, name, new), tasks=tasks)
            change.write(
                fresh, table, PERIOD, schema=STG_PRODUCCION_SCHEMA, info=info, in_place=True
            )
    change.commit()
    return sorted(new.values())
