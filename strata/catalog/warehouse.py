"""Silver and gold of the given tables, built once per session like a monthly run."""

from __future__ import annotations

import hashlib
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from strata.plans.gold import (
    GOLD_SCHEMAS,
    MEMBERS_SCHEMA,
    Gold,
    dimensions,
    fct_produccion_conformed,
    month_members,
    unknown_wells,
)
from strata.plans.monthly import gold_frames
from strata.plans.silver import (
    STG_POZOS_SCHEMA,
    STG_PRODUCCION_SCHEMA,
    stg_pozos,
    stg_produccion,
)
from strata.session import in_parallel, scratch_root, sized
from strata.sources.snapshots import Snapshot, Transaction, current
from strata.sources.synthetic import pozos_raw, produccion_raw, report_months, report_tasks

INPUTS = ("lineitem", "part", "supplier", "nation", "region")


def warehouse_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the built tables; a change of an input file leads to a new one."""
    parts = [spark.sparkContext.applicationId]
    for name in INPUTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        parts += [path.toString(), str(status.getModificationTime()), str(status.getLen())]
    digest = hashlib.md5("|".join(parts).encode()).hexdigest()
    return f"{scratch_root(spark)}/strata-warehouse-{digest}"


def build_warehouse(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write silver, then gold from the written silver tables; all become visible at once."""
    with sized(spark, report_tasks(spark, sf_dir)):
        _build(spark, sf_dir, root)


def _build(spark: SparkSession, sf_dir: str, root: str) -> None:
    change = Transaction(spark, root)
    months, tasks = report_months(spark, sf_dir), report_tasks(spark, sf_dir)
    raw_wells, raw_reports = pozos_raw(spark, sf_dir), produccion_raw(spark, sf_dir)
    pozos, produccion = in_parallel(
        lambda: change.write(stg_pozos(raw_wells), "silver/stg_pozos", schema=STG_POZOS_SCHEMA),
        lambda: change.write(
            stg_produccion(raw_reports, months=months, tasks=tasks), "silver/stg_produccion",
            "periodo", schema=STG_PRODUCCION_SCHEMA, in_place=True,
        ),
    )
    members, unknown = in_parallel(
        lambda: change.write(month_members(produccion), "silver/members", schema=MEMBERS_SCHEMA),
        lambda: unknown_wells(produccion, pozos),
    )
    in_parallel(
        lambda: change.write(
            # Each file of silver is of one month.
            fct_produccion_conformed(produccion, pozos, unknown=unknown), "gold/fct_produccion",
            "periodo", schema=GOLD_SCHEMAS["fct_produccion"], in_place=True,
        ),
        *[
            partial(change.write, frame, f"gold/{name}", schema=GOLD_SCHEMAS[name])
            for name, frame in dimensions(pozos, members).items()
        ],
    )
    change.commit()


def warehouse(spark: SparkSession, sf_dir: str) -> Snapshot:
    """The built tables, as one snapshot."""
    root = warehouse_root(spark, sf_dir)
    held = current(spark, root)
    if "gold/fct_produccion" not in held.tables:
        build_warehouse(spark, sf_dir, root)
        held = current(spark, root)
    return held


def silver_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    held = warehouse(spark, sf_dir)
    return (
        held.read("silver/stg_pozos", STG_POZOS_SCHEMA),
        held.read("silver/stg_produccion", STG_PRODUCCION_SCHEMA),
    )


def gold_of(spark: SparkSession, sf_dir: str) -> Gold:
    return Gold(**gold_frames(warehouse(spark, sf_dir)))
