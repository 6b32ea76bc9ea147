"""Shapes the given TPC-H-like tables into the inputs of the platform.

The tables hold no wells, so parts play the wells, suppliers the companies, line items
the monthly reports and events the API requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.functions.text import row_hash
from strata.plans.gold import Gold, build_gold
from strata.plans.silver import stg_pozos, stg_produccion
from strata.session import SHUFFLE_KEY, child_directories, path_bytes, tasks_for

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def report_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the reports, by the size of the table they come from."""
    return tasks_for(path_bytes(spark, [f"{sf_dir}/lineitem.parquet"]))


def report_months(spark: SparkSession, sf_dir: str) -> int:
    """Number of months the reports are about, from a column of the table they come from."""
    return table(spark, sf_dir, "lineitem").select(F.trunc("l_shipdate", "month")).distinct().count()


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with the region they belong to."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("s_suppkey", "s_name", "r_name")
    )


def produccion_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as monthly well reports in bronze form.

    Cells are padded or blank as in a real source: the flat area column is empty,
    promotional parts have no resource type, untaxed lines no water, seventh lines no
    days. Returned lines with a large discount report a negative gas volume. A report
    is loaded some days after the month it covers.
    """
    # Dealt by well for the join with the wells, and whatever the files' splits are. The wells of
    # a task are hashed, its line items neither sorted nor held.
    tasks = max(int(spark.conf.get(SHUFFLE_KEY)), report_tasks(spark, sf_dir))
    lineitem = table(spark, sf_dir, "lineitem").repartition(tasks, "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type").hint("shuffle_hash")
    reports = lineitem.join(part, lineitem.l_partkey == part.p_partkey).join(
        companies(spark, sf_dir), lineitem.l_suppkey == F.col("s_suppkey")
    )
    sign = F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09), "-").otherwise("")
    month = F.trunc("l_shipdate", "month")
    cells = {
        "anio": _text(F.year("l_shipdate")),
        "area": F.lit(""),
        "areayacimiento": F.col("p_brand"),
        "cuenca": F.col("r_name"),
        "dias_produccion": F.when(F.col("l_linenumber") == 7, "").otherwise(_text("l_linenumber")),
        "empresa": F.col("s_name"),
        "idempresa": F.concat(F.lit(" s"), _text("l_suppkey")),
        "idpozo": F.concat(F.lit(" "), _text("l_partkey"), F.lit(" ")),
        "mes": F.concat(F.lit(" "), _text(F.month("l_shipdate"))),
        "prod_agua": F.when(F.col("l_tax") == 0, " ").otherwise(_money("l_tax")),
        "prod_gas": F.concat(sign, _money("l_quantity")),
        "prod_pet": _money("l_extendedprice"),
        "tipo_de_recurso": F.when(F.col("p_type") == "PROMO", " ").otherwise(F.col("p_type")),
    }
    loaded_at = F.date_add(F.add_months(month, 1), F.col("l_linenumber"))
    return _bronze(reports, cells, loaded_at)


def pozos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as well registrations in bronze form, two loads of every well.

    The first load knows no formation. The second is dated by part size, so it is the
    newer one only for larger parts.
    """
    part = table(spark, sf_dir, "part")
    owned = part.join(companies(spark, sf_dir), part.p_size == F.col("s_suppkey"), "left")
    loads = owned.withColumn("load", F.explode(F.array(F.lit(1), F.lit(2))))
    cells = {
        "areayacimiento": F.col("p_brand"),
        "cuenca": F.coalesce("r_name", F.lit("")),
        "empresa": F.coalesce("s_name", F.lit("")),
        "formprod": F.when(F.col("load") == 1, " ").otherwise(F.col("p_type")),
        "idempresa": F.concat(F.lit("s"), _text("p_size"), F.lit(" ")),
        "idpozo": _text("p_partkey"),
        "sigla": F.concat(F.lit(" "), "p_name", F.lit("-"), _text("p_size")),
        "tipo_reservorio": F.col("p_type"),
    }
    first = F.to_date(F.lit("1994-12-20"))
    loaded_at = F.when(F.col("load") == 1, first).otherwise(
        F.date_add(F.to_date(F.lit("1994-12-01")), F.col("p_size"))
    )
    return _bronze(loads, cells, loaded_at)


def silver_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stg_pozos(pozos_raw(spark, sf_dir)), stg_produccion(produccion_raw(spark, sf_dir))


def gold_tables(spark: SparkSession, sf_dir: str) -> Gold:
    return build_gold(*silver_tables(spark, sf_dir))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as API requests, before unrecorded paths are removed."""
    return requests_of(table(spark, sf_dir, "events"))


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests as a stream over the files of the events table."""
    path = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if not child_directories(spark, sf_dir, "events.parquet"):
        return requests_of(reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    return requests_of(reader.parquet(path))


def requests_of(events: DataFrame) -> DataFrame:
    even_user = F.col("user_id") % 2 == 0
    kind = F.col("event_type")
    path = (
        F.when(kind.isin("view", "purchase"), "/api/v1/forecast")
        .when(kind == "click", "/api/v1/wells")
        .when((kind == "signup") & even_user, "/healthz")
        .when(kind == "signup", "/docs/signup")
        .otherwise("/api/v1/unknown")
    )
    status = F.when(kind != "error", 200).when(even_user, 404).otherwise(500)
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "purchase", "POST").otherwise("GET").alias("method"),
        path.alias("path"),
        status.alias("status_code"),
        (F.col("value") / 10).alias("duration_s"),
    )


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly scrapes of one request counter per event type, reset at midnight."""
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("ts"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    since_reset = (
        W.partitionBy("series", F.to_date("ts"))
        .orderBy("ts")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return hourly.select(
        "series",
        F.col("ts").cast("timestamp").alias("ts"),
        F.sum("n").over(since_reset).cast("double").alias("value"),
    )


def forecast_wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as wells; the retail price is the base rate."""
    return table(spark, sf_dir, "part").select(
        _well_name("p_partkey").alias("id_well"), F.col("p_retailprice").alias("base_rate")
    )


def forecast_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order: a well, a start date and an end date.

    The number asked for is the customer's, and the length of the range comes from the
    order priority; unspecified priorities ask for a range that ends before it starts.
    """
    orders = table(spark, sf_dir, "orders")
    start = F.to_date("o_orderdate")
    days = F.when(F.col("o_orderpriority").startswith("4"), -1).otherwise(
        F.substring("o_orderpriority", 1, 1).cast("int") * 3
    )
    return orders.select(
        F.col("o_orderkey").alias("request_id"),
        _well_name(F.col("o_custkey") * 2).alias("id_well"),
        start.alias("date_start"),
        F.date_add(start, days).alias("date_end"),
    )


def _bronze(rows: DataFrame, cells: dict[str, Column], loaded_at: Column) -> DataFrame:
    shaped = rows.select(
        *[value.alias(name) for name, value in cells.items()],
        F.date_format(loaded_at, "yyyy-MM-01").alias("_load_period"),
        loaded_at.cast("timestamp").alias("_loaded_at"),
    )
    return shaped.withColumn("_row_hash", row_hash(list(cells)))


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY).cast("string")


def _well_name(number: Column | str) -> Column:
    return F.concat(F.lit("POZO-"), _text(number))
