"""Queries for sources, sinks, joins, aggregates, tests, forecast and the monthly run."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog.result import plain
from strata.catalog.warehouse import gold_of, silver_of
from strata.functions import columns as col
from strata.functions.text import canonical_json, summarize_text, title_words
from strata.operators import aggregates as agg
from strata.operators import filters as flt
from strata.operators import forecast as fc
from strata.operators import joins as jn
from strata.operators import ordering as order
from strata.operators import quality as q
from strata.operators.windows import latest_per_key, rank_total
from strata.plans import quality
from strata.plans.gold import GOLD_SCHEMAS, fct_produccion
from strata.plans.monthly import Landed, backfill, catch_up, run_period, verify_reload
from strata.plans.profiles import bronze_profile
from strata.plans.silver import STG_PRODUCCION_SCHEMA, newest_dealt, type_production
from strata.session import scratch_path, sized
from strata.sources.bronze import (
    bronze_path,
    evolve_schema,
    replace_partition,
    scan_bronze,
    source_columns,
    with_load_metadata,
)
from strata.sources.csv_text import read_csv_text
from strata.sources.synthetic import (
    forecast_requests,
    forecast_wells,
    pozos_raw,
    produccion_raw,
    report_months,
    report_tasks,
    table,
)
from strata.sources.tables import merge_upsert, read_layer, stored_failures, write_layer
from strata.streaming.ingest import incremental_ingest

LOADED_AT = datetime(2026, 2, 1, 3)
CHECKED_AT = datetime(2026, 2, 20)


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def land_csv(df: DataFrame, label: str) -> str:
    """Write a table as quoted CSV with a header, the form resources arrive in.

    Files are read once or twice, so they are packed by the fastest level of their codec.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(
        header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False, emptyValue="", compression="gzip",
    ).option("zlib.compress.level", "BEST_SPEED").csv(path)
    return path


def csv_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, through a landed CSV."""
    documents = table(spark, d, "documents").select(
        "doc_id", "lang", F.col("text").alias("Document Text"), "source"
    )
    return read_csv_text(spark, land_csv(documents, "documents"))


def loaded_suppliers(spark: SparkSession, d: str) -> DataFrame:
    supplier = _as_text(table(spark, d, "supplier"))
    loaded = with_load_metadata(supplier, "2026-01-01", "file:supplier", "supplier", LOADED_AT)
    return plain(loaded)


def row_texts(spark: SparkSession, d: str) -> DataFrame:
    """Canonical JSON of messages, with the characters JSON escapes."""
    rows = _as_text(table(spark, d, "conversations"))
    return rows.select("conv_id", "turn", canonical_json(rows.columns).alias("canonical"))


def reloaded_orders(spark: SparkSession, d: str) -> DataFrame:
    """Three load periods, one loaded twice, one replaced, one emptied."""
    root = scratch_path(spark, "bronze")
    path = bronze_path(root, "orders_raw")
    orders = _as_text(table(spark, d, "orders"))
    loads = [
        ("2026-01", orders),
        ("2026-01", orders),
        ("2026-02", orders),
        ("2026-02", orders.filter("o_orderstatus = 'F'")),
        ("2026-03", orders),
        ("2026-03", orders.filter(F.lit(False))),
    ]
    for period, rows in loads:
        loaded = with_load_metadata(rows, period, "file:orders", "orders", LOADED_AT)
        replace_partition(loaded, path, period)
    return scan_bronze(spark, root, "orders_raw").groupBy("_load_period").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("o_orderkey").alias("orders"),
        F.min("o_orderstatus").alias("status"),
    )


def widened_bronze(spark: SparkSession, d: str) -> DataFrame:
    """A second load brings a column the first did not have."""
    root = scratch_path(spark, "bronze")
    path = bronze_path(root, "customer_raw")
    customer = _as_text(table(spark, d, "customer"))
    for period, rows in (
        ("2026-01", customer.drop("c_mktsegment")), ("2026-02", customer),
    ):
        loaded = with_load_metadata(rows, period, "file:customer", "customer", LOADED_AT)
        replace_partition(loaded, path, period)
    stored = scan_bronze(spark, root, "customer_raw")
    return stored.select(*source_columns(stored), "_load_period")


def unioned_places(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select(F.col("n_name").alias("name"), "n_nationkey")
    supplier = table(spark, d, "supplier").select(F.col("s_name").alias("name"), "s_acctbal")
    return evolve_schema(nation, supplier)


def upserted_production(spark: SparkSession, d: str) -> DataFrame:
    """Two batches merged into a table, the second also correcting rows of the first."""
    root = scratch_path(spark, "merge")
    keys = ["id_pozo", "periodo"]
    typed = type_production(produccion_raw(spark, d))
    early = typed.filter("dias_produccion <= 3")
    late = typed.filter("dias_produccion > 3")
    months, tasks = report_months(spark, d), report_tasks(spark, d)
    with sized(spark, tasks):
        first, second = (newest_dealt(rows, months, tasks) for rows in (early, late))
        write_layer(first, root, "silver", "merged", "periodo", in_place=True)
        merge_upsert(second, root, "silver", "merged", keys, STG_PRODUCCION_SCHEMA)
    return plain(read_layer(spark, root, "silver", "merged", STG_PRODUCCION_SCHEMA))


def increment(spark: SparkSession, d: str) -> DataFrame:
    """Silver rows a fact that ends in 1996 lacks, and a reprocessed month."""
    produccion = silver_of(spark, d)[1]
    known = produccion.filter("periodo < date '1997-01-01'")
    return plain(flt.incremental_filter(produccion, known, reprocess="1996-05-01"))


def first_increment(spark: SparkSession, d: str) -> DataFrame:
    """Against a target without rows only the reprocessed month passes."""
    produccion = silver_of(spark, d)[1]
    empty = produccion.filter(F.lit(False))
    return plain(flt.incremental_filter(produccion, empty, reprocess="1996-05-01"))


def keyed_rows(spark: SparkSession, d: str) -> DataFrame:
    raw = produccion_raw(spark, d)
    return flt.required_keys(raw, ["prod_agua", "dias_produccion"]).select(
        "idpozo", "anio", "mes", "prod_agua", "dias_produccion", "_row_hash"
    )


def cleaned_columns(spark: SparkSession, d: str) -> DataFrame:
    raw = produccion_raw(spark, d)
    day = col.month_start("anio", "mes")
    return plain(
        raw.select(
            "_row_hash",
            col.blank_to_null("prod_agua").alias("water_text"),
            col.first_existing(raw, ["AreaYacimiento", "area"], F.lit(None)).alias("area"),
            col.first_existing(raw, ["operador"], F.col("idempresa")).alias("operator"),
            col.unknown_member(col.blank_to_null("tipo_de_recurso")).alias("resource"),
            col.normalize_key("idempresa").alias("company"),
            col.typed_cast("dias_produccion", "int", 0).alias("days"),
            col.typed_cast("prod_agua", "decimal(20,6)").alias("water"),
            day.alias("month"),
            *col.calendar_attrs(day),
            col.surrogate_key(col.blank_to_null("prod_agua"), "idpozo").alias("key_with_null"),
            col.fallback_name(col.blank_to_null("area"), "empresa").alias("name"),
        )
    )


def star(spark: SparkSession, d: str) -> DataFrame:
    """The fact by joins with all six dimensions."""
    return plain(fct_produccion(silver_of(spark, d)[1], gold_of(spark, d)))


def ranked_customers(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    spent = orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    return plain(rank_total(spent, "o_custkey", "total", 25))


def bucketed_orders(spark: SparkSession, d: str) -> DataFrame:
    """Order value per status and customer segment, the three largest segments by name."""
    orders = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    priced = orders.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    labelled = order.top_n_others(priced, "c_mktsegment", "price", "segment", n=3)
    return plain(agg.sum_by(labelled, ["o_orderstatus", "segment"], {"value": "price"}))


def unlabelled_count(spark: SparkSession, d: str) -> DataFrame:
    return jn.fk_orphans(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


def unlabelled_documents(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "lang", "source")
    return jn.relationships(documents, "doc_id", table(spark, d, "labels"), "doc_id")


def lines_with_price(spark: SparkSession, d: str) -> DataFrame:
    lines = agg.sum_by(
        table(spark, d, "lineitem"), ["l_partkey"],
        {"value": F.col("l_extendedprice").cast("decimal(18,2)")},
    )
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    named = jn.fact_dim(lines, part, "l_partkey")
    return plain(agg.sum_by(named, ["p_brand"], {"value": "value"}))


def counted_conditions(spark: SparkSession, d: str) -> DataFrame:
    raw = type_production(produccion_raw(spark, d))
    return raw.agg(
        agg.count_filter(F.col("prod_gas") < 0, "negative_gas"),
        agg.count_filter(F.col("prod_agua") < 0.05, "little_water"),
        agg.count_filter(F.col("prod_agua").isNull(), "no_water"),
    )


def failing(test: q.DataTest, source):
    def run(spark, d):
        return plain(q.failing_rows({test.table: source(spark, d)}, test))

    return run


def _typed(spark, d):
    return type_production(produccion_raw(spark, d))


def gold_results(spark: SparkSession, d: str) -> DataFrame:
    return quality.run_tests(_gold_tables(spark, d), quality.GOLD_SUITE)


def silver_results(spark: SparkSession, d: str) -> DataFrame:
    pozos, produccion = silver_of(spark, d)
    return quality.run_tests(
        {"stg_pozos": pozos, "stg_produccion": produccion}, quality.SILVER_SUITE
    )


def kept_failures(spark: SparkSession, d: str) -> DataFrame:
    """Rows stored for the gold tests that fail, read back per test."""
    root = scratch_path(spark, "failures")
    try:
        quality.quality_gate(_gold_tables(spark, d), quality.GOLD_SUITE, root)
    except quality.QualityGateError:
        pass
    counts = [spark.createDataFrame([], "test string, rows long")] + [
        rows.agg(F.lit(test).alias("test"), F.count(F.lit(1)).alias("rows"))
        for test, rows in stored_failures(spark, root).items()
    ]
    return agg.union_all(*counts)


def _gold_tables(spark, d):
    gold = gold_of(spark, d)
    return {name: getattr(gold, name) for name in GOLD_SCHEMAS}


def freshness(spark: SparkSession, d: str) -> DataFrame:
    """Age of both bronze sources on a day shortly after the last report."""
    return plain(
        quality.source_freshness(
            {"produccion_raw": produccion_raw(spark, d), "pozos_raw": pozos_raw(spark, d)},
            datetime(2002, 1, 20),
        )
    )


def publication(spark: SparkSession, d: str) -> DataFrame:
    return quality.publish_gate(
        quality.quality_marks(gold_of(spark, d)),
        quality.source_freshness({"produccion_raw": produccion_raw(spark, d)}, datetime(2002, 1, 20)),
    )


def gate_alert(spark: SparkSession, d: str) -> DataFrame:
    """The alert record of a run that the gold suite stops."""
    results = gold_results(spark, d)
    return quality.quality_alert(results, job_name="monthly", op_name="gold", run_id="run-1")


def land_month(spark: SparkSession, d: str, condition: str) -> tuple[Landed, Landed]:
    """Production reports that meet a condition, and all wells, as landed CSV files.

    Gold requires a volume of water, and its gate stops a run without one, so blank water
    cells are reported as zero here; everything else is landed as it is. The cells of a quoted
    file may span lines, and a packed file is parsed by one task in any case, so each is read as
    a whole: it is parsed once, and not searched for lines of blanks.
    """
    reports = produccion_raw(spark, d).filter(condition)
    reports = reports.withColumn(
        "prod_agua", F.when(F.trim("prod_agua") == "", "0").otherwise(F.col("prod_agua"))
    )
    return tuple(
        Landed(land_csv(df.select(*source_columns(df)), name), f"file:{name}", name)
        for name, df in (("produccion", reports), ("pozos", pozos_raw(spark, d)))
    )


def run_two_months(spark: SparkSession, d: str) -> str:
    """Load early reports, then later ones, which correct wells and months of the first."""
    root = scratch_path(spark, "months")
    first = land_month(spark, d, "dias_produccion in ('', '1', '2', '3')")
    second = land_month(spark, d, "dias_produccion in ('4', '5', '6')")
    backfill(
        spark, root, ["2026-01-01", "2026-02-01"],
        {"2026-01-01": first, "2026-02-01": second},
        {"2026-01-01": LOADED_AT, "2026-02-01": datetime(2026, 3, 1, 3)},
        now=datetime(2026, 3, 2),
    )
    return root


def caught_up(spark: SparkSession, d: str) -> DataFrame:
    """A warehouse with one month loaded, brought up to the newest closed one."""
    root = scratch_path(spark, "months")
    conditions = {
        "2026-01-01": "dias_produccion in ('', '1', '2', '3')",
        "2026-02-01": "dias_produccion in ('4', '5', '6')",
    }
    at = {"2026-01-01": LOADED_AT, "2026-02-01": datetime(2026, 3, 1, 3)}
    for today in (date(2026, 2, 1), date(2026, 3, 31)):
        star = catch_up(
            spark, root, today, lambda period: land_month(spark, d, conditions[period]),
            loaded_at=at, now=datetime(2026, 3, 2),
        )
    return plain(star.fct_produccion)


def estimated_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile of a bronze table from sketches kept per load, beside the exact counts.

    ``close`` tells whether the estimate is within the stated error of the exact count.
    """
    root = scratch_path(spark, "profile")
    raw = produccion_raw(spark, d)
    reports = raw.select(*source_columns(raw))
    for period, days in (("2026-01", ("", "1", "2", "3")), ("2026-02", ("4", "5", "6"))):
        loaded = with_load_metadata(
            reports.filter(F.col("dias_produccion").isin(*days)), period, "file:p", "p", LOADED_AT
        )
        replace_partition(loaded, bronze_path(root, "produccion_raw"), period)
        found = bronze_profile(spark, root, "produccion_raw")
    exact = agg.column_profile(reports, "produccion_raw", exact=True).select(
        "column_name", F.col("distinct_count").alias("exact")
    )
    off = F.abs(F.col("distinct_count") - F.col("exact"))
    return found.join(exact, "column_name").select(
        "table_name", "column_name", "rows", "null_count", "min_value", "max_value",
        (off <= agg.DISTINCT_ERROR * F.col("exact")).alias("close"),
    )


def two_months(spark: SparkSession, d: str) -> DataFrame:
    root = run_two_months(spark, d)
    return plain(
        read_layer(spark, root, "gold", "fct_produccion", GOLD_SCHEMAS["fct_produccion"])
    )


def one_month(spark: SparkSession, d: str) -> DataFrame:
    """One period run twice ends in the same fact as run once."""
    root = scratch_path(spark, "months")
    landed = land_month(spark, d, "true")
    for _ in range(2):
        star = run_period(
            spark, root, "2026-01-01", *landed, loaded_at=LOADED_AT, now=CHECKED_AT
        )
    return plain(star.fct_produccion)


def reload_check(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "months")
    landed = land_month(spark, d, "true")
    run_period(spark, root, "1997-05-01", *landed, loaded_at=LOADED_AT, now=CHECKED_AT)
    return verify_reload(spark, root, "1997-05-01")


def ingested(spark: SparkSession, d: str) -> DataFrame:
    """Two bronze loads picked up by a stream, one run of the stream after each."""
    root = scratch_path(spark, "ingest")
    raw = produccion_raw(spark, d)
    reports = raw.select(*source_columns(raw))
    for period, days, at in (
        ("2026-01-01", ("", "1", "2", "3"), LOADED_AT),
        ("2026-02-01", ("4", "5", "6"), datetime(2026, 3, 1, 3)),
    ):
        loaded = with_load_metadata(
            reports.filter(F.col("dias_produccion").isin(*days)),
            period, "file:produccion", "produccion", at,
        )
        replace_partition(loaded, bronze_path(root, "produccion_raw"), period)
        stream = incremental_ingest(spark, root, "produccion_raw", f"{root}/checkpoint")
        stream.trigger(availableNow=True).start().awaitTermination()
    return plain(read_layer(spark, root, "silver", "stg_produccion", STG_PRODUCCION_SCHEMA))


def forecast_split(spark: SparkSession, d: str) -> DataFrame:
    accepted, rejects = jn.reject_unknown(forecast_requests(spark, d), forecast_wells(spark, d))
    return plain(rejects.unionByName(accepted.withColumn("reason", F.lit("accepted"))))


QUERIES = {
    "read_csv_text": csv_documents,
    "with_load_metadata": loaded_suppliers,
    "row_hash_text": row_texts,
    "replace_partition": reloaded_orders,
    "scan_bronze": widened_bronze,
    "evolve_schema": unioned_places,
    "merge_upsert": upserted_production,
    "incremental_filter": increment,
    "incremental_filter_empty_target": first_increment,
    "required_keys": keyed_rows,
    "clean_columns": cleaned_columns,
    "summarize_text": lambda spark, d: table(spark, d, "documents").select(
        "doc_id", summarize_text(F.col("text")).alias("summary")
    ),
    "title_words": lambda spark, d: table(spark, d, "events").select(
        "event_id", title_words(F.concat(F.lit("api_"), "event_type")).alias("title")
    ),
    "non_negative": lambda spark, d: plain(
        flt.non_negative(_typed(spark, d), ["prod_gas", "prod_agua"])
    ),
    "latest_period": lambda spark, d: plain(flt.latest_period(gold_of(spark, d).fct_produccion)),
    "active_rows": lambda spark, d: plain(
        flt.active_rows(_typed(spark, d), ["prod_gas", "prod_agua"])
    ),
    "member_filter": lambda spark, d: plain(
        flt.member_filter(_typed(spark, d), "prod_agua")
    ),
    "period_filter": lambda spark, d: plain(
        flt.period_filter(gold_of(spark, d).fct_produccion, "1999-03-01", "1999-03-01")
    ),
    "latest_per_key": lambda spark, d: plain(
        latest_per_key(_typed(spark, d), ["id_pozo"], "_loaded_at", ["_row_hash"])
    ),
    "star_lookup": star,
    "rank_total": ranked_customers,
    "top_n_others": bucketed_orders,
    "top_k_sum": lambda spark, d: plain(
        order.top_k_sum(
            table(spark, d, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)")),
            "o_custkey", "price", "spent", 15,
        )
    ),
    "latest_first": lambda spark, d: plain(
        order.latest_first(table(spark, d, "orders"), "o_orderdate", 20, ["o_orderkey"])
    ),
    "fk_orphans": unlabelled_count,
    "relationships": unlabelled_documents,
    "fact_dim": lines_with_price,
    "sum_by": lambda spark, d: plain(
        agg.sum_by(_typed(spark, d), ["periodo", "cuenca"], {"gas": "prod_gas", "water": "prod_agua"})
    ),
    "count_distinct": lambda spark, d: agg.count_distinct(
        table(spark, d, "lineitem"), "l_orderkey", "orders"
    ),
    "count_filter": counted_conditions,
    "duplicate_excess": lambda spark, d: agg.duplicate_excess(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    ),
    "select_distinct": lambda spark, d: agg.select_distinct(
        table(spark, d, "part"), ["p_brand", "p_type"]
    ),
    "distinct_count_gt": lambda spark, d: agg.distinct_count_gt(table(spark, d, "part"), "p_brand", 24),
    "partition_counts": lambda spark, d: agg.partition_counts(
        {"produccion_raw": produccion_raw(spark, d), "pozos_raw": pozos_raw(spark, d)}, "1997-06-01"
    ),
    "month_counts": lambda spark, d: plain(agg.month_counts(gold_of(spark, d).fct_produccion)),
    "bronze_profile": estimated_profile,
    "column_profile": lambda spark, d: agg.column_profile(
        _typed(spark, d), "produccion", exact=True
    ),
    "union_distinct": lambda spark, d: agg.union_distinct(
        table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")),
        table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")),
        "nation",
    ),
    "union_all": lambda spark, d: agg.union_all(
        table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")),
        table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")),
    ),
    "test_not_null": failing(q.not_null("raw", "prod_agua")[0], _typed),
    "test_unique": failing(q.unique("raw", "id_pozo")[0], _typed),
    "test_unique_combination": failing(q.unique_combination("raw", "id_pozo", "periodo")[0], _typed),
    "test_accepted_values": failing(
        q.accepted_values("raw", "tipo_recurso", ["ECONOMY", "SMALL"])[0], _typed
    ),
    "test_between": failing(q.between("raw", "prod_gas", 0, 45)[0], _typed),
    "test_results_silver": silver_results,
    "test_results_gold": gold_results,
    "stored_failures": kept_failures,
    "quality_marks": lambda spark, d: quality.quality_marks(gold_of(spark, d)).drop("checked_at"),
    "quality_table": lambda spark, d: quality.quality_table(gold_of(spark, d)).drop("checked_at"),
    "source_freshness": freshness,
    "publish_gate": publication,
    "quality_alert": gate_alert,
    "decline_forecast": lambda spark, d: plain(
        fc.decline_forecast(forecast_wells(spark, d), forecast_requests(spark, d))
    ),
    "forecast_rejects": lambda spark, d: plain(
        fc.forecast_rejects(forecast_requests(spark, d), forecast_wells(spark, d))
    ),
    "reject_unknown": forecast_split,
    "wells_for_date": lambda spark, d: fc.wells_for_date(gold_of(spark, d).dim_pozo, "1995-01-05"),
    "run_period": one_month,
    "backfill": two_months,
    "catch_up": caught_up,
    "verify_reload": reload_check,
    "incremental_ingest": ingested,
}
