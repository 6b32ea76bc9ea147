"""Request records of the API, read in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REQUEST_LOG_SCHEMA = (
    "ts timestamp, method string, path string, status_code int, duration_s double"
)
# Paths that are never recorded, and the prefix that collapses.
UNRECORDED_PATHS = ("/metrics", "/healthz")
DOCS_PREFIX = "/docs"


def read_request_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return normalize_log(reader.schema(REQUEST_LOG_SCHEMA).parquet(path))


def normalize_log(log: DataFrame) -> DataFrame:
    """Drop unrecorded paths and collapse the documentation paths."""
    return uninstrumented(log).withColumn("path", normalize_path(F.col("path")))


def uninstrumented(log: DataFrame) -> DataFrame:
    return log.filter(~F.col("path").isin(*UNRECORDED_PATHS))


def normalize_path(path: Column) -> Column:
    return F.when(path.startswith(DOCS_PREFIX), F.lit(DOCS_PREFIX)).otherwise(path)
