"""Parts of Arrow batches, so that what a task holds does not follow the size of a batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Spark's default of 10 000 rows is too much for whole documents: a batch is held by the JVM
# and by the Python worker, on the way in and on the way out.
ROWS_KEY, SPARK_ROWS, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches have fewer rows, unless the session has a setting of its own."""
    if spark.conf.get(ROWS_KEY, SPARK_ROWS) == SPARK_ROWS:
        spark.conf.set(ROWS_KEY, ROWS)


def parts(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of a text or binary column each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        number = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(low, high - low)
