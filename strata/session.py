"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
# Fixed value: models that are built at the same time.
JOB_THREADS = 4
TIME_ZONE_KEY = "spark.sql.session.timeZone"
CHECKPOINT_KEY = "spark.checkpoint.dir"
# Records the Python call site of every Column call, which makes building a plan slow.
COLUMN_ORIGIN_KEY = "spark.python.sql.dataFrameDebugging.enabled"
SHUFFLE_KEY, SPLIT_KEY = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
# Bytes of compressed columns that a task of a sized shuffle or scan is meant to get.
TASK_BYTES, SPLIT_BYTES = 4 << 20, 16 << 20
# Paths staged by the thread inside ``staging_released``.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def local_session(
    app: str = "strata", cores: str = "*", conf: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config(TIME_ZONE_KEY, "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config(COLUMN_ORIGIN_KEY, "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """The one setting the queries rely on: timestamps in UTC."""
    if spark.conf.get(TIME_ZONE_KEY) != "UTC":
        spark.conf.set(TIME_ZONE_KEY, "UTC")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the session's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/strata-{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; False where it exists already."""
    fs = spark._jvm.org.apache.hadoop.fs
    folder, name = path.rsplit("/", 1)
    draft, final = fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}"), fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    stream = draft.getFileSystem(conf).create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    # Without the option to overwrite, the rename fails where the name is taken.
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    context = fs.FileContext.getFileContext(final.toUri(), conf)
    try:
        context.rename(draft, final, options)
    except Py4JJavaError:
        delete_path(spark, draft.toString())
        if not path_exists(spark, path):
            raise
        return False
    return True


def path_names(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted names of what a glob matches."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in filesystem.globStatus(hadoop_path) or [])


def child_directories(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Sorted names of the directories below ``path`` that match a glob."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = filesystem.globStatus(hadoop_path) or []
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def path_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of files, or of all files below folders."""
    total = 0
    for path in paths:
        # Spark's own file names are escaped as in a URI.
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(
            spark._jvm.java.net.URI(path) if "://" in path or path.startswith("file:") else path
        )
        filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        total += filesystem.getContentSummary(hadoop_path).getLength()
    return total


def tasks_for(size: int, each: int = TASK_BYTES) -> int:
    """Tasks that get ``each`` bytes of an input of ``size`` bytes."""
    return max(1, -(-size // each))


@contextmanager
def sized(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Inside, shuffles have at least ``tasks`` partitions and scans splits of ``SPLIT_BYTES``.

    So what a task holds does not grow with the input. AQE joins partitions that are small.
    """
    held = {key: spark.conf.get(key, None) for key in (SHUFFLE_KEY, SPLIT_KEY)}
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    split = min(as_bytes(spark.conf.get(SPLIT_KEY)), SPLIT_BYTES)
    spark.conf.set(SHUFFLE_KEY, str(max(tasks, int(spark.conf.get(SHUFFLE_KEY)))))
    spark.conf.set(SPLIT_KEY, str(split))
    try:
        yield
    finally:
        for key, value in held.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back, which cuts the lineage."""
    path = scratch_path(spark, label)
    mine = _STAGED.get()
    if mine is not None:
        mine.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_released(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread stages inside, at the end: for streams, which never end."""
    token = _STAGED.set([])
    try:
        yield
    finally:
        for path in _STAGED.get() or []:
            delete_path(spark, path)
        _STAGED.reset(token)


def in_parallel(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs from a few driver threads; the first error is raised."""
    with ThreadPoolExecutor(max_workers=JOB_THREADS) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]
