"""Line dedup with two Bloom filters.

Lines are compared by their key: white space stripped at both ends, A-Z lower-cased. Hashes of
the keys of each document go through two Bloom filters; only keys that are suspected to occur
in two documents are shuffled, grouped by their whole content, and confirmed. The smallest
document id that holds a confirmed key keeps its lines with it, all others lose theirs.

Cases: null and empty text is one empty line; keys of fewer than ``least`` code points stay.
Documents are told apart by id: rows that repeat an id are one document, each of them is
treated alike. A null id is larger than all others. Other columns are carried along; a text
that was null comes back empty. An empty table gives an empty result. A task holds the lines of a
few megabytes of text and at least of one text, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.batches import bound_batches, parts
from strata.llm.suspects import repeated_filter, suspected, total
from strata.session import staged

LEAST_POINTS = 10


def line_keys(text: bytes, least: int) -> list[bytes]:
    """The key of each line, empty where it is too short to be compared.

    Methods of bytes strip and fold exactly the ASCII characters that the key is defined by.
    """
    keys = [line.strip().lower() for line in text.split(b"\n")]
    return [k if len(k) >= 4 * least or len(k.decode(errors="replace")) >= least else b""
            for k in keys]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = LEAST_POINTS,
    lines_column: str = "n_lines",
    dropped_column: str = "n_dropped",
) -> DataFrame:
    """The columns of ``docs`` with the shortened text, then n_lines (before) and n_dropped.

    Of the two counts' names, columns that ``docs`` already has are replaced. Documents
    without a suspected key are passed on as they are; only the others meet their lost keys
    in a shuffle.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    names = [n for n in docs.columns if n not in (lines_column, dropped_column)]
    rows = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))])
    doc, text = f"c{names.index(id_column)}", f"c{names.index(text_column)}"
    columns = rows.columns
    line_count = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"))) + 1
    n_keys = total(rows, F.coalesce(line_count, F.lit(1)))

    def all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in parts(batches, text):
            for one in _texts(batch, text):
                keys = {k for k in line_keys(one, least) if k}
                if keys:
                    yield _hashes(list(keys))

    # Repeated rows of a document would make its keys suspects, which costs time only.
    twice = repeated_filter(rows.select(text), all_keys, n_keys)

    def suspects(batch: pa.RecordBatch) -> list[list[bytes]]:
        keys = [sorted({k for k in line_keys(t, least) if k}) for t in _texts(batch, text)]
        flat = [k for own in keys for k in own]
        flags = suspected(_hashes(flat), twice.value).tolist() if flat else []
        found, at = [], 0
        for own in keys:
            found.append([k for k, f in zip(own, flags[at : at + len(own)], strict=True) if f])
            at += len(own)
        return found

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, text):
            found = suspects(batch)
            owner = np.repeat(np.arange(len(found)), [len(own) for own in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for own in found for k in own], pa.binary()),
                 batch.column(doc).take(pa.array(owner, pa.int64()))],
                names=["key", "owner"],
            )

    id_type = rows.schema[doc].dataType.simpleString()
    sent = rows.select(doc, text).mapInArrow(send, f"key binary, owner {id_type}")
    holders = staged(spark, sent, "suspected-lines")
    # A null owner is larger than any other.
    seen = holders.groupBy("key").agg(
        F.min("owner").alias("first"), F.max("owner").alias("last"),
        F.max(F.col("owner").isNull()).alias("nulls"),
    )
    two = (F.col("first") < F.col("last")) | (F.col("nulls") & F.col("first").isNotNull())
    # Staged, so that a key held by very many documents can be split in the join.
    repeated = staged(spark, seen.filter(two).select("key", "first"), "repeated-lines")
    lost = holders.join(repeated, "key").filter(
        F.col("owner").isNull() | (F.col("owner") > F.col("first"))
    )
    by_document = lost.groupBy("owner").agg(F.collect_set("key").alias("lost"))

    def part(suspect: bool):
        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in parts(batches, text):
                yield batch.filter(pa.array([bool(f) == suspect for f in suspects(batch)], pa.bool_()))

        return rows.mapInArrow(choose, rows.schema)

    counts = "n_lines long, n_dropped long"
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, text):
            texts, lines, dropped = [], [], []
            for one, gone in zip(_texts(batch, text), batch.column("lost").to_pylist(), strict=True):
                kept, n = drop_lines(one, set(gone or ()), least)
                texts.append(kept.decode())
                lines.append(one.count(b"\n") + 1)
                dropped.append(n)
            result = {name: batch.column(name) for name in columns} | {
                text: pa.array(texts, pa.string()), "n_lines": pa.array(lines, pa.int64()),
                "n_dropped": pa.array(dropped, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(result)

    shortened = (
        part(True)
        .join(by_document, F.col(doc).eqNullSafe(F.col("owner")), "left")
        .drop("owner")
        .mapInArrow(drop, f"{fields}, {counts}")
    )
    untouched = part(False).select(
        "*", F.coalesce(line_count, F.lit(1)).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
    ).withColumn(text, F.coalesce(F.col(text), F.lit("")))
    return shortened.union(untouched).toDF(*names, lines_column, dropped_column)


def drop_lines(text: bytes, lost: set[bytes], least: int) -> tuple[bytes, int]:
    lines = text.split(b"\n")
    kept = [line for line, key in zip(lines, line_keys(text, least), strict=True) if key not in lost]
    return b"\n".join(kept), len(lines) - len(kept)
