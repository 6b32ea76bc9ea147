"""Two Bloom filters, for keys seen once and keys seen twice.

Tasks set bits for their keys in two filters: one for keys seen, one for keys seen again. The
filters are cut into segments; a task sends the positions it has set in a segment, and the
segments are united independently: a position that two tasks have set, or one has set twice,
is set in the second filter. A key all of whose positions are set there is a suspect. Every
key that occurs twice is a suspect; a few others are too, so suspects are to be confirmed.

The number of bits follows the number of keys up to ``MOST_BITS``. Only the second filter
comes to the driver and is broadcast, so that both are bounded by ``MOST_BITS`` / 8 bytes. With
more keys than that is good for, single keys hit set positions and are suspects as well. Then
``repeated_filter`` shuffles the suspects' 8-byte hashes, not what they stand for, counts them,
and builds the filter again from those that do repeat, so its size serves the number of repeated
keys. Beyond that number more keys are suspects again; none is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import staged

# Bits per expected key, positions per key, bits of a segment, and of a filter at most.
BITS_PER_KEY, POSITIONS = 8, 4
SEGMENT_BITS = 22
MOST_BITS = 1 << 30
LEAST_BITS = 1 << SEGMENT_BITS
# Positions a task gathers before it sends them on.
GATHERED = 1 << 21

Keys = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]


def filter_bits(keys: int) -> int:
    wanted = max(LEAST_BITS, min(MOST_BITS, BITS_PER_KEY * keys))
    return 1 << (wanted - 1).bit_length()


def positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """``POSITIONS`` bit numbers per 64-bit key, one row per key."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(POSITIONS, dtype=np.uint64)
    mixed = keys[:, None] + turns * (step[:, None] * np.uint64(0x9E3779B97F4A7C15))
    return (mixed ^ (mixed >> np.uint64(29))) & np.uint64(bits - 1)


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers below 2^22, as gaps of their low bytes and high bytes, compressed."""
    gaps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def bloom_filter(df: DataFrame, keys: Keys, bits: int, times: int = 2) -> Broadcast:
    """The second filter over the keys that ``keys`` yields from the batches of ``df``.

    With ``times`` 1 it is the first filter, of all keys. A key that ``keys`` yields twice,
    in one array or in two, counts as seen twice.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for found in keys(batches):
            held.append(positions(found, bits).ravel())
            size += held[-1].size
            if size >= GATHERED:
                yield _segments(held)
                held, size = [], 0
        if size:
            yield _segments(held)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by segment; one segment is held at a time."""
        now, once, twice = None, None, None
        for batch in batches:
            columns = [batch.column(c) for c in ("segment", "seen", "again")]
            for segment, seen, again in zip(*columns, strict=True):
                if segment.as_py() != now:
                    if now is not None:
                        yield _bits(now, twice if times == 2 else once)
                    now = segment.as_py()
                    once, twice = (np.zeros(1 << SEGMENT_BITS, bool) for _ in range(2))
                at = _unpack(seen.as_py())
                twice[at[once[at]]] = True
                once[at] = True
                twice[_unpack(again.as_py())] = True
        if now is not None:
            yield _bits(now, twice if times == 2 else once)

    sent = df.mapInArrow(send, "segment int, seen binary, again binary")
    united = sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        unite, "segment int, bits binary"
    )
    whole = np.zeros(bits // 8, np.uint8)
    size = (1 << SEGMENT_BITS) // 8
    # At most MOST_BITS / 8 bytes in all, one segment at a time.
    for row in united.toLocalIterator():
        whole[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(
            row["bits"], np.uint8
        )
    return df.sparkSession.sparkContext.broadcast(whole)


def repeated_filter(df: DataFrame, keys: Keys, count: int) -> Broadcast:
    """A filter of all keys that ``keys`` yields twice; ``count``: how many keys it yields."""
    twice = bloom_filter(df, keys, filter_bits(count))
    if BITS_PER_KEY * count <= MOST_BITS:
        return twice

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in keys(batches):
            held = found[suspected(found, twice.value)].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(held)], ["hash"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            yield batch.column("hash").to_numpy().view(np.uint64)

    # Hashes are counted before the shuffle, too.
    hashes = df.mapInArrow(suspects, "hash long").groupBy("hash").count()
    again = staged(df.sparkSession, hashes.filter("count > 1").select("hash"), "repeated-hashes")
    return bloom_filter(again, read, filter_bits(again.count()), times=1)


def _bits(segment: int, held: np.ndarray) -> pa.RecordBatch:
    packed = pa.array([np.packbits(held).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), packed], ["segment", "bits"])


def _segments(held: list[np.ndarray]) -> pa.RecordBatch:
    at = np.sort(np.concatenate(held))
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    again = np.unique(at[~new])
    at = at[new]
    segments = np.arange(int(at[0]) >> SEGMENT_BITS, (int(at[-1]) >> SEGMENT_BITS) + 2)
    edges = segments.astype(np.uint64) << np.uint64(SEGMENT_BITS)
    low = np.uint64((1 << SEGMENT_BITS) - 1)
    rows = []
    for segment, a, b, c, d in zip(
        segments[:-1], *[x for v in (at, again) for x in _bounds(v, edges)], strict=True
    ):
        if b > a:
            rows.append((int(segment), _pack((at[a:b] & low).astype(np.uint32)),
                         _pack((again[c:d] & low).astype(np.uint32))))
    numbers, seen, twice = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(seen, pa.binary()), pa.array(twice, pa.binary())],
        names=["segment", "seen", "again"],
    )


def _bounds(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(values, edges)
    return at[:-1], at[1:]


def suspected(keys: np.ndarray, filter_bytes: np.ndarray) -> np.ndarray:
    """Whether each key is in the filter."""
    at = positions(keys, len(filter_bytes) * 8)
    held = np.ones(len(keys), bool)
    for i in range(POSITIONS):
        place = at[:, i]
        bit = np.uint8(128) >> (place & np.uint64(7)).astype(np.uint8)
        held &= (filter_bytes[place >> np.uint64(3)] & bit) != 0
    return held


def total(df: DataFrame, expression) -> int:
    """A sum over all rows; 0 for none."""
    return int(df.agg(F.coalesce(F.sum(expression), F.lit(0)).alias("n")).first()["n"])
