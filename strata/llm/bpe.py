"""Byte-level BPE encoding and decoding by a rank file.

A text is split by the tokenizer's pattern and each match is encoded alone: a match that is a
vocabulary entry is that entry; any other starts as single bytes and merges, again and again,
its leftmost pair of least rank. Distinct matches are merged many at a time: matches of
similar length form a padded matrix, every row merges its leftmost minimum-rank pair per
round, pairs are looked up in an open-addressing hash table, merged columns are closed up and
finished rows leave the matrix. Matches longer than the widest matrix follow the same rule
with a heap, one at a time.

Each task keeps the encodings of the segments it has met, up to a fixed number, then starts
anew; that saves time and changes no result. Texts are handled in windows that end where the
pattern certainly splits, so a long text needs no more memory than a window.

Cases: null or empty text has no tokens; ids are little-endian unsigned 32-bit numbers packed
into one binary value; decoding null ids gives empty bytes. Repeated rows are encoded each.
Columns named like the results are replaced; other columns are carried along.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.batches import bound_batches, parts

# White space as Unicode defines it, for ``\s`` of the split pattern.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Widths of the matrices in bytes; longer matches go to the heap.
WIDTHS = (4, 8, 16, 32, 64, 128)
# Characters of a window and of the texts handled at once; segments remembered by a task.
WINDOW, AT_ONCE, REMEMBERED = 1 << 20, 1 << 20, 200_000
NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Vocabulary:
    """Tables of one tokenizer; its size is that of the rank file, whatever the input."""

    entries: list[bytes]
    byte_ids: np.ndarray
    pair_keys: np.ndarray
    pair_ids: np.ndarray
    shift: int
    probes: int
    pattern: str


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file: a line per entry with its bytes in base 64 and its rank."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            entry, _, rank = line.strip().partition(b" ")
            if entry:
                ranks[base64.b64decode(entry)] = int(rank)
    entries = [b""] * (max(ranks.values()) + 1)
    for entry, rank in ranks.items():
        entries[rank] = entry
    pairs = {}
    for entry, rank in ranks.items():
        for at in range(1, len(entry)):
            left, right = ranks.get(entry[:at]), ranks.get(entry[at:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    bits = max(4, (4 * len(pairs)).bit_length())
    keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
    ids = np.full(1 << bits, NONE, np.int32)
    probes, mask, mix = 1, (1 << bits) - 1, int(_MIX)
    for key, rank in pairs.items():
        slot, tried = ((key * mix) & (2**64 - 1)) >> (64 - bits), 1
        while ids[slot] != NONE:
            slot, tried = (slot + 1) & mask, tried + 1
        keys[slot], ids[slot], probes = key, rank, max(probes, tried)
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    pattern = _with_white_space(pattern)
    return Vocabulary(entries, byte_ids, keys, ids, 64 - bits, probes, pattern)


def _with_white_space(pattern: str) -> str:
    """The pattern with ``\\s`` and ``\\S`` spelled out, in classes and outside of them."""
    inside = regex.sub(r"\[\^([^\]]*)\\s([^\]]*)\]", lambda m: f"[^{m[1]}{WHITE}{m[2]}]", pattern)
    return inside.replace("\\s", f"[{WHITE}]").replace("\\S", f"[^{WHITE}]")


def find_pairs(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair, NONE where it is no entry or an id is negative."""
    found = np.full(left.shape, NONE, np.int32)
    keys = (left.astype(np.int64) << 32 | right).ravel().view(np.uint64)
    rest = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
    keys, flat = keys[rest], found.ravel()
    slots = (keys * _MIX) >> np.uint64(vocabulary.shift)
    mask = np.uint64(len(vocabulary.pair_keys) - 1)
    for _ in range(vocabulary.probes):
        held = vocabulary.pair_keys[slots]
        hit = held == keys
        flat[rest[hit]] = vocabulary.pair_ids[slots[hit]]
        open_ = ~hit & (vocabulary.pair_ids[slots] != NONE)
        if not open_.any():
            break
        rest, keys, slots = rest[open_], keys[open_], (slots[open_] + np.uint64(1)) & mask
    return found


class Ragged:
    """Rows of numbers of any length in one array."""

    def __init__(self) -> None:
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.values = np.zeros(0, np.int32)

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        ends = np.cumsum(lengths) + len(self.values)
        self.starts = np.concatenate([self.starts, ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.values = np.concatenate([self.values, values])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the rows, one after the other, and their lengths."""
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[rows] - (ends - lengths), lengths)
        return self.values[shift + np.arange(len(shift))], lengths


def _merge_matrix(
    vocabulary: Vocabulary, pieces: list[bytes], width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, padded with -1, and their numbers."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ids = np.full((len(pieces), width), -1, np.int32)
    ids[np.arange(width) < lengths[:, None]] = vocabulary.byte_ids[
        np.frombuffer(b"".join(pieces), np.uint8)
    ]
    ranks = find_pairs(vocabulary, ids[:, :-1], ids[:, 1:])
    rows = np.arange(len(pieces))
    result, result_lengths = np.full_like(ids, -1), np.zeros(len(pieces), np.int64)
    while len(rows):
        each = np.arange(len(rows))
        at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)
        best = ranks[each, at] if width > 1 else np.full(len(rows), NONE)
        done, go = best == NONE, best != NONE
        result[rows[done], :width] = ids[done]
        result_lengths[rows[done]] = lengths[done]
        rows, lengths, at, best = rows[go], lengths[go] - 1, at[go], best[go]
        if not len(rows):
            break
        # Close up the column that the merge frees; every row loses one.
        width -= 1
        columns = np.arange(width)
        ids = np.take_along_axis(ids[go], columns + (columns > at[:, None]), axis=1)
        each = np.arange(len(rows))
        ids[each, at] = best
        columns = np.arange(width - 1)
        ranks = np.take_along_axis(ranks[go], columns + (columns >= at[:, None]), axis=1)
        right = at < width - 1
        ranks[each[right], at[right]] = find_pairs(
            vocabulary, ids[each[right], at[right]], ids[each[right], at[right] + 1]
        )
        left = at > 0
        ranks[each[left], at[left] - 1] = find_pairs(
            vocabulary, ids[each[left], at[left] - 1], ids[each[left], at[left]]
        )
    return result, result_lengths


def _merge_long(vocabulary: Vocabulary, piece: bytes) -> np.ndarray:
    """The same merges for one long match: a heap of pairs over a linked list."""
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)]
    first = find_pairs(vocabulary, ids[:-1], ids[1:])
    heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != NONE)]
    heapq.heapify(heap)
    ids, ranks = ids.tolist(), [*first.tolist(), int(NONE)]
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    pair: dict[tuple[int, int], int] = {}

    def rank(i: int) -> int:
        if after[i] >= len(ids):
            return int(NONE)
        key = ids[i], ids[after[i]]
        if key not in pair:
            pair[key] = int(find_pairs(vocabulary, np.array([key[0]]), np.array([key[1]]))[0])
        return pair[key]

    while heap:
        value, i = heapq.heappop(heap)
        if ids[i] < 0 or ranks[i] != value:
            continue
        gone = after[i]
        ids[i], ids[gone], after[i] = value, -1, after[gone]
        if after[i] < len(ids):
            before[after[i]] = i
        for j in (before[i], i):
            if j >= 0:
                ranks[j] = rank(j)
                if ranks[j] != NONE:
                    heapq.heappush(heap, (ranks[j], j))
    return np.array([i for i in ids if i >= 0], np.int32)


def merge_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> Ragged:
    """Ids of each match, none of them empty; rows in the order of the matches."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    store, order, low = Ragged(), [], 1
    for width in WIDTHS:
        chosen = np.flatnonzero((lengths >= low) & (lengths <= width))
        if len(chosen):
            ids, counts = _merge_matrix(vocabulary, [pieces[i] for i in chosen], width)
            store.add(ids[ids >= 0], counts)
            order.append(chosen)
        low = width + 1
    for i in np.flatnonzero(lengths >= low):
        ids = _merge_long(vocabulary, pieces[i])
        store.add(ids, np.array([len(ids)]))
        order.append(np.array([i]))
    if order:
        back = np.argsort(np.concatenate(order))
        store.starts, store.lengths = store.starts[back], store.lengths[back]
    return store


class Encoder:
    """Encodes texts in a task, remembering segments.

    A segment runs from a space or line break that stands alone between other characters to
    the next such one; the pattern always splits there. A line break is kept in front of the
    segment it starts, a space is implied.
    """

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = vocabulary
        self._split = regex.compile(vocabulary.pattern)
        # White space in a segment beyond the line break it may start with, or no character.
        self._odd = regex.compile(rf"\n?+(?:\Z|[^{WHITE}\x1c-\x1f]*[{WHITE}\x1c-\x1f])")
        self._entry_ids = {entry: i for i, entry in enumerate(vocabulary.entries) if entry}
        self._forget()

    def _forget(self) -> None:
        self._pieces: dict[str, int] = {}
        self._numbers: dict[str, int] = {}
        self._piece_ids, self._ids = Ragged(), Ragged()
        # Number 0 stands for segments that tell that their window must be split as a whole.
        self._ids.add(np.zeros(0, np.int32), np.zeros(1, np.int64))

    def _learn_pieces(self, new: list[str]) -> None:
        raw = [piece.encode() for piece in new]
        whole = np.array([self._entry_ids.get(piece, -1) for piece in raw], np.int32)
        rest = np.flatnonzero(whole < 0)
        merged = merge_pieces(self._vocabulary, [raw[i] for i in rest])
        values, lengths = merged.take(np.arange(len(rest)))
        first = len(self._pieces)
        ordered = [*np.flatnonzero(whole >= 0).tolist(), *rest.tolist()]
        self._pieces.update((new[i], first + n) for n, i in enumerate(ordered))
        entries = whole[whole >= 0]
        self._piece_ids.add(entries, np.ones(len(entries), np.int64))
        self._piece_ids.add(values, lengths)

    def _piece_numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the matches in all texts, and how many each text has."""
        found = [self._split.findall(text) for text in texts]
        self._learn_pieces(list(set().union(*found) - self._pieces.keys()))
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = itertools.chain.from_iterable(found)
        return np.fromiter(map(self._pieces.__getitem__, flat), np.int64, int(counts.sum())), counts

    def _learn(self, new: list[str]) -> None:
        """Encode new segments, all their new matches together."""
        # Any white space but a plain space, which no segment holds, is not printable.
        odd = [s for s in new if not (s and s.isprintable()) and s[:1] != "\x00" and self._odd.match(s)]
        self._numbers.update(dict.fromkeys(odd, 0))
        new = [s for s in new if s not in self._numbers]
        numbers, counts = self._piece_numbers([
            s[1:] if s[:1] == "\x00" else s if s[:1] == "\n" else " " + s for s in new
        ])
        values, lengths = self._piece_ids.take(numbers)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
        first = len(self._ids.starts)
        self._numbers.update((s, first + i) for i, s in enumerate(new))
        self._ids.add(values, np.diff(bounds))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._numbers) > REMEMBERED or len(self._pieces) > REMEMBERED:
            self._forget()
        result: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0
        for i, text in enumerate(texts):
            for window in _windows(text):
                held.append((i, window))
                size += len(window)
                if size >= AT_ONCE:
                    self._encode_windows(held, result)
                    held, size = [], 0
        self._encode_windows(held, result)
        return [np.concatenate(own) if own else np.empty(0, np.int32) for own in result]

    def _encode_windows(self, held: list[tuple[int, str]], result: list[list[np.ndarray]]) -> None:
        flat: list[str] = []
        edges = [0]
        for _, text in held:
            segments = text.replace("\n", " \n").split(" ")
            # The first segment of a window has a mark of its own: no space is implied.
            segments[0] = "\x00" + segments[0]
            flat += segments
            edges.append(len(flat))
        known = map(self._numbers.get, flat, itertools.repeat(-1))
        numbers = np.fromiter(known, np.int64, len(flat))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            lacking = [flat[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(lacking)))
            numbers[missing] = np.fromiter(map(self._numbers.__getitem__, lacking), np.int64, len(lacking))
        values, lengths = self._ids.take(numbers)
        ends = np.concatenate([[0], np.cumsum(lengths)])[edges]
        whole = np.add.reduceat(numbers == 0, edges[:-1]) > 0 if held else ()
        for n, (i, text) in enumerate(held):
            # A mark at the start may be followed by white space, which then is odd as well.
            if whole[n] or self._odd.match(flat[edges[n]], 1):
                own, _ = self._piece_numbers([text])
                result[i].append(self._piece_ids.take(own)[0])
            else:
                result[i].append(values[ends[n] : ends[n + 1]])


def _windows(text: str) -> Iterator[str]:
    """Parts of about a window's length that end before a lone space or line break."""
    at = 0
    lone = regex.compile(rf"(?<=[^{WHITE}\x1c-\x1f])[ \n](?=[^{WHITE}\x1c-\x1f])")
    while len(text) - at > WINDOW:
        cut = lone.search(text, at + WINDOW)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


def _schema(df: DataFrame, drop: str, added: list[tuple[str, T.DataType]]) -> T.StructType:
    names = {name for name, _ in added} | {drop}
    kept = [f for f in df.schema.fields if f.name not in names]
    return T.StructType([*kept, *[T.StructField(n, t) for n, t in added]])


def _sent(df: DataFrame, vocabulary: Vocabulary) -> Broadcast:
    """The tables without their class, which workers may not be able to import."""
    values = tuple(getattr(vocabulary, field.name) for field in fields(vocabulary))
    return df.sparkSession.sparkContext.broadcast(values)


def encode(df: DataFrame, vocabulary: Vocabulary, text_column: str = "text") -> DataFrame:
    """The other columns of ``df``, then n_tokens and ids in the place of the text."""
    bound_batches(df.sparkSession)
    schema = _schema(df, text_column, [("n_tokens", T.LongType()), ("ids", T.BinaryType())])
    carried = schema.names[:-2]
    tables = _sent(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*tables.value))
        for batch in parts(batches, text_column):
            texts = [t or "" for t in batch.column(text_column).to_pylist()]
            ids = encoder.encode(texts)
            counts = pa.array([len(i) for i in ids], pa.int64())
            packed = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], counts, packed], names=schema.names
            )
        # The worker lives on; what Arrow has freed would stay with it.
        pa.default_memory_pool().release_unused()

    return df.select(*carried, text_column).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids") -> DataFrame:
    """The columns of ``df`` and ``decoded``, the bytes that the ids stand for."""
    bound_batches(df.sparkSession)
    schema = _schema(df, "decoded", [("decoded", T.BinaryType())])
    tables = _sent(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = Vocabulary(*tables.value).entries
        for batch in parts(batches, ids_column):
            texts = [
                b"".join(map(entries.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                for ids in batch.column(ids_column).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in schema.names[:-1]], pa.array(texts, pa.binary())],
                names=schema.names,
            )
        pa.default_memory_pool().release_unused()

    return df.select(*schema.names[:-1]).mapInArrow(run, schema)
