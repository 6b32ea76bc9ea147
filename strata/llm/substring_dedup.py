"""Substring dedup with prefix-partitioned suffix trees over words.

A window is a run of ``window`` words of one document. A window that starts earlier somewhere
else, in a smaller document id or earlier in the same document, is a repeat, and its words are
removed. Windows are judged on the input.

Every window is filed under an anchor, the least hash among the ``prefix``-word runs in it;
equal windows have equal anchors, and neighbouring windows mostly share one. Suffixes are
grouped by the words at their anchor. Two Bloom filters over the anchors leave the suffixes
that may repeat at all. Among some megabytes of text the first of equal windows is chosen at once, so a
passage that very many documents share leaves a task a few times. The rest is shuffled by prefix; a
prefix with too many suffixes for one group is lengthened, step by step, up to the whole
window. Each group's suffixes are sorted over all of their words, neighbours' common prefixes
give the nodes of its suffix tree, and an internal node at the depth of a window or below is a
repeat as long as it is deep; a suffix that is not the first of a node repeats that much. Such
spans, united where they overlap, make up the maximal repeats. Hashes choose what is compared;
what is removed was compared by its words.

Cases: null text has no words. Documents are told apart by id; a null id is larger than all
others, and of rows that repeat an id and hold the same window at the same place, which comes
first is not defined by the places, so those windows do not repeat one another. A document
shorter than a window is never changed but for its white space. Only id and text are read. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.batches import bound_batches, parts
from strata.llm.suspects import repeated_filter, suspected, total
from strata.llm.words import WordReader, Words, mix, windows
from strata.session import staged

WINDOW, PREFIX = 20, 8
# Suffixes of a group at most; beyond it the prefix is lengthened by STEP words at a time.
GROUP, STEP = 50_000, 4
# Bytes of text per anchor, for the size of the filters: an anchor stands for about seven
# words. A wrong guess makes more suspects, no other result.
BYTES_PER_ANCHOR = 40
# Stands for a null id in the order of documents.
NO_ID = 2**63 - 1
# Positions of a slice are packed beside 36 bits of a hash.
_PLACE = np.uint64((1 << 28) - 1)
# Windows of the suffix groups that are sorted together.
SORTED_AT_ONCE = 200_000
# Bytes of text whose windows are compared before they are shuffled.
COMPARED = 8 << 20
ROW = "key long, owner long, digest long, first int, anchor int, n int, words binary"
MARKS = "owner long, digest long, runs array<int>"


def anchors(words: Words, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the anchor of each, and the hashes of all ``prefix``-word runs.

    A slice shorter than a window has none.
    """
    runs, _ = windows(words.hashes, words.offsets, prefix)
    _, whole = windows(words.hashes, words.offsets, window)
    starts = np.flatnonzero(whole)
    if not len(starts):
        return starts, starts, runs
    least = (runs & ~_PLACE) | np.arange(len(runs), dtype=np.uint64)
    width, have = window - prefix + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    if have < width:
        rest = width - have
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return starts, (least[starts] & _PLACE).astype(np.int64), runs


def _digest(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


@dataclass
class Found:
    """Suspected windows of some texts, as arrays.

    ``row`` of the batch, ``start`` and ``anchor`` (words from the start to the anchor) in the
    text, ``window`` and ``key`` hashes, ``low`` and ``high`` bytes in ``data``.
    """

    row: np.ndarray
    start: np.ndarray
    anchor: np.ndarray
    window: np.ndarray
    key: np.ndarray
    low: np.ndarray
    high: np.ndarray
    data: np.ndarray

    def take(self, chosen: np.ndarray) -> Found:
        columns = (self.row, self.start, self.anchor, self.window, self.key, self.low, self.high)
        return Found(*[c[chosen] for c in columns], self.data)


class _Suspects:
    """Finds the windows whose anchor is in the filter."""

    def __init__(self, filter_bytes: np.ndarray, window: int, prefix: int):
        self._filter, self._window, self._prefix = filter_bytes, window, prefix
        self._reader = WordReader()

    def read(self, texts: pa.Array) -> Iterator[Found]:
        for words in self._reader.read(texts):
            starts, at, runs = anchors(words, self._window, self._prefix)
            new = np.ones(len(at), bool)
            new[1:] = at[1:] != at[:-1]
            flags = suspected(runs[at[new]], self._filter)[np.cumsum(new) - 1] if len(at) else new
            starts, at = starts[flags], at[flags]
            row = np.searchsorted(words.offsets, starts, "right") - 1
            whole, _ = windows(words.hashes, words.offsets, self._window)
            yield Found(
                row + words.first, starts - words.offsets[row], at - starts, whole[starts], runs[at],
                words.starts[starts], words.ends[starts + self._window - 1], words.data,
            )


def covered(runs: list[int], n_words: int, window: int) -> list[tuple[int, int]]:
    """Maximal [from, to) spans of words that the windows starting in ``runs`` cover."""
    spans: list[tuple[int, int]] = []
    for low, high in sorted(zip(runs[::2], runs[1::2], strict=True)):
        high = min(high - 1 + window, n_words)
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((low, high))
    return spans


def first_of_equals(found: Found, ids: np.ndarray) -> np.ndarray:
    """Whether no equal window among those found starts earlier.

    Windows of equal hash are compared word by word; of others with the hash of an earlier one,
    nothing is said here, they count as first.
    """
    own = ids[found.row]
    order = np.lexsort((found.start, own, found.window))
    h, i, s = found.window[order], own[order], found.start[order]
    head = np.ones(len(h), bool)
    head[1:] = h[1:] != h[:-1]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))
    # The same place in a repeated row is not earlier.
    first = np.empty(len(h), bool)
    first[order] = (i == i[lead]) & (s == s[lead])
    later = np.flatnonzero(~first[order])
    data = found.data
    for a, b in zip(order[later].tolist(), order[lead[later]].tolist(), strict=True):
        one, two = (data[found.low[k] : found.high[k]].tobytes() for k in (a, b))
        first[a] = one != two and one.split() != two.split()
    return first


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("owner").fill_null(NO_ID).to_numpy(zero_copy_only=False)


def merged_runs(owner: np.ndarray, digest: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Runs [low, high) of starts of repeated windows, united, as one row per document."""
    order = np.lexsort((low, digest, owner))
    owner, digest, low, high = owner[order], digest[order], low[order], high[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])
    # Ends of earlier documents are moved below every start, so they do not reach over.
    shift = (np.cumsum(new) - 1) << 32
    reach = np.maximum.accumulate(high + shift) if len(high) else high
    begin = new.copy()
    begin[1:] |= (low + shift)[1:] > reach[:-1]
    at = np.flatnonzero(begin)
    ends = (reach - shift)[np.append(at[1:], len(low)) - 1] if len(at) else at
    pairs = np.stack([low[at], ends], axis=1).ravel()
    cuts = 2 * np.append(np.cumsum(begin)[new] - 1, len(at))
    return pa.RecordBatch.from_arrays(
        [pa.array(owner[new], pa.int64()), pa.array(digest[new], pa.int64()),
         pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(pairs, pa.int32()))],
        names=["owner", "digest", "runs"],
    )


def suffix_rows(batch: pa.RecordBatch, suspects: _Suspects) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Suffixes of a batch that may repeat elsewhere, and its own repeated windows."""
    ids, texts = _ids(batch), batch.column("text")
    slices = list(suspects.read(texts))
    found = Found(*[np.concatenate([getattr(f, name) for f in slices]) for name in (
        "row", "start", "anchor", "window", "key", "low", "high")], slices[0].data)
    first = first_of_equals(found, ids)
    digests = np.zeros(batch.num_rows, np.int64)
    raw = texts.cast(pa.binary())
    for row in np.unique(found.row).tolist():
        digests[row] = _digest(raw[row].as_py())
    again = found.take(~first)
    marks = merged_runs(ids[again.row], digests[again.row], again.start, again.start + 1)
    found = found.take(first)
    # Neighbouring windows with one anchor go together.
    new = np.ones(len(found.row), bool)
    new[1:] = (
        (found.row[1:] != found.row[:-1]) | (found.start[1:] != found.start[:-1] + 1)
        | (found.anchor[1:] != found.anchor[:-1] - 1)
    )
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(new)))
    data, low, high = found.data, found.low[head].tolist(), found.high[head + n - 1].tolist()
    lead = found.take(head)
    words = [data[a:b].tobytes() for a, b in zip(low, high, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(lead.key.view(np.int64)), pa.array(ids[lead.row]), pa.array(digests[lead.row]),
         pa.array(lead.start, pa.int32()), pa.array(lead.anchor, pa.int32()),
         pa.array(n, pa.int32()), pa.array(words, pa.binary())],
        names=["key", "owner", "digest", "first", "anchor", "n", "words"],
    ), marks


def word_ranks(words: list[Words]) -> np.ndarray:
    """A number per word, equal for equal words and only for these.

    Words are told apart by their hashes; that equal hashes are equal words is checked, eight
    bytes of all words at a time, and if one is not, words are numbered by their bytes.
    """
    data = words[0].data
    hashes, starts, ends = (
        np.concatenate([getattr(w, name) for w in words]) for name in ("hashes", "starts", "ends")
    )
    _, first, ranks = np.unique(hashes, return_index=True, return_inverse=True)
    if not len(ranks):
        return ranks
    lead, lengths = starts[first][ranks], ends - starts
    equal = bool((lengths == lengths[first][ranks]).all())
    padded = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(8, np.uint8)), 8)
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    todo, at = np.arange(len(ranks)), 0
    while equal and len(todo):
        mask = masks[np.minimum(lengths[todo] - at, 8)]
        one, two = (
            np.ascontiguousarray(padded[s[todo] + at]).view("<u8").ravel() & mask for s in (starts, lead)
        )
        equal = bool((one == two).all())
        at += 8
        todo = todo[lengths[todo] > at]
    if equal:
        return ranks
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(data[a:b].tobytes(), len(numbers))
                     for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])


def suffix_ranks(text: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4 ... symbols from each place, up to ``depth`` or more.

    Equal ranks are equal symbols; the text must end in one that occurs once.
    """
    tables, have = [text.astype(np.int64)], 1
    while have < depth:
        ranks = tables[-1]
        moved = np.zeros(len(ranks), np.int64)
        moved[: max(len(ranks) - have, 0)] = ranks[have:] + 1
        _, longer = np.unique(ranks * (int(ranks.max()) + 2) + moved, return_inverse=True)
        tables.append(longer.astype(np.int64))
        have *= 2
    return tables


def common_prefix(tables: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of symbols that the different suffixes from ``a`` and ``b`` have in common."""
    length, size = np.zeros(len(a), np.int64), len(tables[0])
    for power in reversed(range(len(tables))):
        i, j = np.minimum(a + length, size - 1), np.minimum(b + length, size - 1)
        length += np.where(tables[power][i] == tables[power][j], 1 << power, 0)
    return length


def node_lengths(lcp: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each leaf the depth of the deepest node in which another leaf comes before it.

    ``lcp``: common prefix of each sorted suffix with the one before, 0 for the first;
    ``order``: numbers that say which leaf comes first. A node of the suffix tree is a run of
    suffixes whose common prefixes reach its depth. Only nodes of depth ``least`` or more
    count; leaves in none of them, or first in all of theirs, get 0.
    """
    lengths = np.zeros(len(lcp), np.int64)
    for depth in np.unique(lcp[lcp >= least])[::-1].tolist():
        inner = lcp >= depth
        inner[:-1] |= inner[1:]  # a node's first leaf is in it, too
        leaves = np.flatnonzero(inner & (lengths == 0))
        node = np.cumsum(lcp < depth)
        # The first leaf of a node may have its length from a deeper one: it counts, too.
        members = np.flatnonzero(inner)
        starts = np.flatnonzero(np.append(True, np.diff(node[members]) != 0))
        firsts = np.minimum.reduceat(order[members], starts)
        first_of = firsts[np.searchsorted(node[members][starts], node[leaves])]
        lengths[leaves[order[leaves] > first_of]] = depth
    return lengths


def tree_marks(rows: pa.Table, reader: WordReader, window: int) -> pa.RecordBatch:
    """Repeated windows among the suffixes of some groups, as marks.

    The suffixes are sorted over all of their words; each ends in a symbol of its own. Nodes of
    their tree at the depth of a window or below are repeats, as long as the node is deep.
    """
    owner = rows.column("owner").to_numpy()
    digest, first = rows.column("digest").to_numpy(), rows.column("first").to_numpy()
    n = rows.column("n").to_numpy()
    read = list(reader.read(rows.column("words").combine_chunks().cast(pa.string())))
    ranks = word_ranks(read)
    sizes = np.concatenate([np.diff(w.offsets) for w in read])
    # The words of each row, and after them a symbol that no other row has.
    ends = np.cumsum(sizes + 1) - 1
    text = np.empty(len(ranks) + len(sizes), np.int64)
    is_word = np.ones(len(text), bool)
    is_word[ends] = False
    text[is_word], text[ends] = ranks + len(sizes), np.arange(len(sizes))
    tables = suffix_ranks(text, int(sizes.max()) + 1)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    place = (ends - sizes)[row] + step
    owners, digests, starts = owner[row], digest[row], first[row] + step
    # Places in the order of documents; the same place in a repeated row is not later.
    by_place = np.lexsort((starts, owners))
    changed = np.ones(len(place), bool)
    changed[1:] = (np.diff(owners[by_place]) != 0) | (np.diff(starts[by_place]) != 0)
    came = np.empty(len(place), np.int64)
    came[by_place] = np.cumsum(changed)
    order = np.argsort(tables[-1][place], kind="stable")
    place = place[order]
    lcp = np.zeros(len(place), np.int64)
    lcp[1:] = common_prefix(tables, place[:-1], place[1:])
    lengths = node_lengths(lcp, came[order], window)
    later = lengths > 0
    low = starts[order][later].astype(np.int64)
    return merged_runs(
        owners[order][later], digests[order][later], low, low + lengths[later] - window + 1
    )


def _grouped(rows: DataFrame, window: int) -> DataFrame:
    """Marks of groups that each fit into a task; groups are read one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = WordReader(), [], 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            # The last key may go on in the next batch.
            end = len(keys) if last else int(np.searchsorted(keys, keys[-1]))
            if end:
                yield tree_marks(table.slice(0, end), reader, window)
            rest = table.slice(end)
            held = rest.combine_chunks().to_batches()
            size = int(rest.column("n").to_numpy().sum())

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += int(batch.column("n").to_numpy().sum())
                if size >= SORTED_AT_ONCE:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, MARKS)


def _lengthened(rows: DataFrame, words_: int, window: int) -> DataFrame:
    """One row per window, its key the hash of its first ``words_`` words and its anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            n = batch.column("n").to_numpy()
            for words in reader.read(batch.column("words").cast(pa.string())):
                part = slice(words.first, words.last)
                row = np.repeat(np.arange(words.first, words.last), n[part])
                step = np.arange(len(row)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
                at = words.offsets[row - words.first] + step
                runs, _ = windows(words.hashes, words.offsets, words_)
                anchor = batch.column("anchor").to_numpy()[row] - step
                key = mix(runs[at] + anchor.astype(np.int64).view(np.uint64))
                taken = batch.take(pa.array(row))
                low, high = words.starts[at].tolist(), words.ends[at + window - 1].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), taken.column("owner"), taken.column("digest"),
                     pa.array(taken.column("first").to_numpy() + step, pa.int32()),
                     pa.array(anchor, pa.int32()), pa.array(np.ones(len(row)), pa.int32()),
                     pa.array([b" ".join(words.data[a:b].tobytes().split())
                               for a, b in zip(low, high, strict=True)], pa.binary())],
                    names=batch.schema.names,
                )

    return rows.mapInArrow(run, ROW)


def repeated_windows(rows: DataFrame, window: int, prefix: int, group: int) -> list[DataFrame]:
    """Marks from the suffix rows; ``rows`` is read more than once."""
    spark, found, length = rows.sparkSession, [], prefix
    while True:
        sizes = rows.groupBy("key").agg(F.sum("n").alias("size")).filter(F.col("size") > group)
        large = staged(spark, sizes.select("key"), "large-prefixes")
        if large.isEmpty():
            return [*found, _grouped(rows, window)]
        found.append(_grouped(rows.join(large, "key", "left_anti"), window))
        rows = rows.join(large, "key", "left_semi")
        if length >= window:
            return [*found, _whole_windows(rows)]
        length = min(length + STEP, window)
        rows = staged(spark, _lengthened(rows, length, window), "longer-prefixes")


def _whole_windows(rows: DataFrame) -> DataFrame:
    """Marks of rows of one window each: all but the first place of the same words."""
    place, window = F.struct("owner", "first"), ["key", "words"]
    firsts = staged(
        rows.sparkSession, rows.groupBy(*window).agg(F.min(place).alias("lead")), "first-windows"
    )
    later = rows.join(firsts, window).filter(place > F.col("lead"))
    return later.select("owner", "digest", F.array("first", F.col("first") + 1).alias("runs"))


def dedup_substrings(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    prefix: int = PREFIX,
    group: int = GROUP,
) -> DataFrame:
    """One row per row: id, kept (text of the words that stay), n_words, n_removed, removed.

    ``removed``: the maximal repeats as [from, to) word numbers, from 0.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("owner"), F.col(text_column).alias("text"))
    n_keys = total(rows, F.octet_length("text")) // BYTES_PER_ANCHOR

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        reader = WordReader()
        for batch in batches:
            for words in reader.read(batch.column("text")):
                _, at, runs = anchors(words, window, prefix)
                if len(at):
                    yield runs[np.unique(at)]

    twice = repeated_filter(rows.select("text"), keys, n_keys)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspects = _Suspects(twice.value, window, prefix)
        for batch in parts(batches, "text", COMPARED):
            if not batch.num_rows:
                continue
            batch = batch.set_column(1, "text", batch.column("text").fill_null(""))
            suffixes, marks = suffix_rows(batch, suspects)
            nothing = [pa.nulls(marks.num_rows, f.type) for f in suffixes.schema]
            both = pa.Table.from_arrays(
                [pa.chunked_array([s, m], type=s.type) for s, m in zip(
                    suffixes.columns,
                    [nothing[0], marks.column("owner"), marks.column("digest"), *nothing[3:]],
                    strict=True)]
                + [pa.chunked_array(
                    [pa.nulls(suffixes.num_rows, pa.list_(pa.int32())), marks.column("runs")],
                    type=pa.list_(pa.int32()))],
                names=[*suffixes.schema.names, "runs"],
            )
            yield from both.combine_chunks().to_batches()

    sent = staged(spark, rows.mapInArrow(send, f"{ROW}, runs array<int>"), "suffixes")
    suffixes = sent.filter(F.col("key").isNotNull()).drop("runs")
    own = sent.filter(F.col("key").isNull()).select("owner", "digest", "runs")
    marks = own
    for found in repeated_windows(suffixes, window, prefix, group):
        marks = marks.union(found)
    by_document = marks.groupBy(F.col("owner").alias("_owner"), F.col("digest").alias("_digest")).agg(
        F.flatten(F.collect_list("runs")).alias("runs")
    )

    def some(suspect: bool):
        schema = "owner long, text string" + (", digest long" if suspect else "")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            suspects = _Suspects(twice.value, window, prefix)
            for batch in parts(batches, "text"):
                flags = np.zeros(batch.num_rows, bool)
                for found in suspects.read(batch.column("text")):
                    flags[found.row] = True
                chosen = batch.filter(pa.array(flags == suspect))
                if suspect:
                    digests = [_digest(t) for t in chosen.column("text").cast(pa.binary()).to_pylist()]
                    chosen = chosen.append_column("digest", pa.array(digests, pa.int64()))
                yield chosen

        return rows.mapInArrow(run, schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            kept, counts, removed, spans = [], [], [], []
            runs = batch.column("runs").to_pylist()
            for text, own_runs in zip(batch.column("text").cast(pa.binary()).to_pylist(), runs, strict=True):
                words = (text or b"").split()  # of bytes: splits at the word separators only
                gone = covered(own_runs or [], len(words), window)
                counts.append(len(words))
                removed.append(sum(b - a for a, b in gone))
                spans.append([{"from": a, "to": b} for a, b in gone])
                for a, b in reversed(gone):
                    del words[a:b]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("owner"), pa.array(kept, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))],
                names=["owner", "kept", "n_words", "n_removed", "removed"],
            )

    own_id = F.coalesce("owner", F.lit(NO_ID))
    repeats = some(True).join(
        by_document, (own_id == F.col("_owner")) & (F.col("digest") == F.col("_digest")), "left"
    ).select("owner", "text", "runs")
    others = some(False).withColumn("runs", F.lit(None).cast("array<int>"))
    return repeats.union(others).mapInArrow(
        cut, "owner long, kept string, n_words long, n_removed long, "
        "removed array<struct<from:int,to:int>>",
    ).withColumnRenamed("owner", id_column)
