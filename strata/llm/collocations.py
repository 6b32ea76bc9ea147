"""Phrase collocations by mergeable Misra-Gries summaries.

Which n-grams are frequent is found in three passes; a fourth counts those exactly. Words are
counted first. Then pairs of frequent words are summarised, then longer n-grams all of whose
pairs have survived: an n-gram cannot be more frequent than its parts. Hashes of n-grams are
dealt to partitions. Tasks send summaries per partition, and the summaries of a partition are
merged: equal n-grams add up, and when there are more counters than the partition's capacity,
all are lowered by the first one beyond it and those at zero are dropped. The capacity exceeds
the partition's mass (the occurrences that were summarised) divided by the threshold, so all
lowering together stays below the threshold and every frequent n-gram survives. N-grams that
reach the threshold within one task are survivors without a summary, so a very frequent one
does not raise the capacity. Survivors are handed to the next pass as a Bloom filter; what it
lets through besides is counted and falls to the threshold.

The exact counts are of the phrases themselves, not of hashes. What follows (cuts, scores,
longer phrases, ranks) is joins and aggregates of the frequent phrases.

Cases: null text is empty, null lang is ``und`` and the same as that text. Rows that repeat,
null ids and other columns do not matter: every row counts. An empty table, or one without a
frequent phrase, gives an empty result. Texts are read in slices, a single text whole; a task
holds the counters of a summary, at most. Counts may reach 10^14.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.batches import bound_batches
from strata.llm.ranked_search import count_terms
from strata.llm.suspects import bloom_filter, filter_bits, suspected
from strata.llm.words import WordReader, mix, windows
from strata.session import staged

THRESHOLD, LONGEST, BEST = 100, 5, 2000
# A candidate goes where a longer one that holds it has this share of its occurrences.
HELD_PERCENT = 100
# Counters of a partition, occurrences a task gathers for a summary, phrases it counts at once.
COUNTERS, GATHERED, COUNTED = 200_000, 4 << 20, 400_000
# What separates words, and what separates pieces.
BETWEEN_WORDS, BETWEEN_PIECES = b" \t", b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

_FOLD = bytes(0x20 if b in BETWEEN_WORDS + BETWEEN_PIECES else b for b in bytes(range(256)).lower())


def _table(marked: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(marked)] = True
    return table


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Grams:
    """N-grams of a slice of texts: keys, whether they lie in one piece, and their bytes."""

    def __init__(self, words, langs: pa.Array, ends: np.ndarray):
        self.words = words
        first, last = words.offsets[0], words.offsets[-1]
        self.low = int(words.starts[0]) if last > first else 0
        self.high = int(words.ends[-1]) if last > first else 0
        breaks = np.flatnonzero(ends[words.data[self.low : self.high]]) + self.low
        piece = np.searchsorted(breaks, words.starts)
        new = np.ones(len(piece), bool)
        new[1:] = piece[1:] != piece[:-1]
        new[words.offsets[:-1][np.diff(words.offsets) > 0]] = True
        self.pieces = np.append(np.flatnonzero(new), len(piece))
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        own = np.array([_lang_hash(x) for x in self.langs] or [0], np.uint64)
        self.lang = np.repeat(coded.indices.to_numpy(), np.diff(words.offsets))
        self.salt = own[self.lang] if len(self.lang) else np.zeros(0, np.uint64)

    def word_keys(self) -> np.ndarray:
        return mix(self.words.hashes ^ self.salt)

    def keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Key of the n words from each place, and whether they lie in one piece."""
        runs, inside = windows(self.words.hashes, self.pieces, n)
        return mix(runs ^ self.salt[: len(runs)]), inside

    def phrases(self, places: np.ndarray, n: int) -> list[bytes]:
        raw = self.words.data[self.low : self.high].tobytes()
        starts = (self.words.starts[places] - self.low).tolist()
        ends = (self.words.ends[places + n - 1] - self.low).tolist()
        return [raw[a:b] for a, b in zip(starts, ends, strict=True)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    reader = WordReader(_table(BETWEEN_WORDS + BETWEEN_PIECES))
    ends = _table(BETWEEN_PIECES)
    for batch in batches:
        langs = batch.column("lang")
        for words in reader.read(pc.ascii_lower(batch.column("text"))):
            yield Grams(words, langs.slice(words.first, words.last - words.first), ends)


def _held(keys: np.ndarray, chosen: np.ndarray, filter_bytes: np.ndarray) -> np.ndarray:
    """Which of the chosen keys are in the filter."""
    held = np.zeros(len(keys), bool)
    places = np.flatnonzero(chosen)
    held[places] = suspected(keys[places], filter_bytes)
    return held


def _counted(batches, count) -> Iterator[pa.RecordBatch]:
    """lang, phrase, count from Counters per lang that ``count`` fills batch by batch."""
    counts: dict[str, Counter[bytes]] = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        langs = [lang for lang, own in counts.items() for _ in own]
        phrases = [b" ".join(p.split()) for own in counts.values() for p in own]
        numbers = [c for own in counts.values() for c in own.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
             pa.array(numbers, pa.int64())], names=["lang", "phrase", "a"])

    for _ in count(batches, counts):
        if sum(map(len, counts.values())) >= COUNTED:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def _summed(sent: DataFrame) -> DataFrame:
    return sent.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def count_words(texts: DataFrame) -> DataFrame:
    """lang, phrase (one word) and its occurrences."""

    def count(batches, counts) -> Iterator[None]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                counts[lang].update(count_terms(text.as_py(), _FOLD))
                yield

    return _summed(texts.mapInArrow(
        lambda batches: _counted(batches, count), "lang string, phrase string, a long"
    ))


def _keys_of(phrases: DataFrame) -> Broadcast:
    """A filter of the keys of one-word phrases."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for grams in _slices(batches):
            yield grams.word_keys()

    words = phrases.select("lang", F.col("phrase").alias("text"))
    return bloom_filter(words, keys, filter_bits(words.count()), times=1)


def _chosen(grams: Grams, sizes: range, words: Broadcast, pairs: Broadcast | None):
    """Keys and marks of the n-grams that may be frequent, for each size."""
    two, inside = grams.keys(2)
    if pairs is None:
        word = suspected(grams.word_keys(), words.value)
        yield 2, two, inside & word[:-1] & word[1:] if len(word) else inside
        return
    pair = _held(two, inside, pairs.value)
    for n in sizes:
        keys, inside = grams.keys(n)
        for i in range(n - 1):
            inside &= pair[i : i + len(keys)]
        yield n, keys, inside


def survivors(texts: DataFrame, sizes: range, words: Broadcast, pairs: Broadcast | None,
              mass: int, threshold: int, counters: int = COUNTERS) -> DataFrame:
    """Keys of all n-grams of these sizes with at least ``threshold`` occurrences, and others.

    ``mass`` bounds the occurrences; it sets the number of partitions.
    """
    bits = max(mass // (threshold * counters), 1).bit_length() - 1
    shift, low = np.uint64(63 - bits), np.dtype("<u2" if threshold < 1 << 16 else "<u8")

    def summary(held: list[np.ndarray]) -> Iterator[tuple]:
        """Sure keys, and for each partition its mass and then its counters."""
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        sure = counts >= threshold
        for key in keys[sure].view(np.int64).tolist():
            yield -1, 0, 0, None, None, key
        keys, counts = keys[~sure], counts[~sure]
        part = (keys >> shift >> np.uint64(1)).astype(np.int64)
        parts, starts = np.unique(part, return_index=True)
        for p, a, b in zip(parts.tolist(), starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
            yield p, 0, int(counts[a:b].sum()), None, None, None
            gaps = np.diff(keys[a:b], prepend=np.uint64(0)).astype("<u8").view(np.uint8)
            planes = np.ascontiguousarray(gaps.reshape(-1, 8).T)
            yield p, 1, 0, planes.tobytes(), counts[a:b].astype(low).tobytes(), None

    def table(rows: list[tuple]) -> pa.RecordBatch:
        types = pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64()
        names = ["part", "turn", "mass", "gaps", "counts", "key"]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for grams in _slices(batches):
            for _, keys, chosen in _chosen(grams, sizes, words, pairs):
                held.append(keys[chosen])
                size += len(held[-1])
            if size >= GATHERED:
                yield table(list(summary(held)))
                held, size = [], 0
        if size:
            yield table(list(summary(held)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by partition, masses first; one partition is held at a time."""
        now, merged = None, None
        for batch in batches:
            columns = [batch.column(c) for c in ("part", "turn", "mass", "gaps", "counts")]
            for part, turn, mass, gaps, counts in zip(*columns, strict=True):
                if part.as_py() != now:
                    if merged:
                        yield merged.survivors()
                    now, merged = part.as_py(), Summary(threshold)
                if turn.as_py() == 0:
                    merged.mass += mass.as_py()
                else:
                    planes = np.frombuffer(gaps.as_py(), np.uint8).reshape(8, -1)
                    keys = np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)
                    merged.add(keys, np.frombuffer(counts.as_py(), low).astype(np.int64))
        if merged:
            yield merged.survivors()

    sent = texts.mapInArrow(
        send, "part long, turn int, mass long, gaps binary, counts binary, key long"
    )
    sent = staged(texts.sparkSession, sent, "summaries")
    summaries = sent.filter("part >= 0").drop("key")
    left = summaries.repartition("part").sortWithinPartitions("part", "turn").mapInArrow(merge, "key long")
    return left.union(sent.filter("part < 0").select("key")).distinct()


class Summary:
    """Counters of one partition. ``lowered`` bounds how far each is below the true count."""

    def __init__(self, threshold: int):
        self.threshold, self.mass, self.lowered = threshold, 0, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size >= max(len(self.keys), COUNTERS):
            self.merge()

    def merge(self) -> None:
        keys, counts = zip((self.keys, self.counts), *self.waiting, strict=True)
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        self.keys = keys[starts]
        self.counts = np.add.reduceat(counts, starts) if len(starts) else counts
        self.waiting, self.size = [], 0
        capacity = self.mass // self.threshold + 1
        if len(self.keys) > capacity:
            place = len(self.keys) - capacity - 1
            least = int(np.partition(self.counts, place)[place])
            self.lowered += least
            self.counts = self.counts - least
            left = self.counts > 0
            self.keys, self.counts = self.keys[left], self.counts[left]

    def survivors(self) -> pa.RecordBatch:
        self.merge()
        found = self.keys[self.counts + self.lowered >= self.threshold]
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["key"])


def _filter(keys: DataFrame) -> Broadcast:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            yield batch.column("key").to_numpy().view(np.uint64)

    return bloom_filter(keys, read, filter_bits(keys.count()), times=1)


def count_phrases(texts: DataFrame, longest: int, pairs: Broadcast, longer: Broadcast | None) -> DataFrame:
    """lang, phrase and occurrences of all n-grams that the filters hold."""

    def count(batches, counts) -> Iterator[None]:
        for grams in _slices(batches):
            two, inside = grams.keys(2)
            pair = _held(two, inside, pairs.value)
            found = [(2, pair)]
            if longer is not None:
                for n, keys, chosen in _chosen(grams, range(3, longest + 1), pairs, pairs):
                    found.append((n, _held(keys, chosen, longer.value)))
            for n, held in found:
                for code, lang in enumerate(grams.langs):
                    places = np.flatnonzero(held & (grams.lang[: len(held)] == code))
                    if len(places):
                        counts[lang].update(grams.phrases(places, n))
            yield

    return _summed(texts.mapInArrow(
        lambda batches: _counted(batches, count), "lang string, phrase string, a long"
    ))


def frequent_phrases(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    counters: int = COUNTERS,
) -> tuple[DataFrame, DataFrame]:
    """Exact counts of all frequent phrases of 1 to ``longest`` words, and of words per lang.

    lang, phrase, a and size (words); lang and n.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    words = staged(spark, count_words(texts), "words")
    totals = staged(spark, words.groupBy("lang").agg(F.sum("a").alias("n")), "langs")
    mass = int(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    frequent = staged(spark, words.filter(F.col("a") >= threshold), "frequent-words")
    single = frequent.withColumn("size", F.lit(1))
    if longest < 2 or frequent.isEmpty():
        return single, totals
    known = _keys_of(frequent)
    two = staged(spark, survivors(texts, range(2, 3), known, None, mass, threshold, counters), "pairs")
    pairs, longer = _filter(two), None
    if longest > 2:
        sizes = range(3, longest + 1)
        more = survivors(texts, sizes, known, pairs, mass * len(sizes), threshold, counters)
        longer = _filter(staged(spark, more, "longer"))
    counted = count_phrases(texts, longest, pairs, longer).filter(F.col("a") >= threshold)
    phrases = counted.withColumn("size", F.size(F.split("phrase", " ")))
    return single.unionByName(staged(spark, phrases, "phrases")), totals


def _part(words: Column, start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    best: int = BEST,
    held_percent: int = HELD_PERCENT,
    counters: int = COUNTERS,
) -> DataFrame:
    """Each lang's best phrases: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = frequent_phrases(docs, text_column, lang_column, threshold, longest, counters)
    candidates = counts.filter("size > 1")
    words = F.split("phrase", " ")
    # A candidate that a longer one holds with the same number of occurrences goes.
    inner = candidates.filter("size > 2").select(
        "lang", F.col("a").alias("longer"), "size", words.alias("words"),
        F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"),
    ).select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
    inner = inner.select(
        "lang", _part(F.col("words"), F.col("start"), F.col("length")).alias("phrase"), "longer"
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < held_percent * F.col("a"))
    )
    cuts = kept.select(
        "lang", "phrase", "a", "size", words.alias("words"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", _part(F.col("words"), 1, F.col("k")).alias("first"),
        _part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cut = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")

    def exact(column: str, scale: int = 1) -> Column:
        return (F.col(column) * scale).cast("decimal(18,0)")

    cut = cut.withColumn("up", exact("a", 1000) * exact("n")).withColumn("down", exact("l") * exact("r"))
    lowest = cut.withColumn("score", F.expr("up div down")).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return flat.withColumn("rank", F.row_number().over(order).cast("long")).filter(
        F.col("rank") <= best
    ).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
