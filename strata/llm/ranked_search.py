"""Ranked lexical search by sequential reads of impact-sorted lists, without random access (NRA).

Documents are dealt to shards. A shard has one list of postings per term, sorted by impact
(what one occurrence of the term in a query adds to the score). For each query its lists are
read from their heads on, down to a bound that falls with every turn. A document seen has a
lower bound, the impacts read so far, and an upper bound, which adds the least impact read from
every list it was not seen in. Reading goes on until no unseen document and no seen one outside
of the best k can reach the k-th lower bound, ties included, and until the bounds of all that
are left have met: membership, order and scores are final. A task carries the best of its
shards on, so that later shards are cut off sooner. The best of all tasks are ranked at last.

No list and no query meets in one task: a frequent term has a list in each shard. Statistics
cover all documents. Queries are taken in blocks of about ``BLOCK`` bytes of their terms, which
bounds what is broadcast; each block reads the documents again.

Cases: null text has no terms. Rows of items that are equal in id and text are one item; an id
with two texts is two items, with a ranking each. Items without terms, or none of whose terms
adds to a score, have no rows. Rows that repeat a document id are documents of their own; a
null id comes after all others. Other columns are ignored. Empty tables give an empty result. A
task holds the postings of a shard, and of one text at a time what it counts.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.batches import bound_batches
from strata.session import staged

BEST = 10
# What the bound of the lists is divided by in a turn.
STEP = 2
# Bytes of query terms in a block, postings of a shard, bytes of a text counted at once.
BLOCK, SHARD, PIECE = 8 << 20, 2_000_000, 1 << 20
# Scale of weights, of impacts, saturation and share of length in a score.
WEIGHT, IMPACT, K, LENGTH, EVEN = 1000, 1_000_000_000, 8, 75, 25
NO_ID = 2**63 - 1

# Bytes of terms as they are, A-Z lower-cased, and a space for every other byte. Bytes of
# characters beyond ASCII are all part of terms.
_FOLD = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def count_terms(text: bytes, fold: bytes = _FOLD, piece: int = PIECE) -> Counter[bytes]:
    """Occurrences of each term of a text, read in pieces that end between terms.

    ``fold`` maps what stands between terms to a space.
    """
    counts: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        end = at + piece
        part = text[at:end].translate(fold)
        while end < len(text) and part[-1] != 0x20:
            more = text[end : end + max(4096, len(part))].translate(fold)
            cut = more.find(b" ")
            part += more if cut < 0 else more[: cut + 1]
            end += len(more) if cut < 0 else cut + 1
        counts.update(part.split())
        at = end
    return counts


def term_rows(rows: DataFrame, vocabulary=None) -> DataFrame:
    """``rows`` (id, text) as id, n, terms and counts, for rows with any term.

    ``terms`` are the texts' own terms, or, with a vocabulary (a broadcast dict of terms), the
    numbers of those it holds.
    """
    kind, arrow = ("binary", pa.binary()) if vocabulary is None else ("int", pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.value if vocabulary else None
        for batch in batches:
            keep, lengths, sizes, terms, counts = [], [], [0], [], []
            for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
                counted = count_terms(text.as_py() or b"")
                if not counted:
                    continue
                keep.append(row)
                lengths.append(counted.total())
                for term, count in counted.items():
                    number = term if numbers is None else numbers.get(term)
                    if number is not None:
                        terms.append(number)
                        counts.append(count)
                sizes.append(len(terms))
            at = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, arrow)),
                 pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
                names=["id", "n", "terms", "counts"],
            )

    return rows.mapInArrow(run, f"id long, n long, terms array<{kind}>, counts array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * holding + 1)))


# Its number, its id, numbers of its terms, and how often it repeats each.
Query = tuple[int, int | None, list[int], list[int]]


class Shard:
    """Impact-sorted lists over some documents, numbered by ascending id."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        keep = impact > 0
        doc, term, impact = doc[keep], term[keep], impact[keep]
        order = np.lexsort((-impact, term))
        self.ids, self.doc, self.impact = ids, doc[order], impact[order]
        terms, starts = np.unique(term[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        self.lists = dict(zip(terms.tolist(), zip(starts.tolist(), ends.tolist()), strict=True))

    def best(self, query: Query, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, document) of all that may be among the best k, best ones first.

        Only documents that reach ``floor`` are wanted. Reads are sequential: each list has a
        place up to which it was read, and nothing behind it is looked at.
        """
        _, _, terms, repeats = query
        lists = [(*self.lists[t], r) for t, r in zip(terms, repeats, strict=True) if t in self.lists]
        if not lists:
            return []
        lower = np.zeros(len(self.ids), np.int64)
        # The most that the next posting of each list can add, and where it stands.
        heads = np.array([self.impact[start] * r for start, _, r in lists])
        places = [start for start, _, _ in lists]
        level, wanted, reached = int(heads.max()), None, max(floor, 1)
        while True:
            level //= STEP
            for i, (_, end, r) in enumerate(lists):
                at = places[i]
                if heads[i] <= level or at == end:
                    continue
                # Impacts fall along the list; all above the level are read.
                stop = at + int(np.searchsorted(-self.impact[at:end], -(level // r), "left"))
                lower[self.doc[at:stop]] += self.impact[at:stop] * r
                places[i] = stop
                heads[i] = self.impact[stop] * r if stop < end else 0
            candidates = np.flatnonzero(lower) if wanted is None else wanted
            if len(candidates) >= k:
                kth = int(np.partition(lower[candidates], len(candidates) - k)[len(candidates) - k])
                reached = max(reached, kth)
            # Lists in which a document was seen add nothing to it any more.
            seen = np.zeros(len(self.ids), np.int64)
            for (start, end, _), place, head in zip(lists, places, heads, strict=True):
                if start < place < end:
                    seen[self.doc[start:place]] += head
            unseen = int(heads.sum())
            rest = unseen - seen[candidates]
            # Exhausted lists have no head, so documents seen there are right as well.
            stay = lower[candidates] + rest >= reached
            candidates, rest = candidates[stay], rest[stay]
            if unseen < reached:
                # No document that was not seen can come in any more.
                wanted = candidates
                if not rest.any():
                    break
        scores = lower[candidates]
        order = np.lexsort((candidates, -scores))[:k]
        return [(int(scores[i]), int(candidates[i])) for i in order.tolist()]


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, length: int,
            most: int) -> Iterator[tuple[Shard, np.ndarray]]:
    """Shards of about ``most`` postings, and which of their documents have a null id."""
    held: list[pa.RecordBatch] = []
    size = 0

    def build() -> tuple[Shard, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table.column("id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        number = ids.fill_null(NO_ID).to_numpy()
        terms, counts = (table.column(c).combine_chunks() for c in ("terms", "counts"))
        of = np.repeat(np.arange(len(ids)), np.diff(terms.offsets.to_numpy()))
        order = np.lexsort((null, number))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        n = table.column("n").to_numpy()
        norm = EVEN + (LENGTH * n * documents) // length
        term, count = terms.flatten().to_numpy(), counts.flatten().to_numpy()
        impact = weights[term] * ((IMPACT * count) // (WEIGHT * count + K * norm[of]))
        return Shard(number[order], place[of], term, impact), null[order]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column("terms").flatten()) + batch.num_rows
        if size >= most:
            yield build()
            held, size = [], 0
    if held:
        yield build()


def rank_block(rows: DataFrame, queries: list[Query], terms: dict[bytes, int], k: int, shard: int) -> DataFrame:
    """number, item, score, doc: the best k documents per query and task."""
    context = rows.sparkSession.sparkContext
    found = staged(rows.sparkSession, term_rows(rows, context.broadcast(terms)), "postings")
    documents, length = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block, whose size is bounded.
    holding = np.zeros(len(terms), np.int64)
    for term, count in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        holding[term] = count
    weights = np.array([weight(documents, int(n)) for n in holding], np.int64)
    shared = context.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best: list[list[tuple[int, int, int]]] = [[] for _ in queries]
        for lists, null in _shards(batches, weights, documents, length, shard):
            for i, query in enumerate(queries):
                floor = -best[i][-1][0] if len(best[i]) == k else 1
                new = [(-score, int(lists.ids[d]), int(null[d])) for score, d in lists.best(query, k, floor)]
                if new:
                    best[i] = list(heapq.merge(best[i], sorted(new)))[:k]
        rows = [(number, item, -s, None if null else d)
                for (number, item, _, _), own in zip(queries, best, strict=True)
                for s, d, null in own]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                names=["number", "item", "score", "doc"],
            )

    return found.mapInArrow(run, "number long, item long, score long, doc long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    block: int = BLOCK,
    shard: int = SHARD,
) -> DataFrame:
    """The k best documents of each item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    asked = items.select(
        F.col(item_column).cast("long").alias("id"), F.col(item_text).alias("text")
    ).distinct()
    asked = staged(spark, term_rows(asked), "queries")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 50)
    blocks = 1 + int(asked.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]) // block
    found = []
    for turn in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("id", "terms"), F.lit(blocks)) == turn)
        terms: dict[bytes, int] = {}
        queries = []
        # About ``block`` bytes.
        for row in mine.toLocalIterator():
            numbers = [terms.setdefault(bytes(t), len(terms)) for t in row["terms"]]
            queries.append((turn << 40 | len(queries), row["id"], numbers, row["counts"]))
        if queries:
            found.append(rank_block(rows, queries, terms, k, shard))
    if not found:
        return spark.createDataFrame([], f"{item_column} long, rank int, {id_column} long, score long")
    best = found[0]
    for other in found[1:]:
        best = best.union(other)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("item").alias(item_column), "rank", F.col("doc").alias(id_column), "score"
    )
