"""Approximate nearest neighbours with learned partitions.

On a bounded sample the neighbour graph is built and cut into parts of equal size by recursive
bisection: a spectral order is halved, then pairs of vectors change sides where that leaves
fewer neighbours apart. A small classifier learns the part of a vector from the vector, with
the parts of its neighbours as soft labels. Every vector of the table is filed under its most
probable part. Where parts of the table grow large, each is divided again in the same way, by a
classifier learned in a task on a bounded sample of that part. A query goes to its most
probable parts by the product of both probabilities; there it is compared exactly, by inner
product in double precision.

How many parts a query visits is set by held-out queries, which no classifier has learned from:
they are compared with the whole table, and the parts of their true neighbours tell how many
visits give the recall that is asked for. A query visits more parts where those hold too few
vectors.

Parts are searched in blocks, and a part's queries are cut into blocks as well, so no part
meets in one task. Of identical vectors only the ``k + 1`` smallest ids are filed: no other
can be among the nearest ``k`` of any query, so a vector that very many rows share costs no
more than others and no answer changes.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor
do those whose length is not the most frequent one. Rows that repeat an id and vector count
once. Rows with a null id are no queries and no candidates. A query has fewer than ``k``
answers only if there are fewer candidates. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import staged

# Vectors that a classifier learns from; the table is filed whole. Held-out queries.
SAMPLE, HELD_OUT = 4096, 512
# Sampled vectors per part, parts per classifier at most, neighbours in the graph.
PER_PART, MOST_PARTS, NEIGHBOURS = 64, 64, 10
# Rows of a part, on average, beyond which parts are divided again.
PART_ROWS = 32768
# Recall of the held-out queries that sets the number of parts a query visits.
RECALL = 0.97
HIDDEN, STEPS, BATCH, RATE = 64, 800, 512, 0.01
# Vectors and queries of a block, vectors that are routed at a time.
BLOCK, QUERY_BLOCK, SLICE = 8192, 2048, 512


@dataclass(frozen=True)
class Router:
    """A classifier with one hidden layer."""

    hidden: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.out_bias)

    def odds(self, vectors: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of each part."""
        scores = np.maximum(vectors @ self.hidden + self.bias, 0) @ self.out + self.out_bias
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Tree:
    """A classifier and those below its parts; part ``p`` has the numbers from ``p * fan``."""

    root: Router
    below: tuple[Router | None, ...] = ()
    fan: int = 1

    @property
    def parts(self) -> int:
        return self.root.parts * self.fan

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The part of each vector: the most probable one at each level."""
        first = self.root.odds(vectors).argmax(axis=1)
        found = first * self.fan
        for part, router in enumerate(self.below):
            own = np.flatnonzero(first == part)
            if router is not None and len(own):
                found[own] += router.odds(vectors[own]).argmax(axis=1)
        return found

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """All parts, the most probable ones of each vector first; numbers not in use last."""
        first = self.root.odds(vectors)
        if self.fan > 1:
            both = np.full((*first.shape, self.fan), -np.inf)
            for part, router in enumerate(self.below):
                odds = router.odds(vectors) if router is not None else np.zeros((len(vectors), 1))
                both[:, part, : odds.shape[1]] = first[:, part, None] + odds
            first = both.reshape(len(vectors), -1)
        return np.argsort(-first, axis=1, kind="stable")


@dataclass(frozen=True)
class Index:
    """The filed table (id, vector, part), how to route to it, and rows per part."""

    vectors: DataFrame
    filed: DataFrame
    tree: Tree
    sizes: np.ndarray
    visits: int
    width: int

    def routes(self, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the vectors and the parts that each visits; empty parts are left out."""
        order = self.tree.order(vectors)
        # Enough parts that the query finds k others whatever the parts hold.
        enough = (np.cumsum(self.sizes[order], axis=1) <= k).sum(axis=1) + 1
        visits = np.minimum(np.maximum(enough, self.visits), len(self.sizes))
        row = np.repeat(np.arange(len(order)), visits)
        step = np.arange(len(row)) - np.repeat(np.cumsum(visits) - visits, visits)
        part = order[row, step]
        held = self.sizes[part] > 0
        return row[held], part[held]


def valid(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def neighbour_graph(vectors: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each vector by inner product, nearest first."""
    k = min(k, len(vectors) - 1)
    found = np.empty((len(vectors), k), np.int64)
    for low in range(0, len(vectors), 512):
        scores = vectors[low : low + 512] @ vectors.T
        scores[np.arange(len(scores)), np.arange(low, low + len(scores))] = -np.inf
        found[low : low + 512] = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return found


def balanced_parts(graph: np.ndarray, levels: int) -> np.ndarray:
    """Part of each vertex, 2^levels parts whose sizes differ by one per level at most."""
    n, k = graph.shape
    a, b = np.repeat(np.arange(n), k), graph.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    part = np.zeros(n, np.int64)
    for level in range(levels):
        bits = np.zeros(n, np.int64)
        for number in range(1 << level):
            nodes = np.flatnonzero(part == number)
            local = np.full(n, -1, np.int64)
            local[nodes] = np.arange(len(nodes))
            inside = (local[a] >= 0) & (local[b] >= 0)
            bits[nodes] = _bisected(len(nodes), local[a[inside]], local[b[inside]])
        part = 2 * part + bits
    return part


def _bisected(n: int, a: np.ndarray, b: np.ndarray, turns: int = 60, swaps: int = 8) -> np.ndarray:
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    value = np.random.default_rng(n).standard_normal(n)
    for _ in range(turns):
        # Half a step of the walk on the graph, without the constant vector.
        value = (value + np.bincount(a, weights=value[b], minlength=n) / degree) / 2
        value -= (value * degree).sum() / degree.sum()
        value /= np.linalg.norm(value) or 1
    side = np.zeros(n, np.int64)
    side[np.argsort(value, kind="stable")[n // 2 :]] = 1
    for _ in range(swaps):
        apart = np.bincount(a, weights=(side[a] != side[b]).astype(float), minlength=n)
        gain = 2 * apart - np.bincount(a, minlength=n)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        left = left[np.argsort(-gain[left], kind="stable")]
        right = right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        worth = np.flatnonzero(gain[left[:m]] + gain[right[:m]] > 0)
        # Half of the pairs at a time: neighbours that move together gain less.
        worth = worth[: (len(worth) + 1) // 2]
        if not len(worth):
            break
        side[left[worth]], side[right[worth]] = 1, 0
    return side


def learn_router(vectors: np.ndarray, most: int = MOST_PARTS) -> Router:
    """Partition the sample in at most ``most`` parts and fit the classifier."""
    n, width = vectors.shape
    levels = 0
    while 2 << levels <= min(most, n // PER_PART):
        levels += 1
    parts = 1 << levels
    rng = np.random.default_rng(0)
    weights = [
        rng.standard_normal((width, HIDDEN)) * np.sqrt(2 / width), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts),
    ]
    if parts > 1:
        weights[0] /= np.sqrt((vectors**2).sum(axis=1).mean() / width)
        nearest = neighbour_graph(vectors, NEIGHBOURS)
        part = balanced_parts(nearest, levels)
        around = np.concatenate([part[:, None], part[nearest]], axis=1)
        soft = np.zeros((n, parts))
        np.add.at(soft, (np.arange(n)[:, None], around), 1 / around.shape[1])
        _fit(weights, vectors, soft, rng)
    return Router(*weights)


def _fit(weights: list[np.ndarray], x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
    """Cross entropy by stochastic gradient descent with adaptive steps."""
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for step in range(1, STEPS + 1):
        chosen = rng.integers(0, len(x), min(BATCH, len(x)))
        inner = np.maximum(x[chosen] @ weights[0] + weights[1], 0)
        out = inner @ weights[2] + weights[3]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        slope = (out / out.sum(axis=1, keepdims=True) - y[chosen]) / len(chosen)
        back = (slope @ weights[2].T) * (inner > 0)
        slopes = [x[chosen].T @ back, back.sum(axis=0), inner.T @ slope, slope.sum(axis=0)]
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for w, m, v, g in zip(weights, first, second, slopes, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _best(scores: np.ndarray, query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """The k best of one query: largest score, then smallest id, scores summed alike."""
    if len(scores) > k:
        # The product of matrices may round equal vectors differently; leave room for it.
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= bound - 1e-9 * max(1.0, abs(bound)))
    else:
        near = np.arange(len(scores))
    exact = (vectors[near] * query).sum(axis=1)
    order = np.lexsort((ids[near], -exact))[:k]
    return ids[near][order], exact[order]


def _slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _array(numbers: Iterable[int]) -> Column:
    return F.expr(f"array({', '.join(str(int(n)) for n in numbers)})")


def _per_part(rows: DataFrame, parts: int) -> np.ndarray:
    counts = np.zeros(parts, np.int64)
    for row in rows.groupBy("part").count().collect():  # a row per part
        counts[row["part"]] = row["count"]
    return counts


def _filed(rows: DataFrame, tree: Tree, width: int, label: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, SLICE):
            part = tree.file(_matrix(batch.column("vector"), width))
            yield batch.append_column("part", pa.array(part, pa.int32()))

    schema = "id long, vector array<double>, part int"
    return staged(rows.sparkSession, rows.mapInArrow(run, schema), label)


def _divided(filed: DataFrame, tree: Tree, sizes: np.ndarray, width: int, fan: int, sample: int) -> Tree:
    """The tree with a classifier below each part, learned in tasks on a sample of the part."""
    share = 1 << 20
    # Twice the sample is drawn, so that the first ones by hash are always there.
    rates = _array(np.minimum(share, -(-2 * sample * share // np.maximum(sizes, 1))))
    draw = F.xxhash64(F.lit("part"), "id")
    drawn = filed.withColumn("draw", draw).filter(
        F.pmod("draw", F.lit(share)) < F.element_at(rates, F.col("part") + 1)
    )

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("draw", "ascending"), ("id", "ascending")]).slice(0, sample)
        router = learn_router(_matrix(table.column("vector").combine_chunks(), width), fan)
        numbers = [router.hidden, router.bias, router.out, router.out_bias]
        return pa.table({
            "part": table.column("part").slice(0, 1),
            "weights": pa.array([np.concatenate([n.ravel() for n in numbers])], pa.list_(pa.float64())),
        })

    learned: list[Router | None] = [None] * tree.parts
    for row in drawn.groupBy("part").applyInArrow(
        learn, "part int, weights array<double>"
    ).toLocalIterator():  # a row per part of the first level
        flat = np.array(row["weights"])
        first, rest = np.split(flat, [width * HIDDEN + HIDDEN])
        parts = len(rest) // (HIDDEN + 1)
        learned[row["part"]] = Router(
            first[:-HIDDEN].reshape(width, HIDDEN), first[-HIDDEN:],
            rest[:-parts].reshape(HIDDEN, parts), rest[-parts:],
        )
    return Tree(tree.root, tuple(learned), fan)


def _visits(filed: DataFrame, tree: Tree, ids: np.ndarray, held: np.ndarray, k: int, recall: float) -> int:
    """Parts to visit for the recall, by comparing the held-out queries with all rows."""
    width = held.shape[1]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, where = np.full((len(held), k), -np.inf), np.zeros((len(held), k), np.int64)
        for batch in _slices(batches, 8 * SLICE):
            scores = held @ _matrix(batch.column("vector"), width).T
            scores[ids[:, None] == batch.column("id").to_numpy()] = -np.inf
            scores = np.concatenate([best, scores], axis=1)
            part = np.broadcast_to(batch.column("part").to_numpy(), (len(held), batch.num_rows))
            top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(scores, top, axis=1)
            where = np.take_along_axis(np.concatenate([where, part], axis=1), top, axis=1)
        query, place = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([
            pa.array(query, pa.int32()), pa.array(best[query, place]),
            pa.array(where[query, place], pa.int32()),
        ], ["query", "score", "part"])

    found = filed.mapInArrow(compare, "query int, score double, part int")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "part"))
    # k rows per held-out query.
    true = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "part").toArrow()
    order = tree.order(held)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(tree.parts)[None, :], axis=1)
    needed = place[true.column("query").to_numpy(), true.column("part").to_numpy()]
    reached = np.cumsum(np.bincount(needed, minlength=tree.parts)) / max(len(needed), 1)
    return min(tree.parts, int(np.searchsorted(reached, recall)) + 1)


def build_index(
    rows: DataFrame, k: int, sample: int = SAMPLE, recall: float = RECALL, part_rows: int = PART_ROWS
) -> Index | None:
    """File ``rows`` (id, vector) under learned parts; None without a valid vector."""
    spark = rows.sparkSession
    good = rows.filter(F.col("id").isNotNull() & valid(F.col("vector")))
    lengths = good.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), "n").first()
    if common is None:
        return None
    width = common["n"]
    good = staged(spark, good.filter(F.size("vector") == width).distinct(), "vectors")
    taken = good.orderBy(F.xxhash64("id"), "id").limit(sample + HELD_OUT).collect()
    ids, drawn = np.array([row["id"] for row in taken]), np.array([row["vector"] for row in taken])
    held = min(HELD_OUT, len(drawn) // 8)
    tree = Tree(learn_router(drawn[held : held + sample]))
    # The limit per vector is applied before the shuffle, too.
    alike = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    single = good.withColumn("_n", alike).filter(F.col("_n") <= k + 1).drop("_n")
    filed = _filed(single, tree, width, "filed-vectors")
    sizes = _per_part(filed, tree.parts)
    fan = 1
    while fan < MOST_PARTS and sizes.sum() > part_rows * tree.parts * fan:
        fan *= 2
    if fan > 1:
        tree = _divided(filed, tree, sizes, width, fan, sample)
        filed = _filed(filed.drop("part"), tree, width, "filed-again")
        sizes = _per_part(filed, tree.parts)
    visits = 1
    if tree.parts > 1:
        visits = _visits(filed, tree, ids[:held], drawn[:held], k, recall)
    return Index(good, filed, tree, sizes, visits, width)


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    sample: int = SAMPLE,
    recall: float = RECALL,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), id and score of the nearest found of each query row.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = rows.sparkSession
    named = rows.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    index = build_index(named, k, sample, recall, part_rows)
    if index is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id_column} long, score double")
    width, sizes = index.width, index.sizes
    # Without the tables, which tasks have no use for.
    routing = replace(index, vectors=None, filed=None)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, SLICE):
            row, part = routing.routes(_matrix(batch.column("vector"), width), k)
            yield batch.take(pa.array(row)).append_column("part", pa.array(part, pa.int32()))

    schema = "id long, vector array<double>, part int"
    queries = staged(spark, index.vectors.filter(is_query).mapInArrow(route, schema), "routed-queries")
    asked = _per_part(queries, len(sizes))
    blocks = _array(np.maximum(1, -(-sizes // block)))
    query_blocks = _array(np.maximum(1, -(-asked // query_block)))

    def dealt(df: DataFrame, own: Column, others: Column, mine: str, theirs: str) -> DataFrame:
        count, repeat = (F.element_at(numbers, F.col("part") + 1) for numbers in (own, others))
        return df.withColumn(mine, F.pmod(F.xxhash64("id"), count).cast("int")).withColumn(
            theirs, F.explode(F.sequence(F.lit(0), repeat - 1))
        )

    left = dealt(index.filed, blocks, query_blocks, "block", "asked")
    right = dealt(queries, query_blocks, blocks, "asked", "block")

    def search(one: pa.Table, two: pa.Table) -> pa.Table:
        ids, asked_ids = one.column("id").to_numpy(), two.column("id").to_numpy()
        found_ids, found_scores = [], []
        if len(ids) and len(asked_ids):
            vectors = _matrix(one.column("vector").combine_chunks(), width)
            wanted = _matrix(two.column("vector").combine_chunks(), width)
            for low in range(0, len(wanted), 256):
                scores = wanted[low : low + 256] @ vectors.T
                scores[asked_ids[low : low + 256, None] == ids] = -np.inf
                for q, own in enumerate(scores, low):
                    got, score = _best(own, wanted[q], vectors, ids, k + 1)
                    other = got != asked_ids[q]
                    found_ids.append(got[other][:k])
                    found_scores.append(score[other][:k])
        else:
            asked_ids = asked_ids[:0]
        return pa.table({
            "query_id": pa.array(asked_ids, pa.int64()),
            "ids": pa.array(found_ids, pa.list_(pa.int64())),
            "scores": pa.array(found_scores, pa.list_(pa.float64())),
        })

    keys = ["part", "block", "asked"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query_id long, ids array<long>, scores array<double>"
    )
    each = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("one")).select(
        "query_id", F.col("one.ids").alias("id"), F.col("one.scores").alias("score")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_column), "score"
    )
