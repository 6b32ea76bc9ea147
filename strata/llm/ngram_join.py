"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; two are linked where the Jaccard similarity of their
sets is at least the threshold. Documents with the same words in the same order are copies and
go on as one class. Every class has a MinHash signature; classes that agree in a band of it
meet in a bucket, and buckets with the same members count once. Within a bucket, signatures
are compared a few values at a time; after each step a pair is dropped whose posterior
probability of reaching the threshold, given the matches so far and a uniform prior, is below
the tolerance. Classes that remaining pairs connect, directly or over others, are verified
exactly: the intersections of their shingle sets are counted as a product of incidence
matrices. Large buckets and connected groups are cut into blocks, and a task gets two blocks,
so that no group meets in one task.

With the default bands a pair at the threshold is missed by all of them with probability
3e-6, the tolerance adds less than 1e-6; more similar pairs far less.

Cases: words are runs of other than ASCII white space, unchanged. A document of one to four
words has one shingle, all of its words; documents without words (null text too) are copies of
one another. Rows, not ids, are documents: rows that repeat an id with the same words are copies,
with other words they are documents of their own, with classes and links of their own. Classes
are numbered by their least id. A class whose rows have no id, and of the classes with the same
least id all but the one with the least digest, get a number below zero, made from the digest of
their words; a group is then named by the least of its classes' numbers. Other columns are
ignored. An empty table gives an empty result. Words and shingles are compared by 64-bit hashes,
texts as a whole by 128 bits. Very long texts are read in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.batches import bound_batches
from strata.llm.components import components
from strata.llm.suspects import bloom_filter, filter_bits, suspected
from strata.llm.words import WordReader, Words, mix, windows
from strata.session import staged

SHINGLE, THRESHOLD = 5, Fraction(4, 5)
BANDS, ROWS = 24, 4
# Signature values compared between two looks at the posterior, and its least value.
STEP, TOLERANCE = 8, 1e-8
# Members of a block: of a bucket, where signatures are compared, and of a connected group,
# where texts are.
BUCKET_BLOCK, TEXT_BLOCK = 2048, 1024
# Bytes of text that a task verifies at once, and columns of a matrix.
AT_ONCE, COLUMNS = 8 << 20, 4096
# Stands for a null id in the filter of wanted rows.
NO_ID = 2**63 - 1


def needed_matches(threshold: float, tolerance: float, hashes: int, step: int) -> list[int]:
    """Least number of matches after 1, 2 ... steps for a pair to stay.

    With a uniform prior the similarity after m of n matches is Beta(m + 1, n - m + 1); its
    tail above t is the chance of at most m successes in n + 1 trials of probability t.
    """
    needed = []
    for n in range(step, hashes + 1, step):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        needed.append(m)
    return needed


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a slice, and the number before each text."""
    runs, inside = windows(words.hashes, words.offsets, size)
    counts = np.diff(words.offsets)
    place = np.flatnonzero(inside)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return runs[place], np.searchsorted(place, words.offsets)
    own, _ = sequence_digests(words)
    values = np.concatenate([runs[place], own[short]])
    at = np.concatenate([place, words.offsets[short]])
    order = np.argsort(at, kind="stable")
    return values[order], np.searchsorted(at[order], words.offsets)


def sequence_digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the sequence of words of each text; 0 for no words."""
    place = (np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], np.diff(words.offsets)))
    place = mix(place.astype(np.uint64) + np.uint64(1))
    result = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        values = mix((words.hashes ^ np.uint64(salt)) + place * np.uint64(salt | 1))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
        result.append(total[words.offsets[1:]] - total[words.offsets[:-1]])
    return result[0], result[1]


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return numbers[:n] | np.uint64(1), numbers[n:]


def signatures(values: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """MinHash values per text, one row each; a text without shingles has the largest ones."""
    result = np.full((len(offsets) - 1, n), np.iinfo(np.uint64).max, np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        for i, (a, b) in enumerate(zip(*_factors(n), strict=True)):
            result[full, i] = np.minimum.reduceat(values * a + b, offsets[full])
    return result


def sketches(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """id, d1, d2 (what the words are), signature (16 bits a value) and band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            for words in reader.read(batch.column("text")):
                values, offsets = shingles(words, size)
                least = signatures(values, offsets, bands * rows)
                one, two = sequence_digests(words)
                keys = np.zeros((len(least), bands), np.uint64)
                for i in range(rows):
                    keys = mix(keys + least[:, i::rows])
                keys = mix(keys + np.arange(bands, dtype=np.uint64))
                short = mix(least).astype("<u2")
                ids = batch.column("id").slice(words.first, words.last - words.first)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.array([row.tobytes() for row in short], pa.binary()),
                     pa.ListArray.from_arrays(
                         np.arange(0, keys.size + 1, bands, dtype=np.int32),
                         keys.ravel().view(np.int64))],
                    names=["id", "d1", "d2", "signature", "bands"],
                )

    return docs.mapInArrow(run, "id long, d1 long, d2 long, signature binary, bands array<long>")


def _row_keys(d1: np.ndarray, ids: pa.Array) -> np.ndarray:
    """What a row's text and id say together, as one number."""
    numbers = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).view(np.uint64)
    return mix(d1.view(np.uint64) ^ mix(numbers))


def texts_of(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """id, d1, d2 and text of the rows that ``groups`` (d1, least) name, and a few others.

    A Bloom filter of the wanted rows keeps all other texts out of the join that follows.
    """

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            if batch.num_rows:
                yield _row_keys(batch.column("d1").to_numpy(), batch.column("least"))

    held = bloom_filter(groups.select("d1", "least"), wanted, filter_bits(groups.count()), times=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            found = [sequence_digests(words) for words in reader.read(batch.column("text"))]
            digests = [np.concatenate(d).view(np.int64) for d in zip(*found, strict=True)]
            if digests:
                rows = pa.RecordBatch.from_arrays(
                    [batch.column("id"), *map(pa.array, digests), batch.column("text")],
                    names=["id", "d1", "d2", "text"],
                )
                keys = _row_keys(digests[0], batch.column("id"))
                yield rows.filter(pa.array(suspected(keys, held.value)))

    return docs.mapInArrow(run, "id long, d1 long, d2 long, text string")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member that each of n members is connected with."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def likely_pairs(
    a: np.ndarray, b: np.ndarray, same: bool, needed: list[int], step: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b that stay when their signatures are compared step by step."""
    keep_a, keep_b = [], []
    # A stripe of rows of a at a time bounds the pairs in memory.
    stripe = max(1, (1 << 20) // max(len(b), 1))
    for low in range(0, len(a), stripe):
        i, j = np.meshgrid(np.arange(low, min(low + stripe, len(a))), np.arange(len(b)), indexing="ij")
        i, j = i.ravel(), j.ravel()
        if same:
            i, j = i[i < j], j[i < j]
        matches = np.zeros(len(i), np.int16)
        for turn, least in enumerate(needed):
            part = slice(turn * step, (turn + 1) * step)
            matches += (a[i, part] == b[j, part]).sum(axis=1, dtype=np.int16)
            stay = matches >= least
            if not stay.all():
                i, j, matches = i[stay], j[stay], matches[stay]
        keep_a.append(i)
        keep_b.append(j)
    return np.concatenate(keep_a), np.concatenate(keep_b)


def _block_pairs(members: DataFrame, group: str, size: Column, block: int) -> DataFrame:
    """Rows dealt to pairs of blocks of their group: lo, hi, and the block they are of."""
    blocks = F.ceil(size / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64("node", group), blocks).cast("int")
    dealt = members.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    return dealt.withColumn("lo", F.least("mine", "other")).withColumn(
        "hi", F.greatest("mine", "other")
    ).drop("other")


def _by_group(batches: Iterator[pa.RecordBatch], group: str, most: int) -> Iterator[pa.Table]:
    """Tables of whole groups from sorted batches, of about ``most`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            end = int(_group_edges(table, group)[-2])
            if end:
                yield table.slice(0, end)
            held = table.slice(end).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _group_edges(table: pa.Table, group: str) -> np.ndarray:
    keys = np.stack([table.column(c).to_numpy() for c in (group, "lo", "hi")])
    return np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1,
                           [table.num_rows]])


def likely_edges(classes: DataFrame, bands: int, needed: list[int], block: int) -> DataFrame:
    """Edges that connect all classes of pairs that stay, at most one per member and task."""
    spark = classes.sparkSession
    each = classes.select("node", F.explode("bands").alias("bucket"))
    member = F.xxhash64("node"), F.xxhash64("node", F.lit(1))
    shared = each.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), *[F.bit_xor(m).alias(f"m{i}") for i, m in enumerate(member)]
    ).filter("size > 1").groupBy("size", "m0", "m1").agg(F.min("bucket").alias("bucket"))
    shared = staged(spark, shared.select("bucket", "size"), "buckets")
    members = staged(spark, each.join(shared, "bucket"), "bucket-members")
    signed = members.join(classes.select("node", "signature"), "node")
    dealt = _block_pairs(signed, "bucket", F.col("size"), block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_group(batches, "bucket", AT_ONCE):
            nodes, mine = (table.column(c).to_numpy() for c in ("node", "mine"))
            lo, hi = (table.column(c).to_numpy() for c in ("lo", "hi"))
            raw = table.column("signature").to_pylist()
            values = np.frombuffer(b"".join(raw), "<u2").reshape(len(raw), -1)
            edges = _group_edges(table, "bucket")
            found_a, found_b = [], []
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if last - first < 2:
                    continue
                rows = np.arange(first, last)
                same = lo[first] == hi[first]
                one = rows if same else rows[mine[rows] == lo[first]]
                two = rows if same else rows[mine[rows] == hi[first]]
                if not len(one) or not len(two):
                    continue
                a, b = likely_pairs(values[one], values[two], same, needed, STEP)
                root = _roots(last - first, one[a] - first, two[b] - first)
                moved = np.flatnonzero(root != np.arange(last - first))
                found_a.append(nodes[first + moved])
                found_b.append(nodes[first + root[moved]])
            if found_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))],
                    names=["a", "b"],
                )

    return dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi").select(
        "bucket", "lo", "hi", "mine", "node", "signature"
    ).mapInArrow(run, "a long, b long")


def intersections(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of the first ``split`` sets with the others.

    With ``split`` 0, of all sets with all.
    """
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles of one set are in no intersection.
    number = np.cumsum(counts > 1) - 1
    shared = counts[column] > 1
    row, column = row[shared], number[column[shared]]
    n, total = len(sets), int((counts > 1).sum())
    result = np.zeros((split or n, n - split), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    edges = np.searchsorted(column, np.arange(0, total + COLUMNS, COLUMNS))
    for turn, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        held = np.zeros((n, min(COLUMNS, total - turn * COLUMNS)), np.float32)
        held[row[low:high], column[low:high] - turn * COLUMNS] = 1
        result += held[: split or n] @ held[split:].T
    return result


def verified(
    members: DataFrame, size: int, threshold: Fraction, block: int, with_partners: bool = False
) -> DataFrame:
    """Exact links within connected groups: node, links, root, and partners where asked for.

    ``members``: group, members (number of nodes of the group), node, copies, d1, text. A row of
    the result is about the partners in one pair of blocks: the number of documents in them,
    a node that they connect with, and their nodes, which are as many as there are links.
    """
    fields = ["node long", "links long", "root long"] + ["partners array<long>"] * with_partners
    dealt = _block_pairs(members, "group", F.col("members"), block)
    up, down = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for table in _by_group(batches, "group", AT_ONCE):
            nodes, copies, d1 = (table.column(c).to_numpy() for c in ("node", "copies", "d1"))
            mine, lo, hi = (table.column(c).to_numpy() for c in ("mine", "lo", "hi"))
            sets: list[np.ndarray] = []
            for words in reader.read(table.column("text").combine_chunks()):
                values, offsets = shingles(words, size)
                sets += [np.unique(part) for part in np.split(values, offsets[1:-1])]
            sizes = np.array([len(s) for s in sets], np.float64)
            edges = _group_edges(table, "group")
            columns: list[list] = [[], [], [], []]
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                # Rows that repeat an id and its text are one member.
                rows = first + np.unique(d1[first:last], return_index=True)[1]
                if lo[first] != hi[first]:
                    rows = np.concatenate([rows[mine[rows] == lo[first]], rows[mine[rows] == hi[first]]])
                    split = int((mine[rows] == lo[first]).sum())
                    if split in (0, len(rows)):
                        continue
                else:
                    split = 0
                common = intersections([sets[r] for r in rows], split).astype(np.float64)
                one, two = rows[: split or len(rows)], rows[split:]
                union = sizes[one][:, None] + sizes[two] - common
                linked = common * down >= union * up
                if not split:
                    np.fill_diagonal(linked, False)
                a, b = np.nonzero(linked)
                root = _roots(last - first, one[a] - first, two[b] - first) + first
                sides = [(one, linked, two)] + ([(two, linked.T, one)] if split else [])
                for own, links, others in sides:
                    weight = links @ copies[others]
                    for k in np.flatnonzero(weight).tolist():
                        columns[0].append(nodes[own[k]])
                        columns[1].append(weight[k])
                        columns[2].append(nodes[root[own[k] - first]])
                        if with_partners:
                            columns[3].append(nodes[others[links[k]]])
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]]
            if with_partners:
                arrays.append(pa.array(columns[3], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in fields])

    return dealt.repartition("group", "lo", "hi").sortWithinPartitions("group", "lo", "hi").select(
        "group", "lo", "hi", "mine", "node", "copies", "d1", "text"
    ).mapInArrow(run, ", ".join(fields))


def named(classes: DataFrame) -> DataFrame:
    """``classes`` (d1, d2, least and more) with a number of their own, ``node``."""
    spark = classes.sparkSession
    shared = classes.filter("least is not null").groupBy("least").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("d1", "d2")).alias("first")
    ).filter("n > 1").select(F.col("least").alias("of"), "first")
    shared = staged(spark, shared, "shared-ids")
    made = -F.shiftrightunsigned(F.xxhash64("d1", "d2"), 1) - 1
    if shared.isEmpty():
        return classes.withColumn("node", F.coalesce("least", made))
    own = F.col("first").isNull() | (F.struct("d1", "d2") == F.col("first"))
    joined = classes.join(shared, F.col("least") == F.col("of"), "left")
    joined = joined.withColumn("node", F.when(F.col("least").isNotNull() & own, F.col("least")).otherwise(made))
    return staged(spark, joined.drop("of", "first"), "named-classes")


def join_near(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    threshold: Fraction = THRESHOLD,
    bucket_block: int = BUCKET_BLOCK,
    text_block: int = TEXT_BLOCK,
    with_partners: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows: id, class_id, copy_id, n_copies, n_links; and links between copy classes.

    ``class_id`` is the least id that links, directly or over others, connect a document with;
    ``copy_id`` the least id with the same words; ``n_links`` the number of other documents
    that a document is linked with, copies counted. The second frame is made where partners are
    asked for: ``copy_id`` and ``partners``, the copy ids linked with it, each pair from both
    sides. It has a number per link, so it grows with the square of a group of different texts.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    sketched = staged(spark, sketches(rows, size, BANDS, ROWS), "sketches")
    classes = named(staged(spark, sketched.groupBy("d1", "d2").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"),
        F.any_value("signature").alias("signature"), F.any_value("bands").alias("bands"),
    ), "classes"))
    needed = needed_matches(float(threshold), TOLERANCE, BANDS * ROWS, STEP)
    near = components(likely_edges(classes, BANDS, needed, bucket_block))
    near = staged(spark, near, "connected")
    sizes = near.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    groups = near.join(sizes, "component").withColumnRenamed("component", "group")
    groups = staged(
        spark, groups.join(classes.select("node", "least", "copies", "d1", "d2"), "node"), "groups"
    )
    # Of a class, the rows with its least id; what they say must be of the class, too.
    texts = texts_of(rows, groups)
    members = groups.join(texts, ["d1", "d2"]).filter(F.col("id").eqNullSafe(F.col("least")))
    found = staged(spark, verified(members, size, threshold, text_block, with_partners), "links")
    classed = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links")).join(classed, "node", "left")
    links = staged(spark, links, "linked")
    known = classes.select("d1", "d2", "node", "copies").join(links, "node", "left")
    known = staged(spark, known, "known-classes")
    result = sketched.select("id", "d1", "d2").join(known, ["d1", "d2"]).select(
        F.col("id").alias(id_column),
        F.coalesce("component", "node").alias("class_id"), F.col("node").alias("copy_id"),
        F.col("copies").alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
    )
    partners = found.select(F.col("node").alias("copy_id"), "partners") if with_partners else None
    return result, partners
