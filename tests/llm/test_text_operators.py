"""Line, substring and exact dedup, and the n-gram join, against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm.exact_dedup import ambiguous, group_copies
from strata.llm.line_dedup import dedup_lines
from strata.llm.ngram_join import join_near, needed_matches
from strata.llm.queries import QUERIES
from strata.llm.substring_dedup import (
    Found,
    dedup_substrings,
    first_of_equals,
    tree_marks,
    word_ranks,
)
from strata.llm.suspects import bloom_filter, filter_bits, repeated_filter, suspected
from strata.llm.words import WordReader
from tests.llm.helpers import SF, documents, jaccard_classes, odd_documents, removed_words, sha

EMPTY = "doc_id long, text string, source string"


def texts_of(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def plain_lines(rows, least=10):
    def key(line):
        line = line.strip(" \t\n\v\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    result = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(key(x)) < least or len(holders[key(x)]) == 1 or min(holders[key(x)]) == doc
        ]
        result[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return result


def test_lines_equal_the_plain_version(spark):
    rows = [
        (1, "Shared line here\nshort\nown of one"), (2, "  SHARED LINE HERE\t\nshort\nÉcole à côté"),
        (3, "shared line here\nshared line here\nécole à côté\nécole à côtÉ"), (4, None), (5, ""),
        (6, "123456789é\nx"), (7, "123456789É\n123456789é"), (8, "abcdefghi\n"), (9, "abcdefghi"),
    ]
    got = dedup_lines(documents(spark, rows).repartition(3)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got} == plain_lines(rows)


def test_lines_of_odd_documents(spark):
    got = dedup_lines(odd_documents(spark)).collect()
    assert len(got) == 11 and "kept" in got[0].asDict()
    # The row without an id comes after all others, and rows of one id are one document.
    clash = documents(spark, [(None, "a line of text"), (5, "a line of text"), (5, "a line of text")])
    assert sorted((r.doc_id or 0, r.text) for r in dedup_lines(clash).collect()) == [
        (0, ""), (5, "a line of text"), (5, "a line of text"),
    ]
    assert dedup_lines(spark.createDataFrame([], EMPTY)).collect() == []


@pytest.fixture
def small_filters(monkeypatch):
    """Filters of at most 2^14 bits, good for 2 048 keys."""
    for name, value in (("SEGMENT_BITS", 10), ("LEAST_BITS", 1 << 10), ("MOST_BITS", 1 << 14)):
        monkeypatch.setattr(f"strata.llm.suspects.{name}", value)


def test_more_keys_than_a_filter_serves(spark, small_filters):
    keys = np.random.default_rng(0).integers(0, 2**63, 20_500, dtype=np.uint64)
    rows = np.concatenate([keys, keys[:500]]).view(np.int64)
    frame = spark.createDataFrame(pa.table({"key": rows})).repartition(5)

    def read(batches):
        for batch in batches:
            yield batch.column("key").to_numpy().view(np.uint64)

    crowded = suspected(keys, bloom_filter(frame, read, filter_bits(len(rows))).value)
    sharp = suspected(keys, repeated_filter(frame, read, len(rows)).value)
    assert crowded[:500].all() and sharp[:500].all()
    assert crowded[500:].mean() > 0.5 and sharp[500:].mean() < 0.03


def test_small_filters_change_no_result(spark, small_filters):
    rows = [(i, "\n".join([f"own line {i} {j}" for j in range(90)] + [f"shared line {i % 9}"])) for i in range(40)]
    docs = documents(spark, rows).repartition(4)
    got = dedup_lines(docs).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got} == plain_lines(rows)
    got = dedup_substrings(docs, window=5, prefix=3).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, sha(r.kept)) for r in got} == removed_words(rows, 5)


def test_substrings_equal_the_plain_version(spark):
    rows = texts_of(spark)
    got = QUERIES["op7_substring_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == removed_words(rows)


@pytest.mark.parametrize("group", [1, 40])
def test_prefixes_are_lengthened_and_overlaps_found(spark, group):
    rnd = random.Random(group)
    passage = [f"p{i}" for i in range(45)]
    rows = []
    for doc in range(60):
        own = [rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(rnd.randint(0, 60))]
        at = rnd.randint(0, len(own))
        cut = rnd.randint(0, 20)
        rows.append((doc, " ".join(own[:at] + passage[cut : cut + rnd.randint(15, 25)] + own[at:])))
    rows += [(100, "x " * 50), (101, "x\n" * 30), (102, "y z " * 30), (103, None)]
    got = dedup_substrings(documents(spark, rows).repartition(9), group=group).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, sha(r.kept)) for r in got} == removed_words(rows)
    spans = {r.doc_id: [(s["from"], s["to"]) for s in r.removed] for r in got}
    assert spans[100] == [(1, 50)] and spans[101] == [(0, 30)]


def test_deep_nodes_give_maximal_repeats():
    """Lengths from the nodes of a suffix tree, against comparing all pairs of suffixes."""
    rnd = random.Random(8)
    for turn in range(40):
        rows = [[rnd.choice("ab" if turn % 2 else "abcdef") for _ in range(rnd.randint(3, 12))] for _ in range(12)]
        table = pa.table({
            "owner": pa.array([rnd.randint(0, 8) for _ in rows], pa.int64()),
            "digest": pa.array([0] * len(rows), pa.int64()),
            "first": pa.array([100 * i for i in range(len(rows))], pa.int32()),
            "n": pa.array([len(r) - 2 for r in rows], pa.int32()),
            "words": pa.array([" ".join(r).encode() for r in rows], pa.binary()),
        })
        suffixes = [(o, f + k, r[k:]) for o, f, r in zip(
            table["owner"].to_pylist(), table["first"].to_pylist(), rows, strict=True) for k in range(len(r) - 2)]
        covered_starts = set()
        for o, s, one in suffixes:
            for p, t, two in suffixes:
                if (p, t) < (o, s):
                    same = next((i for i, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))
                    covered_starts |= {(o, s + i) for i in range(same - 2)}
        got = tree_marks(table, WordReader(), 3).to_pylist()
        marked = {(r["owner"], i) for r in got for a, b in zip(r["runs"][::2], r["runs"][1::2]) for i in range(a, b)}
        assert marked == covered_starts, turn
        for r in got:  # runs are apart
            assert all(b < c for b, c in zip(r["runs"][1::2], r["runs"][2::2]))


def test_equal_hashes_of_different_words_are_told_apart(monkeypatch):
    words = next(iter(WordReader().read(pa.array(["one two one three-and-a-half two", "", "one"]))))
    ranks = word_ranks([words]).tolist()
    assert ranks[0] == ranks[2] == ranks[5] and ranks[1] == ranks[4] and len(set(ranks)) == 3
    words.hashes = words.hashes & np.uint64(0)
    weak = word_ranks([words]).tolist()
    assert weak == [0, 1, 0, 2, 1, 0]
    zero = np.zeros(3, np.int64)
    data = np.frombuffer(b"a b a  b c d", np.uint8)
    low, high = np.array([0, 4, 9]), np.array([3, 8, 12])
    found = Found(zero, np.arange(3), zero, zero.view(np.uint64), zero.view(np.uint64), low, high, data)
    assert first_of_equals(found, np.array([5])).tolist() == [True, False, True]


def test_substrings_of_odd_documents(spark):
    got = dedup_substrings(odd_documents(spark)).collect()
    assert len(got) == 11
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].kept == "" and by_id[7].n_words == 0
    # Repeated rows are not earlier than themselves; a null id is the last document.
    assert by_id[5].n_removed == 0 and by_id[6].n_removed == 30000
    same = " ".join(f"w{i}" for i in range(25))
    clash = documents(spark, [(None, same), (5, same), (5, same)])
    assert sorted((r.doc_id or 0, r.n_removed) for r in dedup_substrings(clash).collect()) == [
        (0, 25), (5, 0), (5, 0),
    ]
    assert dedup_substrings(spark.createDataFrame([], EMPTY)).collect() == []


def test_copies_with_weak_identifiers(spark):
    rows = [(i, f"text {i % 7} " + "filler. " * 200 + str(i % 7)) for i in range(30)] + [(40, None), (41, "")]
    docs = documents(spark, rows)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("_text"))
    assert ambiguous(texts, 64).isEmpty() and not ambiguous(texts, 2).isEmpty()
    expected = {}
    for doc, text in rows:
        same = [d for d, t in rows if (t or "") == (text or "")]
        expected[doc] = (max(same), len(same), doc == max(same), sha(text or ""))
    for bits in (64, 2):
        got = group_copies(docs, bits=bits).collect()
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == expected


def test_copies_of_odd_documents(spark):
    got = group_copies(odd_documents(spark)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got if r.doc_id in (1, 2, 3, 4)) == [
        (1, 2, 3), (2, 2, 3), (2, 2, 3), (3, 4, 2), (4, 4, 2),
    ]
    nameless = [r for r in got if r.doc_id is None]
    assert [(r.keep_id, r.group_size, r.kept) for r in nameless] == [(None, 2, True)] * 2
    assert group_copies(spark.createDataFrame([], EMPTY)).collect() == []


@pytest.mark.parametrize("blocks", [{}, {"bucket_block": 2, "text_block": 2}])
def test_links_equal_the_plain_version(spark, blocks):
    rnd = random.Random(3)
    rows = texts_of(spark)[:60]
    base = [f"t{rnd.randint(0, 400)}" for _ in range(120)]
    for doc in range(1000, 1040):  # near copies around the threshold, and exact ones
        own = list(base)
        for _ in range(rnd.randint(0, 4)):
            own[rnd.randrange(len(own))] = f"n{rnd.randint(0, 3)}"
        rows.append((doc, " ".join(own)))
    rows += [(2000, "a b c"), (2001, "a  b\nc"), (2002, "a b d"), (2003, ""), (2004, None)]
    result, links = join_near(documents(spark, rows), with_partners=True, **blocks)
    got = {r.doc_id: (r.class_id, r.n_links) for r in result.collect()}
    assert got == jaccard_classes(rows)
    pairs = {(r.copy_id, p) for r in links.collect() for p in r.partners}
    assert pairs and all((b, a) in pairs for a, b in pairs)


def test_links_of_odd_documents(spark):
    result, _ = join_near(odd_documents(spark))
    got = result.collect()
    assert len(got) == 11
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[4].class_id == 3 and by_id[6].class_id == 5 and by_id[7].class_id == 1
    nameless = [r for r in got if r.doc_id is None]
    assert nameless[0].class_id == nameless[1].class_id < 0 and nameless[0].n_links == 1
    empty, _ = join_near(spark.createDataFrame([], EMPTY))
    assert empty.collect() == []


LONG_TEXT = " ".join(f"w{i}" for i in range(60))


def near(n, base="w"):
    """A text like the one of ``base`` words, the n-th word changed."""
    return " ".join(f"n{n}" if i == n else f"{base}{i}" for i in range(60))


REPEATED_IDS = [
    [(1, LONG_TEXT), (2, near(1)), (2, "an unrelated text of seven words"), (3, near(70, "b")),
     (3, near(70, "d")), (4, near(2, "b")), (5, near(3, "d"))],
    [(10, LONG_TEXT), (10, near(3)), (11, near(50)), (11, near(50)), (None, near(55)), (None, "x y z")],
    [(7, LONG_TEXT), (7, LONG_TEXT), (7, "other words"), (7, "and more words"), (8, "other words")],
]


@pytest.mark.parametrize("rows", REPEATED_IDS)
def test_rows_that_share_an_id_are_documents_of_their_own(spark, rows):
    """Against brute force over rows, numbered as if each had an id of its own."""
    plain = jaccard_classes(list(enumerate(text for _, text in rows)))
    result, _ = join_near(documents(spark, rows))
    got = result.collect()
    assert sorted((r.doc_id or -1, r.n_links) for r in got) == sorted(
        (rows[i][0] or -1, links) for i, (_, links) in plain.items()
    )
    groups, wanted = {}, {}
    for r in got:
        groups.setdefault(r.class_id, []).append(r.doc_id or -1)
    for i, (root, _) in plain.items():
        wanted.setdefault(root, []).append(rows[i][0] or -1)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_posterior_keeps_pairs_at_the_threshold():
    needed = needed_matches(0.8, 1e-8, 96, 8)
    assert needed == sorted(needed) and needed[-1] < 0.6 * 96
    assert needed_matches(0.8, 0.5, 96, 8)[-1] > 70
