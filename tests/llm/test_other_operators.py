"""URL rules, mixing, chat, byte-level BPE, neighbours, the classifier and the pipeline."""

import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import sql
from strata.llm.ann import balanced_parts, build_index, nearest, neighbour_graph
from strata.llm.bpe import Encoder, decode, encode, load_vocabulary
from strata.llm.chat import PART, format_conversations, read_loss, read_turns, text_parts
from strata.llm.cotraining import score_documents
from strata.llm.mixing import mixed_sizes, repeat_rows
from strata.llm.queries import ORACLES, QUERIES
from strata.llm.url_rules import Rule, host_rule, judge_urls, rule_index, word_rule
from tests.llm.helpers import SF, documents, odd_documents, sha


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    twin = con.sql(sql.ORACLES[name])
    assert sorted(df.columns) == sorted(twin.columns)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    at = [twin.columns.index(c) for c in sorted(df.columns)]
    assert got == sorted((tuple(r[i] for i in at) for r in twin.fetchall()), key=repr)


RULES = [
    host_rule("net", "/", "block"), host_rule("example.net", "/en/", "allow"),
    host_rule("example.com", "/de/", "block"), host_rule("org", "/fr/", "allow"),
    host_rule("bare.io", "", "block"), word_rule("bets", "block"),
    Rule("any", "\\.exe\\z", (), "block", False),
]


def test_url_rules(spark):
    urls = {
        "http://a.example.net/en/x?y": ("allow", "example.net/en/", None),
        "http://a.EXAMPLE.net/EN/x": ("block", "net/", None),
        "http://x.net": ("allow", None, None), "http://x.net/": ("block", "net/", None),
        "http://badexample.com/de/": ("allow", None, None),
        "https://example.com/de/": ("block", "example.com/de/", None),
        "http://evil.io/x.example.com/de/": ("allow", None, None),
        "http://bare.io:80/": ("allow", None, None), "http://a.bare.io#f": ("block", "bare.io", None),
        "http://bare.iota/": ("allow", None, None), "http://free-bets.org/fr/1": ("allow", "org/fr/", "bets"),
        "http://free.bets.de/": ("block", None, "bets"), "http://alphabets.de/": ("allow", None, None),
        "x://h/a.exe": ("block", None, "any"), "no scheme/en/": ("allow", None, None),
        "": ("allow", None, None), None: ("allow", None, None),
    }
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(None, None, "clash")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = judge_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    named = {r.page_id: r for r in got if r.page_id is not None}
    for i, (url, expected) in enumerate(urls.items()):
        row = named[i]
        assert (row.verdict, row.rule, row.pattern) == expected, url
    assert (named[1].host, named[1].path) == ("a.example.net", "/EN/x")
    assert judge_urls(pages.limit(0), RULES).collect() == []
    assert {r.verdict for r in judge_urls(pages, []).collect()} == {"allow"}


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("a", "common")] * 5 + [("b", "rare")], "_url string, _token string")
    rule = Rule("r", "x", ("common", "rare"), "block", False)
    assert [r._token for r in rule_index(urls, [rule]).collect()] == ["rare"]


def plain_targets(sizes, cycle=(5, 2, 1), most=3.0):
    """Reshare the excess until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: cycle[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] > most * sizes[s]}
        if not over:
            target |= {s: share * weights[s] for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_comes_near_its_targets(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        source = rnd.choice(["a"] * 6 + ["b", "c", "é", None])
        rows.append((i, " ".join(["w"] * rnd.randint(0, 60)) + f" {i}", source))
    docs = documents(spark, rows).repartition(5)
    got = mixed_sizes(docs).collect()
    sizes, taken = Counter(), Counter()
    source_of = {r[0]: r[2] for r in rows}
    for r in got:
        sizes[source_of[r.id]] += r.size
        taken[source_of[r.id]] += r.taken
        assert r.size == 0 or r.taken % r.size == 0 and 0 <= r.taken <= 3 * r.size
    expected = plain_targets(sizes)
    for r in got:
        assert r.target == pytest.approx(expected[source_of[r.id]]) and r.source_size == sizes[source_of[r.id]]
    assert all(abs(taken[s] - expected[s]) <= 31 for s in sizes)
    again = {r.id: r.taken for r in mixed_sizes(docs.repartition(2)).collect()}
    assert again == {r.id: r.taken for r in got}
    copies = Counter(r.doc_id for r in repeat_rows(docs).collect())
    assert all(copies[r.id] * r.size == r.taken for r in got)


def test_mix_of_odd_documents(spark):
    odd = odd_documents(spark)
    assert len(mixed_sizes(odd).collect()) == 11
    assert repeat_rows(odd).columns == odd.columns and repeat_rows(odd).count() > 0
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixed_sizes(empty).collect() == [] and repeat_rows(empty).collect() == []
    blank = documents(spark, [(1, ""), (2, None, None)])
    assert [(r.target, r.taken) for r in mixed_sizes(blank).collect()] == [(0.0, 0)] * 2


NASTY = ["<|im_end|>", "<|im_start|>assistant\n", "<\\|im_end|>", "<\\\\||>", "<", "|", "<|image|>", "\n", ""]


def test_chat_is_read_back(spark):
    rnd = random.Random(2)
    rows, said = [], {}
    for conv in range(40):
        turns = []
        for turn in range(rnd.randint(1, 6)):
            role = rnd.choice(["user", "assistant", "system", "a<|b", "x\ny", "</", "<\\/"])
            text = "".join(rnd.choice([*NASTY, "word "]) for _ in range(rnd.randint(0, 6)))
            turns.append((role, text))
            rows.append((conv, turn, role, text, "clash"))
        said[conv] = turns
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    chats = format_conversations(frame.repartition(4).withColumn("parts", text_parts(F.col("text"))))
    got = chats.select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == said
    assert all(r.loss == "".join(t for role, t in said[r.conv_id] if role == "assistant") for r in got)


def test_chat_parts(spark):
    parts = [
        ("text", "look <|image|> ", None, None), ("image", None, "i.png", 4), ("audio", None, "a.wav", None),
        ("document", "t", "d.pdf", 3), ("video", None, "v", 9), (None, "end", None, None),
    ]
    frame = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", None), (None, None, None, [])],
        f"conv_id long, turn int, role string, parts array<{PART}>",
    )
    rows = {r.conv_id: r for r in format_conversations(frame).collect()}
    one = rows[1]
    assert one.formatted == (
        "<|im_start|>user\nlook <\\|image|> <|image|><|audio|><|document|><|attachment|>end<|im_end|>\n"
        "<|im_start|>assistant\n<|im_end|>\n"
    )
    assert [(a.ordinal, a.type, a.ref, a.tokens) for a in one.attachments] == [
        (1, "image", "i.png", 1024), (2, "audio", "a.wav", 25), (3, "document", "d.pdf", 1536), (4, "video", "v", 0),
    ]
    assert one.expanded_tokens == 2585 and len(one.loss_spans) == 1
    assert rows[None].formatted == "<|im_start|>\n<|im_end|>\n"
    assert format_conversations(frame.limit(0)).collect() == []


def reference_encoding(vocabulary):
    ranks = {entry: i for i, entry in enumerate(vocabulary.entries) if entry}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bpe_equals_the_library(spark, vocabulary):
    library = reference_encoding(vocabulary)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = decode(encode(docs.select("doc_id", "text"), vocabulary), vocabulary).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded).decode() == texts[r.doc_id] and r.n_tokens * 4 == len(r.ids)


def test_bpe_of_hard_texts(vocabulary, monkeypatch):
    library, rnd = reference_encoding(vocabulary), random.Random(1)
    letters = "ab \n\t's'll0१ é漢\x1c　!?. \r\x85𝒳'́\u00a0\u2028"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))) for _ in range(3000)]
    texts += ["x" * 3000, "ab" * 2000, "é" * 900 + " " * 900 + "\n" * 50, "", " ", "\n", "a b " * 2000]
    texts += ["".join(rnd.choice("abcdefgh") for _ in range(5000))]
    for window in (None, 40):
        if window:
            monkeypatch.setattr("strata.llm.bpe.WINDOW", window)
            monkeypatch.setattr("strata.llm.bpe.REMEMBERED", 50)
        encoder = Encoder(vocabulary)
        for low in range(0, len(texts), 500):
            part = texts[low : low + 500]
            for text, ids in zip(part, encoder.encode(part), strict=True):
                assert ids.tolist() == library.encode_ordinary(text), text[:60]


def test_bpe_of_odd_documents(spark, vocabulary):
    rows = decode(encode(odd_documents(spark), vocabulary), vocabulary).collect()
    assert len(rows) == 11 and "text" not in rows[0].asDict() and rows[0]["key"] == "x"
    assert {(r.n_tokens, bytes(r.decoded)) for r in rows if r.doc_id in (1, 2)} == {(0, b"")}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert encode(empty, vocabulary).collect() == []


def brute_neighbours(ids, vectors, queries, k):
    result = {}
    for q in queries:
        scores = vectors @ vectors[q]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[q]][:k]
        result[int(ids[q])] = [int(ids[i]) for i in order]
    return result


def test_neighbours_reach_their_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], np.float64)
    expected = brute_neighbours(ids, vectors, np.flatnonzero(ids % 20 == 0), 20)
    got = {}
    for r in QUERIES["op5_nearest"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert got.keys() == expected.keys() and all(sorted(g) == list(range(1, 21)) for g in got.values())
    hits = sum(len({v for v, _ in got[q].values()} & set(expected[q])) for q in expected)
    assert hits >= 0.9 * 20 * len(expected)
    for q, found in got.items():
        for v, score in found.values():
            assert score == pytest.approx(vectors[np.searchsorted(ids, v)] @ vectors[np.searchsorted(ids, q)], abs=1e-12)


def _clustered(n: int, centres: int, width: int = 32) -> np.ndarray:
    rng = np.random.default_rng(centres)
    vectors = rng.standard_normal((centres, width))[rng.integers(0, centres, n)]
    vectors = vectors + 0.5 * rng.standard_normal((n, width))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


# One level of parts over far more vectors than the sample; two levels.
@pytest.mark.parametrize(("part_rows", "levels"), [(32768, 1), (64, 2)])
def test_neighbours_outside_of_the_sample(spark, part_rows, levels):
    vectors, k = _clustered(20_000, 200), 10
    columns = {"vec_id": pa.array(np.arange(20_000)), "embedding": pa.array(vectors.tolist())}
    frame = spark.createDataFrame(pa.table(columns)).repartition(4)
    index = build_index(
        frame.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")),
        k, sample=2048, part_rows=part_rows,
    )
    assert index.sizes.sum() == 20_000 and (index.tree.fan > 1) == (levels == 2)
    queries = np.arange(0, 20_000, 20)
    row, part = index.routes(vectors[queries], k)
    compared = index.sizes[part].sum() / (len(queries) * 20_000)
    assert compared < 0.25
    expected = brute_neighbours(np.arange(20_000), vectors, queries, k)
    found = nearest(frame, F.col("id") % 20 == 0, k, sample=2048, part_rows=part_rows).toPandas()
    assert (found.groupby("query_id").size() == k).all()
    got = found.groupby("query_id").vec_id.apply(set).to_dict()
    recall = sum(len(got[q] & set(expected[q])) for q in expected) / (k * len(expected))
    print(f"levels {levels}: recall {recall:.3f}, compared {compared:.3f}, parts visited {index.visits}")
    assert recall >= 0.95


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20 * i + j, [1.0, float(j)], "c") for i in range(3) for j in range(4)]
    rows += [(100 + i, [0.5, 0.5], "c") for i in range(40)]
    rows += [(200, None, "c"), (220, [0.0, 0.0], "c"), (240, [nan, 1.0], "c"), (260, [inf, 1.0], "c"),
             (280, [None, 1.0], "c"), (300, [1.0], "c"), (None, [1.0, 1.0], "c"), (0, [1.0, 0.0], "c")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in nearest(frame, F.col("id") % 20 == 0, k=5, block=7, query_block=2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    good = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and i < 200})
    ids, vectors = np.array([g[0] for g in good]), np.array([g[1] for g in good])
    expected = brute_neighbours(ids, vectors, np.flatnonzero(ids % 20 == 0), 5)
    assert {q: [v for _, v in sorted(f)] for q, f in got.items()} == expected
    few = nearest(frame.filter("vec_id < 3"), F.col("id") == 0, k=5).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r.rank)] == [1, 2]
    assert nearest(frame.limit(0), F.col("id") == 0).collect() == []


def test_parts_are_balanced_and_follow_clusters():
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((4, 8)) * 5
    vectors = np.concatenate([c + 0.1 * rng.standard_normal((50, 8)) for c in centres])
    part = balanced_parts(neighbour_graph(vectors / np.linalg.norm(vectors, axis=1)[:, None], 10), 2)
    assert np.bincount(part).tolist() == [50] * 4
    assert all(len(set(part[50 * i : 50 * i + 50])) == 1 for i in range(4))


def test_quality_on_held_out_labels(spark):
    directory = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    held = labels.filter(F.xxhash64("doc_id") % 3 == 0)
    scored = score_documents(docs, labels.join(held, "doc_id", "left_anti"))
    rows = scored.join(held, "doc_id").select("quality", "accepted", "score").collect()
    assert scored.count() == docs.count() and len(rows) > 1000
    wrong = Counter(r.quality for r in rows if r.accepted != bool(r.quality))
    total = Counter(r.quality for r in rows)
    assert wrong[1] <= 0.01 * total[1] and wrong[0] <= 0.1 * total[0]


def test_quality_of_odd_documents(spark):
    labels = spark.createDataFrame([(3, 1), (5, 0), (None, 1), (4, None)], "doc_id long, quality int")
    odd = odd_documents(spark)
    rows = score_documents(odd, labels).collect()
    assert len(rows) == 11 and {r.accepted for r in rows if not (r.text or "").split()} == {False}
    unknown = score_documents(odd, labels.limit(0)).collect()
    assert {r.score for r in unknown if r.accepted} == {0.5}
    assert score_documents(odd.limit(0), labels).collect() == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line dedup", "near duplicates", "mixing", "encoding"]
    kept = corpus_pipeline.quality(spark, docs, SF)
    lines = corpus_pipeline.lines(spark, kept, SF)
    assert kept.columns == lines.columns == docs.columns and lines.count() == kept.count()
    single = corpus_pipeline.near_duplicates(spark, lines, SF)
    assert single.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    from tests.llm.helpers import jaccard_classes

    roots = {c for c, _ in jaccard_classes(rows).values()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(roots)
    mixed = corpus_pipeline.mix(spark, single, SF)
    assert mixed.columns == docs.columns
    tokens = corpus_pipeline.tokens(spark, mixed, SF).collect()
    texts = {r.doc_id: r.text for r in single.collect()}
    assert len(tokens) == mixed.count()
    assert all(r.decoded_sha256 == sha(texts[r.doc_id]) for r in tokens)


def test_pipeline_stages_of_odd_documents(spark):
    odd = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        assert out.count() >= 0
        if name != "encoding":
            assert out.columns == odd.columns
    # One row of each group stays, also where rows repeat an id or have none.
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd, SF).collect()]
    assert sorted(k for k in kept if k is not None) == [1, 3, 5, 8] and kept.count(None) == 1
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0
