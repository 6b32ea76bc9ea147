from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import cotraining
from strata.llm.cotraining import KEPT_APART, ROUNDS, SURE, SURE_SHARE, calibrated, fit_view

TABLES = "/root/testdata/sf0.01"


def probability(odds):
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def plain_scores(rows, labels):
    """Both views, rounds and calibration over whole matrices; rows are (id, text, lang, source,
    two numbers from 0 to 1 made from the id)."""
    ids, texts, langs, sources, seven, eleven = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_pydict({"text": list(texts), "lang": list(langs), "source": list(sources)})
    content, layout, counts = cotraining.Features().read(batch)
    views, ids = (content, layout), np.array(ids)
    known = np.array([labels.get(i, -1) for i in ids.tolist()])
    order = np.argsort(ids)
    given = order[(known[order] >= 0) & (counts[order] > 0)]
    y = (known[given] > 0).astype(float)
    apart = np.arange(len(y)) % round(1 / KEPT_APART) == 0
    train, held = given[~apart], given[apart]
    added, goals = [[], []], [y[~apart], y[~apart]]
    open_ = (known < 0) & (counts > 0)

    def fit():
        return [fit_view(v[np.array([*train, *more], int)].copy(), g)
                for v, more, g in zip(views, added, goals, strict=True)]

    models = fit()
    for _ in range(ROUNDS):
        odds = [m.logits(v).astype(np.float64) for m, v in zip(models, views, strict=True)]
        for own, other in ((0, 1), (1, 0)):
            most = max(1, int(SURE_SHARE * open_.sum()))
            for kind, sign in ((1, 1), (0, -1)):
                value = sign * odds[own]
                sure = open_ & (value >= np.log(SURE / (1 - SURE)))
                places = np.floor(np.clip(value, -50, 50) * 64)
                # Whole buckets from the top, and of the one that is too large a share by id.
                left = most
                for place in sorted(set(places[sure]), reverse=True):
                    inside = np.flatnonzero(sure & (places == place))
                    if left < len(inside):
                        inside = inside[np.array(eleven)[inside] < left / len(inside)]
                    left -= min(left, int((sure & (places == place)).sum()))
                    open_[inside] = False
                    inside = inside[np.argsort(ids[inside])]
                    added[other] += inside.tolist()
                    goals[other] = np.append(goals[other], np.full(len(inside), kind))
                    if not left:
                        break
        models = fit()
    models = [calibrated(m, v[held], y[apart]) for m, v in zip(models, views, strict=True)]
    share = (y[apart].sum() + 1) / (len(held) + 2)
    odds = sum(m.logits(v) for m, v in zip(models, views, strict=True)) - np.log(share / (1 - share))
    return {i: (p if n else 0.0) for i, p, n in zip(ids.tolist(), probability(odds), counts, strict=True)}


def test_scores_equal_the_plain_version(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    spread = [F.pmod(F.xxhash64("doc_id", F.lit(n)), F.lit(1 << 30)) / F.lit(1 << 30) for n in (7, 11)]
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", *spread).collect()]
    plain = plain_scores(rows, {r.doc_id: r.quality for r in labels.collect()})
    got = {r.doc_id: (r.score, r.accepted) for r in cotraining.score_documents(docs.repartition(7), labels).collect()}
    assert got.keys() == plain.keys()
    assert max(abs(got[i][0] - p) for i, p in plain.items()) < 0.02
    assert sum(got[i][1] != (p >= 0.5) for i, p in plain.items()) == 0


def test_the_exchange_sees_the_whole_table(spark):
    """Shares of all open documents, whatever the number that a view is fitted on."""
    odds = F.randn(3) * 4
    scores = spark.range(40_000).select("id", odds.alias("content"), (F.randn(4) * 4).alias("layout"))
    sizes = {(r.view, r.kind): r["count"] for r in
             cotraining.sure_ones(scores).groupBy("view", "kind").count().collect()}
    assert abs(sizes["content", 1] - 2000) < 100 and abs(sizes["content", 0] - 2000) < 100
    assert abs(sizes["layout", 1] - 1800) < 100 and abs(sizes["layout", 0] - 1800) < 100
    # All alike: the share is taken by id.
    same = spark.range(40_000).select("id", F.lit(60.0).alias("content"), F.lit(0.0).alias("layout"))
    assert abs(cotraining.sure_ones(same).count() - 2000) < 150
    assert cotraining.sure_ones(same.limit(0)).count() == 0


@pytest.mark.parametrize("counts, most, expected", [
    ({5: 3, 4: 2, 1: 9}, 5, (4, 1.0)), ({5: 3, 4: 2}, 4, (4, 0.5)), ({5: 3}, 9, (5, 1.0)), ({}, 1, (0, 1.0)),
])
def test_cut_off(counts, most, expected):
    assert cotraining.cut_off(counts, most) == expected


def test_fitting_holds_one_matrix():
    """The sizes of the samples and of the content view, which driver memory must not lower."""
    assert min(cotraining.LABELLED, cotraining.EXCHANGED) >= 6000 and cotraining.TRIGRAMS >= 1024
    rng = np.random.default_rng(5)
    goal = (rng.random(3000) < 0.7).astype(np.float64)
    view = rng.standard_normal((3000, cotraining.TRIGRAMS + cotraining.CONTENT_STATS), np.float32)
    view[:, :8] += 2 * goal[:, None].astype(np.float32)
    tracemalloc.start()
    try:
        stacked = cotraining._stacked(view, np.arange(1500), [view[1500:2000], view[2000:]])
        fitted = fit_view(stacked, goal)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert ((fitted.logits(view) >= 0) == (goal == 1)).mean() > 0.99
    assert peak < 1.3 * view.nbytes


def test_a_repeated_id_is_one_training_document(spark, monkeypatch):
    """One id holds most rows, as a labelled document and, without its label, among the others."""
    seen = []
    features = cotraining._features

    def watched(docs, chosen):
        found = features(docs, chosen)
        seen.append(len(found[0]))
        return found

    monkeypatch.setattr(cotraining, "_features", watched)
    number = F.greatest(F.col("id") - 900, F.lit(0))
    text = F.concat(F.lit("text of "), F.col("id"), F.when(number % 2 == 0, " !!! ###").otherwise(" words"))
    docs = spark.range(1000, numPartitions=4).select(
        number.alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source")
    )
    labels = docs.filter("doc_id < 40").select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    assert cotraining.score_documents(docs, labels).count() == 1000
    assert seen[0] == 40
    seen.clear()
    assert cotraining.score_documents(docs, labels.filter("doc_id > 0")).count() == 1000
    assert seen[0] == 39
    seen.clear()
    assert cotraining.score_documents(docs, labels, labelled=30, exchanged=12).count() == 1000
    assert 0 < seen[0] <= 30 and all(n <= 8 for n in seen[1:])
