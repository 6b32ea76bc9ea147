from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.helpers import documents, jaccard_classes, sha
from tests.llm.test_text_operators import REPEATED_IDS


@pytest.mark.parametrize("rows", REPEATED_IDS)
def test_one_row_of_each_group_stays_where_ids_repeat(spark, rows):
    plain = jaccard_classes(list(enumerate(text for _, text in rows)))
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), "").collect()]
    numbers = [rows.index(row) for row in kept]
    assert sorted(plain[i][0] for i in numbers) == sorted({root for root, _ in plain.values()})


def test_the_last_stage_returns_the_token_ids(spark):
    rows = [(1, "Some words, and some more.", "web"), (2, "", "web"), (3, "Ünïcode \n text", "code")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = corpus_pipeline.tokens(spark, docs, "").collect()
    assert len(found) == 3
    assert all(len(r.ids) == 4 * r.n_tokens and sha(bytes(r.ids)) == r.ids_sha256 for r in found)


def test_a_task_of_the_last_stage_needs_one_python_worker(spark, monkeypatch):
    plans, written = [], corpus_pipeline.staged

    def noted(session, df, label):
        plans.append(df)
        return written(session, df, label)

    monkeypatch.setattr(corpus_pipeline, "staged", noted)
    docs = spark.createDataFrame([(1, "some words", "web")], "doc_id long, text string, source string")
    plans.append(corpus_pipeline.tokens(spark, docs, ""))
    steps = [p._jdf.queryExecution().executedPlan().toString().count("MapInArrow") for p in plans]
    assert steps == [1, 1]
