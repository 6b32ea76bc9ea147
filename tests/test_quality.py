from datetime import datetime, timedelta

import pytest

from strata.operators import quality as q
from strata.plans import quality

NOW = datetime(2026, 6, 1)


def test_suites_hold_all_declared_tests():
    assert len(quality.SILVER_SUITE) == 13 and len(quality.GOLD_SUITE) == 88
    names = [test.name for test in (*quality.SILVER_SUITE, *quality.GOLD_SUITE)]
    assert len(set(names)) == 101
    kinds = [test.kind for test in (*quality.SILVER_SUITE, *quality.GOLD_SUITE)]
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        "not_null": 51, "unique": 14, "unique_combination": 2, "relationships": 7,
        "accepted_values": 2, "between": 5, "column_exists": 17, "distinct_count_gt": 3,
    }


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", 5, "it's"), (1, "b", -1, "x"), (2, None, None, None), (None, None, 40, "x"), (3, "z", 0, "x")],
        "id int, ref string, n int, kind string",
    )
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "ref string")
    return {"child": child, "parent": parent}


CASES = [
    (q.not_null("child", "id"), 1),
    (q.unique("child", "id"), 1),
    (q.unique_combination("child", "id", "ref"), 0),
    (q.relationship("child", "ref", "parent", "ref"), 1),
    (q.accepted_values("child", "kind", ["it's"]), 3),
    (q.between("child", "n", 0, 31), 2),
    (q.between("child", "n", 0), 1),
    (q.column_exists("child", "id"), 0),
    (q.column_exists("child", "gone"), 1),
    (q.distinct_more_than("child", "id", 2), 0),
    (q.distinct_more_than("child", "id", 3), 1),
]


def test_counts_and_failing_rows_agree(spark, tables):
    for tests, expected in CASES:
        results = quality.run_tests(tables, tests).collect()
        assert [r.failed_rows for r in results] == [expected], tests[0].name
        assert q.failing_rows(tables, tests[0]).count() == expected, tests[0].name


def test_one_run_of_many_tests(tables):
    suite = [test for tests, _ in CASES[:-1] if tests[0].name != "between_child_n" for test in tests]
    results = {r.test: r.failed_rows for r in quality.run_tests(tables, suite).collect()}
    assert results["unique_child_id"] == 1 and results["relationships_child_ref"] == 1
    assert len(results) == len(suite)


def test_null_keys_repeat_in_combinations_only(spark):
    df = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    suite = [*q.unique("t", "a"), *q.unique_combination("t", "a", "b")]
    found = {r.test: r.failed_rows for r in quality.run_tests({"t": df}, suite).collect()}
    assert found == {"unique_t_a": 0, "unique_combination_t_a_b": 1}


def test_warnings_do_not_block(spark, tables, root):
    warn = q.relationship("child", "ref", "parent", "ref", severity=q.WARN)
    assert quality.quality_gate(tables, warn, root) == [("relationships_child_ref", 1, "warn")]
    assert spark.read.parquet(f"{root}/test_failures/relationships_child_ref").count() == 1
    with pytest.raises(quality.QualityGateError):
        quality.quality_gate(tables, q.not_null("child", "id"), root)


@pytest.mark.parametrize(
    "age, status",
    [
        (timedelta(days=35), "pass"), (timedelta(days=35, seconds=1), "warn"),
        (timedelta(days=60), "warn"), (timedelta(days=60, seconds=1), "error"), (None, "error"),
    ],
)
def test_freshness_limits(spark, age, status):
    rows = [] if age is None else [(NOW - age,), (NOW - timedelta(days=100),)]
    df = spark.createDataFrame(rows, "_loaded_at timestamp")
    found = quality.source_freshness({"s": df}, NOW).collect()
    assert [(r.source, r.status) for r in found] == [("s", status)]


def test_publish_gate_names_what_fails(spark):
    marks = spark.createDataFrame([("m2", "ERROR"), ("m1", "PASS")], "check_name string, status string")
    fresh = spark.createDataFrame([("s", "warn")], "source string, status string")
    row = quality.publish_gate(marks, fresh).first()
    assert (row.publish, row.failing_checks) == (False, "freshness_s,m2")
    row = quality.publish_gate(marks.filter("status = 'PASS'"), fresh.limit(0)).first()
    assert (row.publish, row.failing_checks) == (True, "")


def test_alert_record(spark):
    results = spark.createDataFrame(
        [("b", "fail"), ("w", "warn"), ("a", "fail"), ("p", "pass")], "test string, status string"
    )
    passed = results.filter("status <> 'fail'")
    assert quality.quality_alert(passed, "job", "silver", "r1").count() == 0
    row = quality.quality_alert(results, "job", "silver", "r1").first()
    assert row.event == "data_quality_job_failed" and row.job_name == "job"
    assert row.payload == (
        '{"error":"data tests failed: a, b","event":"data_quality_job_failed","job_name":"job",'
        '"op_name":"silver","run_id":"r1"}'
    )
