import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evalloom.operators import joins as J
from evalloom.operators import traces as T


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "id int, name string, `x/y` double")


def test_merge_takes_nulls_and_new_columns(spark, target):
    updates = spark.createDataFrame([(1, None, "t1"), (3, 3.0, None), (9, 9.0, "t9")], "id int, `x/y` double, topic string")
    merged = J.merge_matched(target, updates, "id")
    assert merged.columns == ["id", "name", "x/y", "topic"]
    assert rows(merged) == [(1, "a", None, "t1"), (2, "b", 2.0, None), (3, "c", 3.0, None)]


def test_merge_keeps_the_rows_of_a_repeated_target_key(spark, target):
    updates = spark.createDataFrame([(1, 5.0)], "id int, `x/y` double")
    assert J.merge_matched(target.union(target), updates, "id").count() == 6


def test_merge_refuses_two_updates_of_a_row(spark, target):
    updates = spark.createDataFrame([(1, 5.0), (1, 6.0)], "id int, `x/y` double")
    with pytest.raises(PySparkException, match="several updates"):
        J.merge_matched(target, updates, "id").collect()
    unmatched = spark.createDataFrame([(9, 5.0), (9, 6.0)], "id int, `x/y` double")
    assert J.merge_matched(target, unmatched, "id").count() == 3


def test_merge_set(spark, target):
    hits = spark.createDataFrame([(2,)], "id int")
    assert rows(J.merge_set(target.drop("x/y"), hits, "id", "topic", F.upper("name"))) == [
        (1, "a", None), (2, "b", "B"), (3, "c", None),
    ]
    with pytest.raises(PySparkException, match="several updates"):
        J.merge_set(target, hits.union(hits), "id", "topic", F.lit("x")).collect()


def test_feedback_counts_unprocessed_and_recent_only(spark):
    now = dt.datetime(2024, 1, 31)
    requests = spark.createDataFrame([("a", None), ("b", "run"), ("c", None), ("d", None)], "request_id string, run_id string")
    days = {"a": 1, "b": 1, "c": 40}
    feedback = spark.createDataFrame(
        [(k, now - dt.timedelta(days=n)) for k, n in days.items()] * 2, "request_id string, timestamp timestamp"
    )
    assert rows(J.with_feedback(requests, feedback, F.lit(now))) == [("a",)]


def test_status_moves_only_unprocessed_rows(spark):
    log = spark.createDataFrame(
        [("a", None), ("b", None), ("c", "to_process"), ("d", "skipped"), ("e", "run-1")],
        "request_id string, run_id string",
    )
    chosen = spark.createDataFrame([("a",), ("a",), ("d",), ("e",)], "request_id string")
    advanced = T.advance_status(log, chosen)
    assert rows(advanced) == [
        ("a", "to_process"), ("b", "skipped"), ("c", "to_process"), ("d", "skipped"), ("e", "run-1"),
    ]


def test_mark_sets_the_value_once_per_row(spark):
    log = spark.createDataFrame([("a", None), ("a", "x"), ("b", "y")], "request_id string, run_id string")
    ids = spark.createDataFrame([("a",), ("a",)], "request_id string")
    assert rows(J.mark(log, ids, "to_process")) == [("a", "to_process"), ("a", "to_process"), ("b", "y")]


def test_compare_runs(spark):
    before = spark.createDataFrame([("w", True), ("b", False), ("s", True), ("n", None), ("o", True)], "id string, passed boolean")
    after = spark.createDataFrame([("w", False), ("b", True), ("s", True), ("n", True), ("p", False)], "id string, passed boolean")
    found = {r.id: r.change for r in J.compare_runs(before, after, "id").collect()}
    assert found == {"w": "worse", "b": "better", "s": "same", "n": "unknown", "o": "only_before", "p": "only_after"}


def test_remaining_and_source(spark):
    docs = spark.createDataFrame([("u1", "x"), ("u2", "y")], "doc_uri string, content string")
    evals = spark.createDataFrame([("e1", "u1"), ("e2", "u1"), ("e3", "gone")], "request_id string, source_id string")
    assert rows(J.remaining_docs(docs, evals)) == [("u2", "y")]
    sourced = J.with_source(evals, docs).select("request_id", "content")
    assert rows(sourced) == [("e1", "x"), ("e2", "x"), ("e3", None)]
