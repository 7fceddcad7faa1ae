import datetime as dt

import pytest
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.operators import predicates as P

ROWS = [("a", 1, "red ring"), ("b", 2, "blue ring"), ("c", 3, None)]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, "k string, n int, name string")


@pytest.mark.parametrize(
    ("spec", "keys"),
    [
        ([], "abc"),
        (None, "abc"),
        ([{"field": "k", "filter": "a"}], "a"),
        ([{"field": "n", "filter": 2}], "b"),
        ([{"field": "k", "filter": ["a"]}], "a"),
        ([{"field": "k", "filter": ["a", "c"]}], "ac"),
        ([{"field": "n", "filter": {"<": 2}}], "a"),
        ([{"field": "n", "filter": {"<=": 2}}], "ab"),
        ([{"field": "n", "filter": {">": 2}}], "c"),
        ([{"field": "n", "filter": {">=": 2}}, {"field": "n", "filter": {"<": 3}}], "b"),
        ([{"field": "name", "filter": {"like": "%ring"}}], "ab"),
        ([{"field": "name", "filter": {"NOT": "red ring"}}], "b"),
    ],
)
def test_compile_filters(table, spec, keys):
    found = table.filter(P.compile_filters(spec, table.columns)).collect()
    assert "".join(sorted(row.k for row in found)) == keys


@pytest.mark.parametrize(
    "spec",
    [
        [{"field": "secret", "filter": 1}],
        [{"field": "n", "filter": {"~": 1}}],
        [{"field": "n", "filter": {"<": 1, ">": 0}}],
        [{"field": "n", "filter": {}}],
    ],
)
def test_compile_filters_refuses(table, spec):
    with pytest.raises(ValueError):
        P.compile_filters(spec, table.columns)


def test_exclude_uri_takes_paths_literally(spark):
    docs = spark.createDataFrame([("/a.b/x",), ("/aXb/x",), ("/admin/x",), (None,)], "doc_uri string")
    left = [r.doc_uri for r in P.exclude_uri(docs, ["/a.b/"]).orderBy("doc_uri").collect()]
    assert left == [None, "/aXb/x", "/admin/x"]
    assert P.exclude_uri(docs, []).count() == 4


def test_result_columns_keep_order():
    assert P.result_columns("id", "text", "uri", ["uri", "extra", "id"]) == ["id", "text", "uri", "extra"]


def test_review_status_none_is_a_state(spark):
    rows = spark.createDataFrame([("a", "DRAFT"), ("b", None)], "k string, review_status string")
    assert [r.k for r in P.by_review_status(rows, None).collect()] == ["b"]
    assert [r.k for r in P.by_review_status(rows, "DRAFT").collect()] == ["a"]


def test_since_includes_the_limit(spark):
    as_of = dt.datetime(2024, 1, 31)
    rows = spark.createDataFrame(
        [("at", as_of - dt.timedelta(days=30)), ("before", as_of - dt.timedelta(days=30, seconds=1)), ("null", None)],
        "k string, ts timestamp",
    )
    assert [r.k for r in P.since(rows, "ts", F.lit(as_of), 30).collect()] == ["at"]


def test_user_orders_keeps_to_the_user(spark):
    orders = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "user_id int, order_id string")
    users = spark.createDataFrame([(2,), (2,)], "user_id int")
    assert sorted(r.order_id for r in P.user_orders(orders, users, "user_id", "order_id").collect()) == ["y", "z"]


def test_run_columns(spark):
    rows = spark.createDataFrame([("r", "q", "a", "t", 1)], "request_id string, request string, response string, trace string, n int")
    out = P.with_run_columns(rows, "request_id", "run", "exp")
    assert out.columns == ["request_id", "n", "run_id", "experiment_id", "topic"]
    assert dict(P.with_status_columns(rows).dtypes)[K.PRECISION_COLUMN] == "double"
