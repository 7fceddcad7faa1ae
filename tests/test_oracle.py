"""Every registered query that has SQL gives the rows DuckDB gives."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from evalloom.plans import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")
BASE = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
SQL_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}

# Only these run Python: vector products, user callables and user functions.
PYTHON = {
    "batch_predict", "evaluation_run", "filtered_search", "hybrid_topk", "prompt_judge", "similarity_threshold", "topic_centroid",
    "table_search", "udf_scalar", "udtf_chunks", "vector_topk", "vector_topk_ann",
}
PYTHON_NODES = ("PythonUDF", "MapInArrow", "MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMap", "PythonUDTF")

pytestmark = pytest.mark.skipif(not BASE.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{BASE}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, repr(value)) for value in row))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, name, capsys):
    df = entry_points.queries()[name](spark, str(BASE))
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert any(node in plan for node in PYTHON_NODES) == (name in PYTHON)
    columns = sorted(df.columns)
    ours = [tuple(row[c] for c in columns) for row in df.collect()]
    found = duck.execute(entry_points.oracle_sql()[name])
    described = [d[0] for d in found.description]
    assert sorted(described) == columns
    places = [described.index(c) for c in columns]
    theirs = [tuple(row[p] for p in places) for row in found.fetchall()]
    assert ordered(ours) == ordered(theirs)
    types = {d[0]: SQL_TYPES[str(d[1])] for d in found.description}
    assert types == dict(df.dtypes)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_returns_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["query_id", "rank", "corpus_pos", "score", "kept_chars"]
    assert df.count() > 0


def test_filters_and_columns_reach_the_scan(spark, capsys):
    entry_points.queries()["filter_range"](spark, str(BASE)).explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(p_size,10)" in plan and "LessThan(p_size,30)" in plan
    assert "p_type" not in plan


@pytest.mark.parametrize("name", ["dedup_first", "hourly_cap", "latest_revision"])
def test_ranks_are_cut_before_the_shuffle(spark, name, capsys):
    entry_points.queries()[name](spark, str(BASE)).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan
