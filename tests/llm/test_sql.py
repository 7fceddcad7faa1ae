"""Queries with SQL give the rows DuckDB gives."""

from collections import Counter
from pathlib import Path

import pytest

from evalloom.llm import queries

duckdb = pytest.importorskip("duckdb")
BASE = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not BASE.exists(), reason="test tables are not there")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{BASE}/{table}.parquet'")
    df = queries.QUERIES[name](spark, str(BASE))
    columns = sorted(df.columns)
    found = connection.execute(queries.ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(row[names.index(c)] for c in columns) for row in found.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in df.collect()) == theirs
