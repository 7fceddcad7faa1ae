"""The stored vector index against exact search."""

import numpy as np
import pytest

from evalloom.operators import vector_index as I
from evalloom.operators import vectors as V
from evalloom.session import scratch_path

KIND = "vec_id long, embedding array<float>"


def table(spark, matrix, first=0):
    return spark.createDataFrame([(first + i, x.tolist()) for i, x in enumerate(matrix)], KIND)


def clustered(n, rng, d=16):
    centres = rng.normal(size=(20, d)) * 3
    return (centres[rng.integers(0, 20, n)] + rng.normal(size=(n, d))).astype(np.float32)


@pytest.mark.parametrize("max_queries", [2048, 7])
def test_exact_when_all_cells_are_probed(spark, max_queries):
    rng = np.random.default_rng(1)
    matrix = clustered(600, rng)
    matrix[50:90] = matrix[50]  # ties
    bad = [(1000, None), (1001, [float("nan")] * 16), (1002, [1.0, 2.0]), (1003, [0.0] * 16), (None, [1.0] * 16)]
    vectors = table(spark, matrix).union(spark.createDataFrame(bad, KIND))
    queries = table(spark, matrix[40:60], 40).union(spark.createDataFrame(bad, KIND)).withColumnRenamed("vec_id", "query_id")
    index = I.build_vector_index(vectors, scratch_path(spark, "ivf"), dimensions=16)
    assert index.vectors.count() == 600
    found = I.search_index(queries, index, 10, probes=10**6, max_queries=max_queries, slice_rows=11)
    exact = V.vector_topk(queries, vectors, 10, dimensions=16)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))


def test_recall_and_share_read(spark, capsys):
    """At least nine of ten neighbours are found, and a growing corpus is read to a smaller share."""
    rng = np.random.default_rng(2)
    shares = []
    for n in (400, 6400):
        matrix = clustered(n, rng)
        index = I.build_vector_index(table(spark, matrix), scratch_path(spark, "ivf"), dimensions=16)
        queries = table(spark, matrix[:40]).withColumnRenamed("vec_id", "query_id")
        found = {(r.query_id, r.vec_id) for r in I.search_index(queries, index, 10).collect()}
        exact = {(r.query_id, r.vec_id) for r in V.vector_topk(queries, table(spark, matrix), 10).collect()}
        assert len(found & exact) >= 0.9 * len(exact)
        sizes = {r.cell: r.n for r in index.cells.collect()}
        unit = matrix[:40] / np.linalg.norm(matrix[:40], axis=1, keepdims=True)
        near = np.argsort(-(unit @ index.centres().T), axis=1)[:, : I.probes_for(len(sizes))]
        shares.append(np.mean([sum(sizes[c] for c in row) for row in near.tolist()]) / n)
    assert shares[1] < 0.9 * shares[0] < 0.9


def test_only_probed_cells_are_read(spark):
    rng = np.random.default_rng(3)
    matrix = clustered(500, rng)
    index = I.build_vector_index(table(spark, matrix), scratch_path(spark, "ivf"), dimensions=16)
    cells = [r.cell for r in index.cells.orderBy("cell").limit(3).collect()]
    read = index.vectors.filter(index.vectors.cell.isin(cells))
    assert 0 < len(read.inputFiles()) and "PartitionFilters: [cell" in read._jdf.queryExecution().toString()
    assert {f.split("cell=")[1].split("/")[0] for f in read.select("vec_id", "cell").distinct().inputFiles()} >= {str(c) for c in cells}


def test_codes_bound_the_cosine():
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(50, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    code, scale, error = I._encoded(unit)
    assert (np.abs(unit @ unit.T - (code * scale[:, None]) @ unit.T) <= error[:, None] + 1e-12).all()


def test_nearest_centres_block_by_block(monkeypatch):
    rng = np.random.default_rng(5)
    rows, centres = rng.normal(size=(30, 4)), rng.normal(size=(7, 4))
    whole = I._nearest(rows, centres, 3)
    monkeypatch.setattr(I, "BLOCK", 14)
    assert (I._nearest(rows, centres, 3) == whole).all() and (I._nearest(rows, centres)[:, 0] == whole[:, 0]).all()


def test_nothing_to_find(spark):
    empty = I.build_vector_index(spark.createDataFrame([], KIND), scratch_path(spark, "ivf"), dimensions=16)
    queries = spark.createDataFrame([(1, [1.0] * 16)], "query_id long, embedding array<float>")
    assert I.search_index(queries, empty, 3).collect() == []
    index = I.build_vector_index(spark.createDataFrame([(1, [1.0] * 16)], KIND), scratch_path(spark, "ivf"), dimensions=16)
    assert I.search_index(queries.limit(0), index, 3).collect() == []
    assert [tuple(r) for r in I.search_index(queries, index, 3).collect()] == [(1, 1, 1, 1.0)]
