import numpy as np
import pytest
from pyspark.sql import functions as F

from evalloom.operators import vectors as V

rng = np.random.default_rng(5)
POINTS = rng.normal(size=(300, 8))
POINTS[10] = POINTS[11] = POINTS[12]


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(POINTS)] + [(999, None)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(q, [float(x) for x in POINTS[q * 12]]) for q in range(6)]
    return spark.createDataFrame(rows, "query_id bigint, embedding array<double>")


def nearest(query, k, cosine=True):
    points = POINTS / np.linalg.norm(POINTS, axis=1, keepdims=True) if cosine else POINTS
    asked = query / np.linalg.norm(query) if cosine else query
    scores = np.round(points @ asked, 6)
    order = np.lexsort((np.arange(len(points)), -scores))[:k]
    return [(int(i), float(scores[i])) for i in order]


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("limits", [{}, {"max_queries": 2, "slice_rows": 50}])
def test_topk_is_exact(queries, vectors, metric, limits):
    found = V.vector_topk(queries, vectors.repartition(3), 5, metric=metric, **limits).collect()
    for q in range(6):
        ours = [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
        wanted = nearest(POINTS[q * 12], 5, metric == "cosine")
        assert [i for i, _ in ours] == [i for i, _ in wanted]
        assert [s for _, s in ours] == pytest.approx([s for _, s in wanted], abs=1e-6)


def test_topk_larger_than_corpus(queries, vectors):
    assert V.vector_topk(queries, vectors, 1000).count() == 6 * 300
    assert V.vector_topk(queries.limit(0), vectors, 5).count() == 0
    with pytest.raises(ValueError):
        V.vector_topk(queries, vectors, 5, metric="l1")


def test_filter_before_search_and_threshold_after(queries, vectors):
    few = vectors.filter("vec_id >= 150")
    assert {r.vec_id >= 150 for r in V.vector_topk(queries, few, 3).collect()} == {True}


def test_ann_recall(spark, queries):
    base = "/root/testdata/sf0.001/embeddings.parquet"
    table = spark.read.parquet(base)
    asked = table.filter("vec_id % 25 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = {(r.query_id, r.vec_id) for r in V.vector_topk(asked, table, 10).collect()}
    index = V.lsh_signatures(table.select("vec_id", "embedding"), dimensions=64)
    found = {(r.query_id, r.vec_id) for r in V.vector_topk_ann(V.lsh_signatures(asked, dimensions=64), index, 10).collect()}
    assert len(exact & found) / len(exact) >= 0.8
    # A vector shares every bucket with itself.
    assert {(q, q) for q, _ in exact} <= found


def test_centroids_and_topics(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.8, 0.2], 0), (2, [0.0, 1.0], 1), (3, None, 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    centres = V.centroids(table)
    assert {r.query_id: r.embedding for r in centres.collect()} == {0: [0.9, 0.1], 1: [0.0, 1.0]}
    for limits in ({}, {"max_topics": 1, "slice_rows": 2}):
        assert {r.vec_id: r.topic for r in V.nearest_topic(table, centres, **limits).collect()} == {0: 0, 1: 0, 2: 1, 3: None}
    assert {r.topic for r in V.nearest_topic(table, centres.limit(0)).collect()} == {None}


def test_as_document(spark):
    hits = spark.createDataFrame([(1, "text", "u", 0.5)], "id int, body string, uri string, score double")
    row = V.as_document(hits, "body").first()
    assert row.page_content == "text"
    assert row.metadata == {"similarity_score": "0.5", "id": "1", "uri": "u"}


BAD = [
    (2001, [float("nan")] + [1.0] * 7), (2002, [None] + [1.0] * 7), (2003, [float("inf")] + [1.0] * 7), (2004, [1.0] * 5),
    (2005, [0.0] * 8), (2006, []), (None, [1.0] * 8),
]


@pytest.mark.parametrize("limits", [{}, {"max_queries": 2, "slice_rows": 50}])
def test_bad_vectors_change_nothing_for_the_others(spark, queries, vectors, limits):
    bad = spark.createDataFrame(BAD, "vec_id bigint, embedding array<double>")
    asked = queries.union(spark.createDataFrame([(q, v) for q, v in BAD], "query_id bigint, embedding array<double>"))
    found = V.vector_topk(asked, vectors.union(bad), 5, **limits).collect()
    # The one bad query of another length finds the one vector of that length.
    assert sorted(r for r in found if r.query_id != 2004) == sorted(V.vector_topk(queries, vectors, 5).collect())
    assert [tuple(r) for r in found if r.query_id == 2004] == [(2004, 1, 2004, 1.0)]


@pytest.mark.parametrize("limits", [{}, {"max_topics": 1, "slice_rows": 50}])
def test_bad_vectors_move_no_topic(spark, vectors, limits):
    labelled = vectors.filter("vec_id < 60").withColumn("label", F.col("vec_id") % 3)
    bad = spark.createDataFrame([(i, v, 1) for i, v in BAD[:3]] + [(2009, [1.0] * 8, None)],
                                "vec_id bigint, embedding array<double>, label bigint")
    clean = {r.vec_id: r.topic for r in V.nearest_topic(labelled, V.centroids(labelled), **limits).collect()}
    both = labelled.union(bad)
    found = {r.vec_id: r.topic for r in V.nearest_topic(both, V.centroids(both), **limits).collect()}
    assert {k: v for k, v in found.items() if k < 2000} == clean
    assert found[2001] is None and found[2002] is None and found[2003] is None and found[2009] is not None


LONG_OR_SHORT = [(-2, [1.0] * 11, -1), (-1, [5.0] * 5, 0), (2010, [5.0] * 5, 1)]


@pytest.mark.parametrize("limits", [{}, {"max_queries": 2, "slice_rows": 50}])
def test_each_query_meets_its_own_length(spark, queries, vectors, limits):
    kind = "id bigint, embedding array<double>"
    rng = np.random.default_rng(9)
    short = [(3000 + i, rng.normal(size=5).tolist()) for i in range(40)]
    other = spark.createDataFrame([x[:2] for x in LONG_OR_SHORT] + short, kind)
    held = other.withColumnRenamed("id", "vec_id").union(vectors)
    asked = other.filter("id < 3010").withColumnRenamed("id", "query_id").union(queries)
    clean = sorted(V.vector_topk(queries, vectors, 5).collect())
    found = V.vector_topk(asked, held, 5, **limits).collect()
    assert clean and sorted(r for r in found if 0 <= r.query_id < 2000) == clean
    points = {i: np.array(v) for i, v in [x[:2] for x in LONG_OR_SHORT] + short if len(v) == 5}
    for q in (-1, 2010, 3003):
        cosine = {i: round(float(v @ points[q] / np.linalg.norm(v) / np.linalg.norm(points[q])), 6) for i, v in points.items()}
        best = sorted(cosine, key=lambda i: (-cosine[i], i))[:5]
        assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == best
    assert [(r.vec_id, r.score) for r in found if r.query_id == -2] == [(-2, 1.0)]
    # The answer to a query does not depend on the others, and a caller may ask for one length only.
    alone = V.vector_topk(asked.filter("query_id = 3003"), held, 5, **limits).collect()
    assert sorted(alone) == sorted(r for r in found if r.query_id == 3003)
    assert {r.query_id for r in V.vector_topk(asked, held, 5, dimensions=11, **limits).collect()} == {-2}


@pytest.mark.parametrize("limits", [{}, {"max_topics": 1, "slice_rows": 50}])
def test_topics_have_a_centre_for_each_length(spark, vectors, limits):
    labelled = vectors.filter("vec_id < 60").withColumn("label", F.col("vec_id") % 3)
    bad = spark.createDataFrame([(i, v, max(k, 0)) for i, v, k in LONG_OR_SHORT], "vec_id bigint, embedding array<double>, label bigint")
    both = bad.union(labelled)
    centres = {(r.query_id, len(r.embedding)): r.embedding for r in V.centroids(both).collect()}
    clean = {(r.query_id, 8): r.embedding for r in V.centroids(labelled).collect()}
    assert {k: pytest.approx(v) for k, v in (clean | {(0, 11): [1.0] * 11, (0, 5): [5.0] * 5, (1, 5): [5.0] * 5}).items()} == centres
    topics = {r.vec_id: r.topic for r in V.nearest_topic(labelled, V.centroids(labelled), **limits).collect()}
    found = {r.vec_id: r.topic for r in V.nearest_topic(both, V.centroids(both), **limits).collect()}
    assert found == topics | {-2: 0, -1: 0, 2010: 0}
    some = V.nearest_topic(both, V.centroids(labelled), **limits).collect()
    assert {r.vec_id: r.topic for r in some} == topics | {-2: None, -1: None, 2010: None}
