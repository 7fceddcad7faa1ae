"""Nearest vectors. A corpus is `vec_id, embedding ARRAY<FLOAT>`; queries are `query_id, embedding`."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.session import stage

TOPK_SCHEMA = "query_id bigint, vec_id bigint, score double"


def _matrix(column: pa.Array | pa.ChunkedArray, normalise: bool) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(rows, -1) if rows else flat.reshape(0, 0)
    if normalise and rows:
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = matrix / np.where(norms == 0.0, 1.0, norms)
    return matrix


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best scores, ties to the lower id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def usable(vector: str | Column, *, dimensions: int | None = None, direction: bool = True) -> Column:
    """Whether a vector can be compared: not null, every component a finite number, of the asked length.

    With `direction` a zero vector is not usable either, since it has no cosine. One rule for exact and
    approximate search, topics and their centroids: what fails it is treated like a null vector.
    """
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = (F.size(vector) > 0 if dimensions is None else F.size(vector) == dimensions) & finite
    if direction:
        good = good & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good, F.lit(False))


class _Leaders:
    """The k best vectors of each query seen so far by one task."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, digits: int):
        self.query_ids, self.queries, self.k, self.digits = query_ids, queries, k, digits
        self.ids = [np.empty(0, np.int64) for _ in query_ids]
        self.scores = [np.empty(0, np.float64) for _ in query_ids]
        self.floor = np.full(len(query_ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray, chunk: int = 4096) -> None:
        for a in range(0, len(ids), chunk):
            self._add(ids[a : a + chunk], vectors[a : a + chunk])

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = np.round(vectors @ self.queries.T, self.digits)
        for q in np.flatnonzero(scores.max(axis=0) >= self.floor):
            here = _best(scores[:, q], ids, self.k)
            ids_q = np.concatenate([self.ids[q], ids[here]])
            scores_q = np.concatenate([self.scores[q], scores[here, q]])
            best = _best(scores_q, ids_q, self.k)
            self.ids[q], self.scores[q] = ids_q[best], scores_q[best]
            if len(best) == self.k:
                self.floor[q] = self.scores[q][-1]

    def rows(self) -> pa.RecordBatch:
        counts = [len(i) for i in self.ids]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.query_ids, counts), pa.int64()),
                pa.array(np.concatenate(self.ids) if counts else [], pa.int64()),
                pa.array(np.concatenate(self.scores) if counts else [], pa.float64()),
            ],
            names=["query_id", "vec_id", "score"],
        )


def _rank(scored: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _by_length(rows: list, normalise: bool) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The ids and the matrix of the query vectors of each length."""
    held: dict[int, list] = {}
    for row in rows:
        held.setdefault(len(row.embedding), []).append(row)
    return {
        n: (np.array([r.query_id for r in own], np.int64), _matrix(pa.array([r.embedding for r in own]), normalise))
        for n, own in held.items()
    }


def _of_lengths(column: pa.Array, wanted: dict[int, object]) -> Iterator[tuple[int, np.ndarray | None]]:
    """The rows whose vector has one of the wanted lengths, length by length; None stands for all rows."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    for n in wanted:
        at = np.flatnonzero(lengths == n)
        if len(at):
            yield n, None if len(at) == len(lengths) else at


def _by_broadcast(queries: list, vectors: DataFrame, k: int, normalise: bool, digits: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(_by_length(queries, normalise))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = {n: _Leaders(*asked, k, digits) for n, asked in shared.value.items()}
        for batch in batches:
            ids, vectors = batch.column("vec_id"), batch.column("embedding")
            for n, at in _of_lengths(vectors, leaders):
                rows = (ids, vectors) if at is None else (ids.take(pa.array(at)), vectors.take(pa.array(at)))
                leaders[n].add(rows[0].to_numpy(), _matrix(rows[1], normalise))
        for best in leaders.values():
            yield best.rows()

    return vectors.mapInArrow(search, TOPK_SCHEMA)


def _by_grid(
    queries: DataFrame, vectors: DataFrame, k: int, normalise: bool, digits: int, blocks: int, slices: int
) -> DataFrame:
    """Cut queries into blocks and vectors into slices; one task scores one block against one slice of its length."""
    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def cell(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    length = F.size("embedding").alias("length")
    asked = queries.select("*", length, cell("query_id", blocks).alias("block"), numbers(slices).alias("slice"))
    held = vectors.select("*", length, cell("vec_id", slices).alias("slice"), numbers(blocks).alias("block"))

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        ids = asked.column("query_id").to_numpy()
        leaders = _Leaders(ids, _matrix(asked.column("embedding"), normalise), k, digits)
        if held.num_rows and len(ids):
            leaders.add(held.column("vec_id").to_numpy(), _matrix(held.column("embedding"), normalise))
        return pa.Table.from_batches([leaders.rows()])

    keys = ["length", "block", "slice"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(search, TOPK_SCHEMA)


def vector_topk(
    queries: DataFrame, vectors: DataFrame, k: int = K.NUM_RESULTS, *, metric: str = "cosine",
    digits: int = 6, max_queries: int = 2048, slice_rows: int = 100_000, dimensions: int | None = None,
) -> DataFrame:
    """Exact k nearest vectors of each query by `cosine` or `dot`, ties to the lower id.

    Up to `max_queries` queries are broadcast, and the corpus is read once in Arrow batches, where every
    task keeps only its k best per query. More queries than that are cut into blocks and the corpus into
    slices of about `slice_rows`, joined as a grid. Scores are rounded to `digits` before they are ranked.
    A query meets the vectors of its own length, whatever other queries are asked; `dimensions` leaves only one length.
    Vectors that are not `usable` are never near anything; rows without an id are left out.
    """
    if metric not in ("cosine", "dot"):
        raise ValueError(f"metric must be 'cosine' or 'dot', not {metric!r}")
    normalise = metric == "cosine"
    queries = queries.select("query_id", "embedding")
    vectors = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull())
    good = usable("embedding", dimensions=dimensions, direction=normalise)
    queries = queries.filter(good & F.col("query_id").isNotNull())
    vectors = vectors.filter(good)
    head = queries.limit(max_queries + 1).collect()
    if not head:
        return _rank(vectors.sparkSession.createDataFrame([], TOPK_SCHEMA), k)
    if len(head) <= max_queries:
        return _rank(_by_broadcast(head, vectors, k, normalise, digits), k)
    blocks = -(-queries.count() // max_queries)
    slices = max(1, -(-vectors.count() // slice_rows))
    return _rank(_by_grid(queries, vectors, k, normalise, digits, blocks, slices), k)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def hyperplanes(dimensions: int, tables: int, bits: int, seed: int) -> np.ndarray:
    """Normals with components 1 and -1, by the first digit of a digest, so that any engine can make the same."""
    def side(table: int, bit: int, dimension: int) -> int:
        return 1 if hashlib.md5(f"{seed}:{table}:{bit}:{dimension}".encode()).hexdigest()[0] < "8" else -1

    return np.array(
        [[side(t, b, d) for t in range(tables) for b in range(bits)] for d in range(dimensions)], np.float64
    )


def lsh_signatures(
    vectors: DataFrame, *, dimensions: int, tables: int = 16, bits: int = 8, seed: int = 0
) -> DataFrame:
    """Add `signatures`: per hash table, which side of `bits` random hyperplanes the vector lies on.

    For a corpus this is computed once and kept as a table. A bucket holds about n / 2^`bits` vectors, so the
    caller chooses `bits` by the size of the corpus; more tables find more of the neighbours.
    """
    planes = hyperplanes(dimensions, tables, bits, seed)
    weights = 1 << np.arange(bits)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (_matrix(batch.column("embedding"), False).reshape(batch.num_rows, dimensions) @ planes) > 0
            values = sides.reshape(batch.num_rows, tables, bits) @ weights
            column = pa.array(list(values.astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "signatures"])

    fields = ", ".join(f"`{n}` {t}" for n, t in vectors.dtypes)
    return vectors.filter(usable("embedding", dimensions=dimensions)).mapInArrow(sign, f"{fields}, signatures array<int>")


def vector_topk_ann(
    queries: DataFrame, index: DataFrame, k: int = K.NUM_RESULTS, *, bits: int = 8, digits: int = 6
) -> DataFrame:
    """Approximate k nearest: vectors near the query's hash buckets, ranked by exact cosine.

    Both sides come from `lsh_signatures` with the same `bits`. In every table a query looks into its own
    bucket and the `bits` buckets across one hyperplane. Only ids and signatures are joined, on (table,
    signature); the pairs that meet are staged, so that their vectors are then fetched by a broadcast
    join if the pairs are few and by one shuffle of the index if they are many.
    """
    flips = F.array(F.lit(0), *[F.lit(1 << bit) for bit in range(bits)])
    own = queries.select("query_id", F.posexplode("signatures").alias("table", "own"))
    asked = own.select("query_id", "table", "own", F.explode(flips).alias("flip")).select(
        "query_id", "table", F.col("own").bitwiseXOR(F.col("flip")).alias("signature")
    )
    held = index.select("vec_id", F.posexplode("signatures").alias("table", "signature"))
    buckets = stage(asked, "query-buckets")
    met = stage(held.join(buckets, ["table", "signature"]).select("query_id", "vec_id").distinct(), "lsh-pairs")
    a, b = F.col("embedding"), F.col("asked")
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    fetched = index.select("vec_id", "embedding").join(met, "vec_id").join(
        queries.select("query_id", F.col("embedding").alias("asked")), "query_id"
    )
    scored = fetched.select(
        "query_id", "vec_id", F.round(dot(a, b) / F.nullif(norms, F.lit(0.0)), digits).alias("score")
    )
    return _rank(scored.filter(F.col("score").isNotNull()), k)


def centroids(vectors: DataFrame, label: str = "label", *, dimensions: int | None = None) -> DataFrame:
    """The mean vectors of each label as `query_id, embedding`, one for each length its vectors have.

    Values are averaged per (label, length, dimension), which folds map-side however large a label is. Vectors that
    are not `usable`, those of another length than `dimensions` if it is given, and rows without a label are left out.
    """
    good = usable("embedding", dimensions=dimensions, direction=False) & F.col(label).isNotNull()
    means = (
        vectors.filter(good)
        .select(F.col(label).cast("bigint").alias("query_id"), F.size("embedding").alias("length"), F.posexplode("embedding").alias("at", "x"))
        .groupBy("query_id", "length", "at").agg(F.avg("x").alias("x"))
    )
    return means.groupBy("query_id", "length").agg(
        F.array_sort(F.collect_list(F.struct("at", "x"))).getField("x").alias("embedding")
    ).drop("length")


def nearest_topic(
    vectors: DataFrame, topics: DataFrame, *, digits: int = 6, max_topics: int = 2048,
    slice_rows: int = 100_000, dimensions: int | None = None,
) -> DataFrame:
    """The nearest topic centroid of every vector: `vec_id, topic, score`, ties to the lower topic.

    A vector is compared with the topics of its own length; `dimensions` leaves only one length. One that is not
    `usable`, or of a length no topic has, has a null topic. Up to `max_topics` topics are broadcast and the vectors
    are read once; more go through the grid of blocks and slices, where each vector asks for its one nearest topic.
    """
    good = usable("embedding", dimensions=dimensions)
    vectors = vectors.select("vec_id", F.when(good, F.col("embedding")).alias("embedding"))
    topics = topics.select("query_id", "embedding").filter(good & F.col("query_id").isNotNull())
    head = topics.limit(max_topics + 1).collect()
    if len(head) <= max_topics:
        return _nearest_of(sorted(head, key=lambda row: row.query_id), vectors, digits)
    none = (F.lit(None).cast("bigint").alias("topic"), F.lit(None).cast("double").alias("score"))
    known = topics.select(F.size("embedding").alias("length")).distinct().withColumn("known", F.lit(True))
    sized = vectors.withColumn("length", F.size("embedding")).join(known, "length", "left")
    asking = sized.filter("known").select(F.col("vec_id").alias("query_id"), "embedding")
    held = topics.withColumnRenamed("query_id", "vec_id")
    blocks = max(1, -(-asking.count() // slice_rows))
    slices = -(-held.count() // max_topics)
    best = _rank(_by_grid(asking, held, 1, True, digits, blocks, slices), 1)
    named = best.select(F.col("query_id").alias("vec_id"), F.col("vec_id").alias("topic"), "score")
    return named.unionByName(sized.filter(F.col("known").isNull()).select("vec_id", *none))


def _nearest_of(topics: list, vectors: DataFrame, digits: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(_by_length(topics, True))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            embedding = batch.column("embedding")
            topic, score, given = np.zeros(len(embedding), np.int64), np.zeros(len(embedding)), np.zeros(len(embedding), bool)
            for n, at in _of_lengths(embedding, shared.value):
                ids, matrix = shared.value[n]
                at = np.arange(len(embedding)) if at is None else at
                scores = np.round(_matrix(embedding.take(pa.array(at)), True) @ matrix.T, digits)
                topic[at], score[at], given[at] = ids[scores.argmax(axis=1)], scores.max(axis=1), True
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(topic, pa.int64(), mask=~given),
                    pa.array(score, pa.float64(), mask=~given),
                ],
                names=["vec_id", "topic", "score"],
            )

    return vectors.mapInArrow(choose, "vec_id bigint, topic bigint, score double")


def as_document(results: DataFrame, text: str, *, score: str = "score") -> DataFrame:
    """Search results as documents: the text apart, every other column and the score in a metadata map."""
    others = [c for c in results.columns if c not in (text, score)]
    entries = [F.lit("similarity_score"), F.col(score).cast("string")]
    for name in others:
        entries += [F.lit(name), F.col(name).cast("string")]
    return results.select(F.col(text).alias("page_content"), F.create_map(*entries).alias("metadata"))
