"""A stored vector index: cells around trained centres, compact codes, and an exact last step.

    build_vector_index(corpus, path, dimensions=64)
    near = search_index(queries, open_vector_index(spark, path), k=10)

A query reads the folders of the cells it probes and no others. Codes of one byte per component, with the exact error
of each, decide which vectors can be among the k best there; only those have their vectors fetched and compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.operators.sampling import hash_order
from evalloom.operators.vectors import TOPK_SCHEMA, _matrix, _rank, dot, usable
from evalloom.session import stage

SAMPLE = 65_536  # vectors that train the centres, fewer of very long ones
SAMPLE_VALUES = 1 << 24
BLOCK = 1 << 22  # products held at once
MAX_CELLS = 16_384
ROUNDS = 2
PROBE_POWER = 0.87
CODED = "vec_id bigint, embedding array<float>, cell int, code binary, scale double, error double"
CANDIDATES = "query_id bigint, vec_id bigint, cell int"


@dataclass(frozen=True)
class VectorIndex:
    """`vectors (vec_id, embedding, cell, code, scale, error)` in folders by cell, `cells (cell, centre, n)`."""

    vectors: DataFrame
    cells: DataFrame

    def centres(self) -> np.ndarray:
        """One row per cell, at most MAX_CELLS of them."""
        rows = self.cells.select("cell", "centre").orderBy("cell").collect()
        return np.array([row.centre for row in rows], np.float64)


def probes_for(cells: int) -> int:
    """How many cells a query probes by default: a share that falls as the cells, and with them the corpus, grow."""
    return min(cells, math.ceil(cells**PROBE_POWER))


def _nearest(unit: np.ndarray, centres: np.ndarray, count: int = 1) -> np.ndarray:
    """The `count` nearest centres of each row, the nearest first and ties to the lower cell, some rows at a time."""
    step = max(1, BLOCK // max(1, len(centres)))
    parts = [
        np.argsort(-(unit[a : a + step] @ centres.T), axis=1, kind="stable")[:, :count] if count > 1
        else np.argmax(unit[a : a + step] @ centres.T, axis=1)[:, None]
        for a in range(0, len(unit), step)
    ]
    return np.concatenate(parts) if parts else np.empty((0, count), np.int64)


def train(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of unit vectors by cosine, starting from the first rows. A centre nothing is near to stays."""
    centres = sample[:cells].copy()
    for _ in range(rounds if len(centres) else 0):
        nearest = _nearest(sample, centres)[:, 0]
        for cell in np.unique(nearest):
            mean = sample[nearest == cell].mean(axis=0)
            if (norm := np.linalg.norm(mean)) > 0:
                centres[cell] = mean / norm
    return centres


def _encoded(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One signed byte per component, the scale of each row, and how far the decoded row is from the row."""
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    return code, scale, np.linalg.norm(unit - code * scale[:, None], axis=1)


def build_vector_index(
    vectors: DataFrame, path: str, *, dimensions: int, cells: int | None = None, sample: int = SAMPLE, seed: int = 0
) -> VectorIndex:
    """Write the index of `vec_id, embedding` to `path`, and open it.

    The centres are trained on at most `sample` vectors in an order of digests; every usable vector of the length
    `dimensions` is put into the cell of its nearest centre. By default there are as many cells as the root of the
    number of vectors, at most MAX_CELLS. A large cell is written by several tasks.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable("embedding", dimensions=dimensions))
    cells = min(MAX_CELLS, cells or math.ceil(math.sqrt(vectors.count())))
    sample = min(sample, max(1, SAMPLE_VALUES // max(1, dimensions)))
    first = vectors.orderBy(hash_order("vec_id", seed), "vec_id").limit(sample).toArrow().column("embedding")
    unit = _matrix(first, True) if len(first) else np.zeros((0, dimensions))
    centres = train(unit, min(cells, len(unit)))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("embedding"), True)
            code, scale, error = _encoded(rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").cast(pa.int64()), batch.column("embedding").cast(pa.list_(pa.float32())),
                pa.array(_nearest(rows, shared.value)[:, 0].astype(np.int32)), pa.array([x.tobytes() for x in code], pa.binary()),
                pa.array(scale), pa.array(error),
            ], names=[x.split()[0] for x in CODED.split(", ")])

    coded = vectors.mapInArrow(assign, CODED).hint("rebalance", "cell")
    coded.sortWithinPartitions("cell", "vec_id").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    held = spark.read.schema(CODED).parquet(f"{path}/vectors").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    named = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    named.join(held, "cell", "left").select("cell", "centre", F.coalesce("n", F.lit(0)).alias("n")).write.mode("overwrite").parquet(f"{path}/cells")
    return open_vector_index(spark, path)


def open_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    return VectorIndex(
        spark.read.schema(CODED).parquet(f"{path}/vectors"), spark.read.schema("cell int, centre array<double>, n bigint").parquet(f"{path}/cells")
    )


class _Shortlist:
    """The vectors of the cells read so far that can be among the k best of each query."""

    def __init__(self, ids: np.ndarray, unit: np.ndarray, k: int, slack: float):
        self.ids, self.unit, self.k, self.slack = ids, unit, k, slack
        self.held: list[tuple[np.ndarray, ...]] = [(np.empty(0), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int32))] * len(ids)

    def add(self, queries: np.ndarray, cell: int, vec_ids: np.ndarray, decoded: np.ndarray, error: np.ndarray) -> None:
        scores = decoded @ self.unit[queries].T
        for at, q in enumerate(queries):
            # The cosine lies within the error of the code on both sides of this; rounding adds the slack.
            here = (scores[:, at] - error, scores[:, at] + error, vec_ids, np.full(len(vec_ids), cell, np.int32))
            low, high, ids, cells = (np.concatenate(x) for x in zip(self.held[q], here, strict=True))
            if len(low) > self.k:
                keep = high >= np.partition(low, len(low) - self.k)[len(low) - self.k] - self.slack
                low, high, ids, cells = low[keep], high[keep], ids[keep], cells[keep]
            self.held[q] = low, high, ids, cells

    def rows(self) -> pa.RecordBatch:
        counts = [len(x[0]) for x in self.held]
        ids, cells = (np.concatenate([x[i] for x in self.held]) if counts else np.empty(0) for i in (2, 3))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, counts), pa.int64()), pa.array(ids, pa.int64()), pa.array(cells, pa.int32())],
            names=["query_id", "vec_id", "cell"],
        )


def _decoded(codes: pa.Array, scale: np.ndarray, dimensions: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(codes.to_pylist()), np.int8).reshape(len(codes), dimensions)
    return flat * scale[:, None]


def _in_batches(index: VectorIndex, probed: DataFrame, unit: np.ndarray, ids: np.ndarray, k: int, slack: float) -> DataFrame:
    """Few queries: they are sent to all tasks, and codes stay where they are read."""
    by_cell: dict[int, list[int]] = {}
    place = {q: i for i, q in enumerate(ids.tolist())}
    for row in probed.select("query_id", "cell").collect():
        by_cell.setdefault(row.cell, []).append(place[row.query_id])
    shared = index.vectors.sparkSession.sparkContext.broadcast((ids, unit, {c: np.array(q) for c, q in by_cell.items()}))

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unit, by_cell = shared.value
        best = _Shortlist(ids, unit, k, slack)
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            scale, error = (batch.column(x).to_numpy() for x in ("scale", "error"))
            decoded = _decoded(batch.column("code"), scale, unit.shape[1])
            for cell in np.unique(cells):
                at = np.flatnonzero(cells == cell)
                best.add(by_cell[int(cell)], int(cell), batch.column("vec_id").to_numpy()[at], decoded[at], error[at])
        yield best.rows()

    read = index.vectors.filter(F.col("cell").isin(sorted(by_cell))).select("vec_id", "cell", "code", "scale", "error")
    return read.mapInArrow(shorten, CANDIDATES)


def _in_grid(index: VectorIndex, probed: DataFrame, k: int, slack: float, max_queries: int, slice_rows: int) -> DataFrame:
    """Many queries: within each cell, blocks of its queries meet slices of its codes."""
    asked = probed.groupBy("cell").agg(F.expr(f"int((count(1) - 1) div {max_queries} + 1)").alias("blocks"))
    grid = stage(asked.join(index.cells.select("cell", F.expr(f"int(greatest(n - 1, 0) div {slice_rows} + 1)").alias("slices")), "cell"), "cells")
    wanted = [row.cell for row in grid.select("cell").collect()]

    def side(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        placed = df.join(grid, "cell").withColumn(own, F.expr(f"int(pmod(xxhash64({key}), {own}s))"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("blocks", "slices")

    keys = ["cell", "block", "slice"]
    left = side(probed, "query_id", "block", "slice").groupBy(*keys)
    codes = index.vectors.filter(F.col("cell").isin(wanted)).select("vec_id", "cell", "code", "scale", "error")
    right = side(codes, "vec_id", "slice", "block").groupBy(*keys)

    def shorten(asked: pa.Table, held: pa.Table) -> pa.Table:
        ids = asked.column("query_id").to_numpy()
        unit = _matrix(asked.column("embedding"), True)
        best = _Shortlist(ids, unit, k, slack)
        if len(ids) and len(held):
            decoded = _decoded(held.column("code").combine_chunks(), held.column("scale").to_numpy(), unit.shape[1])
            best.add(np.arange(len(ids)), held.column("cell")[0].as_py(), held.column("vec_id").to_numpy(), decoded, held.column("error").to_numpy())
        return pa.Table.from_batches([best.rows()])

    return left.cogroup(right).applyInArrow(shorten, CANDIDATES)


def search_index(
    queries: DataFrame, index: VectorIndex, k: int = K.NUM_RESULTS, *, probes: int | None = None, digits: int = 6,
    max_queries: int = 2048, slice_rows: int = 100_000,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k nearest by cosine among the vectors of the `probes` nearest cells.

    What the codes leave out cannot be among the k best of those cells, so the result is exact within them. Queries
    that are not usable, have another length or no id find nothing. `query_id` is unique.
    """
    centres = index.centres()
    spark = index.vectors.sparkSession
    if not len(centres):
        return _rank(spark.createDataFrame([], TOPK_SCHEMA), k)
    probes = min(len(centres), probes or probes_for(len(centres)))
    shared = spark.sparkContext.broadcast(centres)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _nearest(_matrix(batch.column("embedding"), True), shared.value, probes)
            row = np.repeat(np.arange(batch.num_rows), probes)
            yield pa.RecordBatch.from_arrays([
                batch.column("query_id").cast(pa.int64()).take(pa.array(row)),
                batch.column("embedding").cast(pa.list_(pa.float64())).take(pa.array(row)), pa.array(near.ravel().astype(np.int32)),
            ], names=["query_id", "embedding", "cell"])

    good = usable("embedding", dimensions=centres.shape[1]) & F.col("query_id").isNotNull()
    asked = queries.select("query_id", "embedding").filter(good)
    probed = stage(asked.mapInArrow(probe, "query_id bigint, embedding array<double>, cell int"), "probed-cells")
    slack = 10.0**-digits
    heads = probed.select("query_id", "embedding").distinct()
    few = heads.limit(max_queries + 1).collect()
    if not few:
        return _rank(spark.createDataFrame([], TOPK_SCHEMA), k)
    if len(few) <= max_queries:
        unit = _matrix(pa.array([row.embedding for row in few]), True)
        found = _in_batches(index, probed, unit, np.array([row.query_id for row in few], np.int64), k, slack)
    else:
        found = _in_grid(index, probed, k, slack, max_queries, slice_rows)
    short = stage(found.distinct(), "shortlist")
    wanted = [row.cell for row in short.select("cell").distinct().collect()]
    a, b = F.col("embedding"), F.col("asked")
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    exact = (
        index.vectors.filter(F.col("cell").isin(wanted)).select("cell", "vec_id", "embedding").join(short, ["cell", "vec_id"])
        .join(heads.withColumnRenamed("embedding", "asked"), "query_id")
    )
    return _rank(exact.select("query_id", "vec_id", F.round(dot(a, b) / norms, digits).alias("score")), k)
