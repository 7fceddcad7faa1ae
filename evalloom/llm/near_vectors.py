"""Exact range join of vectors in cells around pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.llm.graph import components
from evalloom.session import stage

COSINE = 0.98
CELL = 4096
MAX_PIVOTS = 4096
SLACK = 1e-9  # more than the rounding of a distance: a vector on the border is copied, never lost
COPY = "cell long, own int, other int, native boolean, point long, copies long, vector array<double>"
FOUND = "point long, links long, root long"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def valid(vector: str):
    """Not null or empty, every component a finite number, not all zero."""
    finite = f"forall({vector}, x -> x is not null and not isnan(x) and abs(double(x)) < double('infinity'))"
    return F.expr(f"coalesce(size({vector}) > 0 and {finite} and exists({vector}, x -> x <> 0), false)")


def _reach(distances: np.ndarray, pivots: np.ndarray, vectors: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each vector, and the cells that may hold a native within `radius` of it.

    x native to cell c and y within r of x: d(y, c) <= d(x, c) + r <= d(x, home) + r <= d(y, home) + 2r by the
    triangle inequality; and y is at most r beyond the plane between c and its own pivot.
    """
    home = np.argmin(distances, axis=1)
    nearest = distances[np.arange(len(home)), home]
    apart = np.linalg.norm(pivots[:, None, :] - pivots[None, :, :], axis=2) if len(pivots) <= 64 else None
    near = distances <= nearest[:, None] + 2 * radius + SLACK
    rows, cells = np.nonzero(near)
    own = home[rows]
    gap = distances[rows, cells] ** 2 - nearest[rows] ** 2
    between = apart[cells, own] if apart is not None else np.linalg.norm(pivots[cells] - pivots[own], axis=1)
    keep = gap <= 2 * radius * between + SLACK
    return home, np.stack([rows[keep], cells[keep]])


def _links(natives: np.ndarray, weights: np.ndarray, points: np.ndarray, others: np.ndarray, more: np.ndarray,
           others_points: np.ndarray, cosine: float, chunk: int = 256) -> tuple[np.ndarray, dict[int, int]]:
    """How many vectors each native is linked with here, and the links as stars."""
    count = np.zeros(len(points), np.int64)
    adjacency = np.zeros((len(points), len(others_points)), bool)
    for a in range(0, len(points), chunk):
        linked = natives[a : a + chunk] @ others.T >= cosine
        linked &= points[a : a + chunk, None] != others_points[None, :]
        adjacency[a : a + chunk] = linked
        count[a : a + chunk] = linked @ more
    label, far = points.copy(), others_points.copy()
    rows, columns = np.flatnonzero(adjacency.any(axis=1)), np.flatnonzero(adjacency.any(axis=0))
    changed = len(rows) > 0
    big = np.iinfo(np.int64).max
    while changed:  # the smallest label walks over the links of this block
        old = label.copy()
        for a in range(0, len(rows), chunk):
            part = rows[a : a + chunk]
            low = np.where(adjacency[np.ix_(part, columns)], far[columns], big).min(axis=1)
            label[part] = np.minimum(label[part], low)
        for a in range(0, len(columns), chunk):
            part = columns[a : a + chunk]
            low = np.where(adjacency[np.ix_(rows, part)], label[rows][:, None], big).min(axis=0)
            far[part] = np.minimum(far[part], low)
        changed = bool((label != old).any())
    roots = {int(points[i]): int(label[i]) for i in rows}
    roots |= {int(others_points[j]): int(far[j]) for j in columns if int(others_points[j]) not in roots}
    return count, roots


def near_vectors(
    vectors: DataFrame, *, vector: str = "embedding", key: str = "vec_id", label: str = "label", cosine: float = COSINE,
    cell: int = CELL, max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """Per vector the number of others of its label with cosine >= `cosine`, and its component over those links.

    Equal vectors are one point with a number of copies. The points of a label gather in cells around pivots; a
    point is copied to each cell that may hold a point within the range, and counts its links in its home cell
    alone, so every pair is judged once from either side. Points and guests of a cell are dealt to blocks of about
    `cell`, so a task holds two blocks of bounded size. A block reports counts and stars, never pairs. Pivots are a
    sample of at most `max_pivots`, which bounds what is broadcast; any pivots give the same result.

    Vectors that are null, empty, zero or hold null or non-finite components, and those with a null label, link
    with nothing; so do vectors of different length. A null key counts as a row but cannot name a component.
    Repeated rows count each. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector")
    )
    good = F.col("label").isNotNull() & valid("vector")
    points = stage(
        rows.filter(good).groupBy("label", "vector")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("point", F.monotonically_increasing_id()),
        "points",
    )
    group = points.withColumn("dims", F.size("vector"))
    sizes = {(r.label, r.dims): r["count"] for r in group.groupBy("label", "dims").count().collect()}
    share = min(1.0, max_pivots / max(1, sum(-(-n // cell) for n in sizes.values())))
    wanted = {g: max(1, int(share * -(-n // cell))) for g, n in sizes.items()}
    by_digest = W.partitionBy("label", "dims").orderBy(F.xxhash64("vector"), "point")
    picked = group.withColumn("place", F.row_number().over(by_digest)).filter(
        F.col("place") <= max([1, *wanted.values()])
    ).collect()
    pivots: dict[tuple[str, int], np.ndarray] = {}
    first: dict[tuple[str, int], int] = {}
    for g in sorted(wanted):
        own = [r.vector for r in sorted(picked, key=lambda r: r.place) if (r.label, r.dims) == g][: wanted[g]]
        first[g] = sum(len(x) for x in pivots.values())
        pivots[g] = _unit(np.array(own, np.float64))
    radius = float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine))) + SLACK

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            dims = batch.column("vector").value_lengths().to_numpy()
            for g in sorted({*zip(labels.tolist(), dims.tolist(), strict=True)}):
                at = np.flatnonzero((labels == g[0]) & (dims == g[1]))
                for a in range(0, len(at), 2048):
                    part = at[a : a + 2048]
                    taken = batch.take(pa.array(part))
                    unit = _unit(_matrix(taken.column("vector")))
                    distances = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * unit @ pivots[g].T))
                    home, copies = _reach(distances, pivots[g], unit, radius)
                    yield first[g], taken, unit, home, copies

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        natives = np.zeros(sum(map(len, pivots.values())) + 1, np.int64)
        guests = natives.copy()
        for base, _, _, home, copies in place(batches):
            np.add.at(natives, base + home, 1)
            np.add.at(guests, base + copies[1], 1)
        used = np.flatnonzero(guests)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (used, natives[used], guests[used])], names=["cell", "natives", "guests"]
        )

    # One row per cell, and there are no more cells than pivots.
    held = points.mapInArrow(tally, "cell long, natives long, guests long").groupBy("cell").agg(
        F.sum("natives").alias("natives"), F.sum("guests").alias("guests")
    ).collect()
    blocks = {r.cell: (max(1, -(-r.natives // cell)), max(1, -(-r.guests // cell))) for r in held}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for base, taken, unit, home, copies in place(batches):
            point = taken.column("point").to_numpy()
            number = taken.column("copies").to_numpy()
            out: list[list] = [[], [], [], [], []]
            for i, c in zip(range(len(home)), (base + home).tolist(), strict=True):
                mine, theirs = blocks[c]
                for other in range(theirs):
                    for x, y in zip(out, (c, point[i] % mine, other, True, i), strict=True):
                        x.append(y)
            for i, c in zip(copies[0].tolist(), (base + copies[1]).tolist(), strict=True):
                mine, theirs = blocks[c]
                for own in range(mine):
                    for x, y in zip(out, (c, own, point[i] % theirs, False, i), strict=True):
                        x.append(y)
            row = np.array(out[4], np.int64)
            for a in range(0, len(row), 4096):
                part = row[a : a + 4096]
                flat = pa.array(unit[part].ravel())
                width = unit.shape[1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(out[0][a : a + 4096], pa.int64()), pa.array(out[1][a : a + 4096], pa.int32()),
                    pa.array(out[2][a : a + 4096], pa.int32()), pa.array(out[3][a : a + 4096], pa.bool_()),
                    pa.array(point[part]), pa.array(number[part]),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), flat),
                ], names=[x.split()[0] for x in COPY.split(", ")])

    def join(table: pa.Table) -> pa.Table:
        native = table.column("native").to_numpy()
        unit = _matrix(table.column("vector").combine_chunks())
        point, number = table.column("point").to_numpy(), table.column("copies").to_numpy()
        count, roots = _links(unit[native], number[native], point[native], unit[~native], number[~native], point[~native], cosine)
        links = dict(zip(point[native].tolist(), count.tolist(), strict=True))
        keys = sorted({*links, *roots})
        return pa.table({
            "point": pa.array(keys, pa.int64()), "links": pa.array([links.get(k, 0) for k in keys], pa.int64()),
            "root": pa.array([roots.get(k) for k in keys], pa.int64()),
        })

    found = stage(points.mapInArrow(deal, COPY).groupBy("cell", "own", "other").applyInArrow(join, FOUND), "near")
    linked = found.groupBy("point").agg(F.sum("links").alias("links"))
    classes = components(found.filter("point <> root").select(F.col("point").alias("u"), F.col("root").alias("v")))
    member = points.join(classes, points.point == classes.node, "left").select(
        "point", "label", "vector", "first_id", "copies", F.coalesce("component", "point").alias("class")
    )
    smallest = member.groupBy("class").agg(F.min("first_id").alias("component_id"))
    per_point = member.join(smallest, "class").join(linked, "point").select(
        "label", "vector", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    joined = rows.filter(good).join(per_point, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
