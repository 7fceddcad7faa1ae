"""Hard negatives by a search in packed R-trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.llm.ordering import dense, in_order
from evalloom.session import stage

TILE = 4096  # vectors of a tree
PAGE = 32  # vectors of a leaf
FANOUT = 8
BLOCK = 512  # anchors that meet a tree at once
EXACT = 2**53  # integers below are exact in double precision
LAST = np.iinfo(np.int64).max  # stands for a null id, which comes after all others
PAGES = (
    "dims int, tile long, label {label}, page int, point array<long>, id array<long>, low array<long>, high array<long>, vectors array<long>"
)
FOUND = "anchor long, window int, score long, point long, id long"


def packed(points: np.ndarray, rows: np.ndarray, page: int = PAGE) -> list[np.ndarray]:
    """The rows in sort-tile-recursive order, cut into pages.

    The coordinates are taken by falling spread: sort by one, cut into slices, and treat each slice by the next.
    """
    spread = np.argsort(-np.ptp(points[rows], axis=0), kind="stable") if points.shape[1] else np.empty(0, int)

    def cut(part: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        pages = -(-len(part) // page)
        if pages <= 1 or depth == len(spread):
            yield from (part[a : a + page] for a in range(0, len(part), page))
            return
        slices = int(np.ceil(round(pages ** (1 / (len(spread) - depth)), 9)))
        size = page * -(-pages // slices)
        part = part[np.argsort(points[part, spread[depth]], kind="stable")]
        for a in range(0, len(part), size):
            yield from cut(part[a : a + size], depth + 1)

    return list(cut(rows, 0))


class Forest:
    """One R-tree per label over the pages of a tile: bounding boxes of pages, of groups of pages, up to a root."""

    def __init__(self, labels: list, low: np.ndarray, high: np.ndarray) -> None:
        lows, highs, self.children, self.roots = [*low], [*high], [()] * len(labels), {}
        starts = [0, *(i + 1 for i, (a, b) in enumerate(pairwise(labels)) if a != b), len(labels)]
        for a, b in pairwise(starts):
            level = list(range(a, b))
            while len(level) > 1:
                above = []
                for i in range(0, len(level), FANOUT):
                    part = level[i : i + FANOUT]
                    above.append(len(lows))
                    lows.append(np.min([lows[x] for x in part], axis=0))
                    highs.append(np.max([highs[x] for x in part], axis=0))
                    self.children.append(tuple(part))
                level = above
            self.roots[labels[a]] = level[0]
        self.low, self.high = np.array(lows), np.array(highs)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest inner product of each anchor with any point of each box.

        Coordinate by coordinate, one end of the box's interval gives the least product and the other the greatest.
        """
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


def nearest(forest: Forest, roots: list[int], least: list, most: list, scores, low: int | None, high: int | None, k: int, own: int) -> list:
    """The first k (-score, id, point) with low <= score <= high, by a queue of boxes with the greatest bound first.

    A box that lies outside the window is dropped; once the best box in the queue is strictly below the k-th score,
    nothing better is left. Boxes that reach the k-th score are opened, since a smaller id wins a tie.
    """
    queue = [(-most[r], r) for r in roots]
    heapq.heapify(queue)
    found: list = []
    while queue:
        bound, node = heapq.heappop(queue)
        if len(found) == k and -bound < -found[-1][0]:
            break
        if (low is not None and -bound < low) or (high is not None and least[node] > high):
            continue
        if forest.children[node]:
            for child in forest.children[node]:
                heapq.heappush(queue, (-most[child], child))
            continue
        more = [
            (-score, i, point) for score, i, point in scores(node)
            if point != own and (low is None or score >= low) and (high is None or score <= high)
        ]
        if more:
            found = sorted(found + more)[:k]
    return found


def _numbers(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _pack(table: pa.Table) -> pa.Table:
    """The rows of one tile as pages, each of one label."""
    points = _numbers(table.column("vector"), len(table))
    labels = table.column("label").to_pylist()
    number, ids = table.column("point").to_numpy(), table.column("id").fill_null(int(LAST)).to_numpy()
    order = sorted(set(labels))
    place = {x: i for i, x in enumerate(order)}
    codes = np.array([place[x] for x in labels])
    out: list[list] = [[] for _ in range(9)]
    for code, label in enumerate(order):
        for part in packed(points, np.flatnonzero(codes == code)):
            own = points[part]
            row = (
                points.shape[1], table.column("tile")[0].as_py(), label, len(out[0]), number[part], ids[part],
                own.min(axis=0), own.max(axis=0), own.ravel(),
            )
            for x, y in zip(out, row, strict=True):
                x.append(y)
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.int64(), table.schema.field("label").type, pa.int32(), *[longs] * 5]
    return pa.table([pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], names=[
        "dims", "tile", "label", "page", "point", "id", "low", "high", "vectors"
    ])


def _search(same: bool, k: int):
    """Search a tile for a block of anchors: among their own label, or among all others."""

    def run(pages: pa.Table, probes: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(pages) and len(probes):
            pages = pages.sort_by("page")
            labels = pages.column("label").to_pylist()
            low, high = (_numbers(pages.column(x), len(pages)) for x in ("low", "high"))
            dims = low.shape[1]
            anchors = _numbers(probes.column("vector"), len(probes))
            exact = max(1, dims) * (int(np.abs(low).max(initial=0)) + int(np.abs(high).max(initial=0))) * int(np.abs(anchors).max(initial=0)) < EXACT
            kind = np.float64 if exact else object
            forest = Forest(labels, low.astype(kind), high.astype(kind))
            anchors = anchors.astype(kind)
            ids, points = pages.column("id").to_pylist(), pages.column("point").to_pylist()
            flat = pages.column("vectors").combine_chunks()
            leaves = [flat[i].values.to_numpy(zero_copy_only=False).reshape(len(x), dims).astype(kind) for i, x in enumerate(ids)]
            least, most = (np.asarray(x) for x in forest.bounds(anchors))
            for a, (own, label, windows) in enumerate(zip(*(probes.column(x).to_pylist() for x in ("anchor", "label", "windows")), strict=True)):
                roots = [r for x, r in forest.roots.items() if (x == label) == same]
                if not roots:
                    continue
                opened: dict[int, list] = {}

                def scores(leaf: int, a: int = a, opened: dict = opened) -> list:
                    if leaf not in opened:
                        opened[leaf] = list(zip((leaves[leaf] @ anchors[a]).tolist(), ids[leaf], points[leaf], strict=True))
                    return opened[leaf]

                least_a, most_a = least[a].tolist(), most[a].tolist()
                for w in windows:
                    for negated, i, point in nearest(forest, roots, least_a, most_a, scores, w["low"], w["high"], k, own):
                        out.append((own, w["window"], int(-negated), point, None if i == LAST else i))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["anchor", "window", "score", "point", "id"])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each window over all tiles, with their `rank`."""
    order = W.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "point")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def index(rows: DataFrame, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """The rows `label, id, vector` with their `point`, `dims` and `tile`; and the stored pages of all trees.

    Rows are sorted by length, label and first coordinate, and cut into tiles of `tile` rows: the first slices of the
    packing. A task packs one tile.
    """
    first = F.when(F.size("vector") > 0, F.col("vector")[0])
    ordered = in_order(rows.withColumn("dims", F.size("vector")).withColumn("first", first), "dims", "label", "first", "id")
    placed = dense(ordered, name="point").drop("at", "first")
    starts = placed.groupBy("dims").agg(F.min("point").alias("start"))
    tiled = stage(placed.join(starts, "dims").withColumn("tile", F.expr(f"(point - start) div {tile}")).drop("start"), "tiled")
    kind = rows.schema["label"].dataType.simpleString()
    pages = tiled.select("dims", "tile", "label", "point", "id", "vector").groupBy("dims", "tile").applyInArrow(_pack, PAGES.format(label=kind))
    return tiled, stage(pages, "pages")


def mine(
    vectors: DataFrame, anchor: Column, *, key: str = "vec_id", label: str = "label", vector: str = "vector", positives: int = 5,
    negatives: int = 5, least: int = 80, most: int = 100, tile: int = TILE, block: int = BLOCK,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`: hard negatives of all anchors.

    A score is the inner product of whole-number vectors; higher scores come first, then smaller ids. The positives of
    an anchor are its first `positives` other rows of its label, the negatives of a positive the first `negatives` rows
    of other labels with `least` % to `most` % of the positive's score. All anchors meet all trees of vectors of their
    length in blocks, once for the positives (trees that hold their label) and once for the negatives (trees that hold
    others); a tree gives at most the wanted rows for each window, so a task holds one tile and one block.

    Nulls: rows with a null label, a null vector or a null component take no part; a null id comes after all others; a
    null condition is no anchor. Vectors of different length have no score; empty ones score 0. Repeated rows are rows
    of their own. Scores must fit into 64 bits. Empty tables give no rows. Other columns are left out.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<long>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("wanted"),
    ).filter(F.col("label").isNotNull() & F.expr("coalesce(forall(vector, x -> x is not null), false)"))
    tiled, pages = index(rows, tile)
    asked = tiled.filter("wanted")
    # Per length of vectors; and the tiles of a label, which follow each other.
    counts = asked.groupBy("dims").agg(F.expr(f"int((count(1) + {block - 1}) div {block})").alias("blocks"))
    last = tiled.groupBy("dims").agg(F.max("tile").alias("last"))
    spans = tiled.groupBy("dims", "label").agg(F.min("tile").alias("from"), F.max("tile").alias("to"))
    anchors = stage(
        asked.join(counts, "dims").join(last, "dims").join(spans, ["dims", "label"])
        .withColumn("block", F.expr("int(pmod(xxhash64(point), blocks))"))
        .select("dims", "block", F.col("point").alias("anchor"), F.col("id").alias("anchor_id"), "label", "vector", "from", "to", "last"),
        "anchors",
    )
    copies = pages.join(counts, "dims").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def meet(probes: DataFrame, same: bool, k: int) -> DataFrame:
        keys = ["dims", "tile", "block"]
        sent = probes.select(*keys, "anchor", "label", "vector", "windows")
        met = copies.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(_search(same, k), FOUND)
        return stage(_first(met, k), "found")

    window = "struct<window: int, low: long, high: long>"
    anyone = F.array(F.struct(F.lit(0), F.lit(None), F.lit(None)).cast(window)).alias("windows")
    own = anchors.select("*", anyone, F.explode(F.sequence("from", "to")).alias("tile"))
    best = meet(own, True, positives).select(
        "anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # Of whole numbers: the least n with 100 n >= least * score, the greatest with 100 n <= most * score.
    score = F.col("positive_score").cast("decimal(20,0)")
    low, high = F.ceil(score * least / 100).cast("long"), F.floor(score * most / 100).cast("long")
    asked_for = best.filter((most - least) * F.signum("positive_score") >= 0).groupBy("anchor").agg(
        F.collect_list(F.struct(F.col("place"), low, high).cast(window)).alias("windows")
    )
    # All tiles but those that lie within the anchor's label.
    others = F.expr("filter(sequence(0, last), t -> t <= `from` or t >= `to`)")
    away = anchors.join(asked_for, "anchor").withColumn("tile", F.explode(others))
    worst = meet(away, False, negatives).select(
        "anchor", F.col("window").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return worst.join(best, ["anchor", "place"]).join(anchors.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def whole_numbers(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if one is null or not a finite number."""
    finite = f"forall({vector}, x -> x is not null and not isnan(x) and abs(double(x)) < double('infinity'))"
    return F.expr(f"case when {finite} then transform({vector}, x -> floor({scale} * double(x))) end")
