"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalloom.session import stage

EDGES = "u long, v long"


def forest(u: list[int], v: list[int]) -> dict[int, int]:
    """The smallest node reachable from each node of some links."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for a, b in zip(u, v, strict=True):
        a, b = top(a), top(b)
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    return {x: top(x) for x in parent}


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of links as stars: not more links than nodes, and the same components."""
    for batch in batches:
        found = forest(batch.column("u").to_pylist(), batch.column("v").to_pylist())
        stars = [(x, top) for x, top in found.items() if x != top]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in stars], pa.int64()) for i in (0, 1)], names=["u", "v"]
        )


def components(links: DataFrame) -> DataFrame:
    """`node, component` for every node of the links `u, v`; the component is its smallest node.

    Stars are contracted until nothing changes: every node is linked with the smallest of its neighbourhood, first
    from above, then from below. The state is written to the shared folder after each round, so a round needs only
    the one before it. Links with a null end are no links.
    """
    links = links.filter("u is not null and v is not null").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    state = stage(links.mapInArrow(_shrink, EDGES).filter("u <> v").distinct(), "links")
    mark = F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    now, before = state.agg(*mark).first(), None
    while now[0] and now != before:
        both = state.union(state.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
        )).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        state = stage(small, "links")
        now, before = state.agg(*mark).first(), now
    stars = state.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
