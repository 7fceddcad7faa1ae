"""Rows in one order over all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.session import stage

SHIFT = 33  # monotonically_increasing_id holds the partition above this bit, and the row in it below


def in_order(df: DataFrame, *keys: str, name: str = "at") -> DataFrame:
    """The table sorted by `keys` (nulls first) and stored, with `name` rising in that order.

    The sort deals ranges of the keys to its tasks, so a key that many rows share is cut like any other range.
    Within a task the numbers are consecutive, and so are those of rows next to each other in one task.
    """
    return stage(df.orderBy(*keys).withColumn(name, F.monotonically_increasing_id()), "ordered")


def dense(ordered: DataFrame, at: str = "at", name: str = "position") -> DataFrame:
    """`name` counts the rows of `in_order` from 0 without gaps.

    The only window without a key runs over one row per task of the sort.
    """
    part = F.shiftrightunsigned(at, SHIFT).alias("__part")
    sizes = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    in_part = F.col(at).bitwiseAND(F.lit((1 << SHIFT) - 1))
    return (
        ordered.withColumn("__part", part).join(starts, "__part")
        .withColumn(name, F.col("__before") + in_part).drop("__part", "__before")
    )
