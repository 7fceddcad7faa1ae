"""Exact ranks by levels: counters of a few bits of a key at a time, descending only into the cells that hold a rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from evalloom.session import stage

BITS, LEVELS = 16, 4
COUNTERS = 1 << BITS
LEAST_EXPONENT = -1020


def ordered_key(df: DataFrame, value: str) -> Column:
    """A 64-bit whole number that does not fall when the value rises; null for null.

    Whole numbers are their own key. For others it holds exponent and fraction like a floating-point number does, so
    that 16 bits at a time tell values apart whatever their spread. A few neighbouring values may share one.
    """
    if isinstance(df.schema[value].dataType, IntegralType):
        return F.col(value).cast("bigint")
    x = F.col(value).cast("double")
    size = F.abs(x)
    exponent = F.greatest(F.coalesce(F.floor(F.log2(F.when(size > 0, size))), F.lit(LEAST_EXPONENT)), F.lit(LEAST_EXPONENT))
    # Halves of the power, so that neither of them leaves the range of a double.
    half = F.floor(exponent / 2)
    fraction = size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), exponent - half)
    whole = (exponent - LEAST_EXPONENT + 2).cast("bigint") * (1 << 52) + F.floor(fraction * 2.0**50)
    signed = F.when(x < 0, -whole).otherwise(whole)
    top = F.lit(2**63 - 1)
    return F.when(F.isnan(x), top).when(size == float("inf"), F.when(x > 0, top - 1).otherwise(-top)).when(x.isNotNull(), signed)


def values_at(counted: DataFrame, ranks: Column) -> DataFrame:
    """`group, rank, value` for the ranks (from 0) wanted of each group.

    `counted` is a stored table of `group, key, value, n`: how often each distinct value occurs. `ranks` gets the
    number of values of a group as the column `total` and is an array. A level counts 16 bits of the key within the
    cells found so far; a window never sees more than the 65,536 counters of one cell. As soon as no cell holds more
    distinct values than that, the values themselves are ranked.
    """
    cells = None
    for level in range(LEVELS + 1):
        if cells is None:
            inside = counted.select("*", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before"))
        else:
            held = cells.select("group", "prefix", "before").distinct()
            inside = counted.withColumn("prefix", F.shiftright("key", 64 - BITS * level)).join(held, ["group", "prefix"])
        last = level == LEVELS or (cells is not None and (cells.agg(F.max("distinct")).first()[0] or 0) <= COUNTERS)
        cell = ["group", "prefix", "before"]
        if last:
            counters = inside.select(*cell, F.col("value").alias("next"), "n", F.lit(1).alias("distinct"))
        else:
            bits = F.shiftright("key", 64 - BITS * (level + 1)).alias("next")
            counters = inside.groupBy(*cell, bits).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"))
        through = F.sum("n").over(W.partitionBy(*cell).orderBy("next").rowsBetween(W.unboundedPreceding, 0))
        counters = counters.withColumn("through", F.col("before") + through)
        if cells is None:
            counters = counters.withColumn("total", F.sum("n").over(W.partitionBy(*cell)))
            placed = counters.withColumn("rank", F.explode(ranks))
        else:
            placed = counters.join(cells.select("group", "prefix", "rank"), ["group", "prefix"])
        found = placed.filter((F.col("rank") < F.col("through")) & (F.col("rank") >= F.col("through") - F.col("n")))
        if last:
            return found.select("group", "rank", F.col("next").alias("value"))
        cells = stage(found.select(
            "group", F.col("next").alias("prefix"), "rank", (F.col("through") - F.col("n")).alias("before"), "distinct"
        ), "cells")
    raise AssertionError("the last level returns")


def count_values(df: DataFrame, by: Sequence[str], value: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Each distinct value of a group once: `group, key, value, n`, and the `sums` of its rows; stored.

    The one pass over the rows; counts are folded before they are shuffled. Groups may have null names, and null
    values are counted as well.
    """
    group = F.struct(F.lit(0).alias("all"), *[F.col(f"`{c}`").alias(c) for c in by]).alias("group")
    aggregates = [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in (sums or {}).items()]]
    key = ordered_key(df, value).alias("key")
    return stage(df.groupBy(group, key, F.col(value).alias("value")).agg(*aggregates), "counted")


def percentiles_of(counted: DataFrame, by: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles per group from `count_values`; null values do not count."""
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probabilities.items()])
    known = counted.filter("value IS NOT NULL").select("group", "key", "value", "n")
    spot = (F.col("total") - 1) * F.col("w.p")
    both = F.array_distinct(F.flatten(F.transform(names, lambda w: F.array(
        F.floor((F.col("total") - 1) * w["p"]), F.ceil((F.col("total") - 1) * w["p"])
    ))))
    at = stage(values_at(known, both), "ranked")
    totals = known.groupBy("group").agg(F.sum("n").alias("total"))
    wanted = totals.select("group", "total", F.explode(names).alias("w")).select(
        "group", F.col("w.name").alias("name"), spot.alias("spot")
    )
    met = wanted.join(at, "group").filter((F.col("rank") == F.floor("spot")) | (F.col("rank") == F.ceil("spot")))
    ends = met.groupBy("group", "name", "spot").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("spot") - F.floor("spot"))
    columns = [F.max(F.when(F.col("name") == name, between)).alias(name) for name in probabilities]
    return ends.groupBy("group").agg(*columns).select(*[F.col("group")[c].alias(c) for c in by], *probabilities)
