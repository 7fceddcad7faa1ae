"""Stored mergeable sketches: counts, distinct users and latency percentiles per run and hour, merged for any level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12  # of the distinct counts: an error of about 1.6 %
KLL_K = 400  # of the percentiles: ranks within about 0.7 %


def sketch_hours(log: DataFrame, by: Sequence[str], *, ts: str = "ts", user: str = "user_id", value: str = "latency_ms") -> DataFrame:
    """`hour`, the columns of `by`, `requests`, and sketches of the users and of the values: the table to be stored.

    An hour that is complete is never read again: later hours are appended. Null users and values are not counted.
    """
    return log.groupBy(F.date_trunc("hour", ts).alias("hour"), *by).agg(
        F.count(F.lit(1)).alias("requests"), F.hll_sketch_agg(user, LG_K).alias("users"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K).alias("values"),
    )


def from_sketches(stored: DataFrame, levels: Sequence, percentiles: Mapping[str, float]) -> DataFrame:
    """`requests`, `users` and the percentiles for each of the `levels`, from the stored sketches alone.

    The sketches of a level are merged on the map side, a few kilobytes each, however many rows they stand for.
    """
    merged = stored.groupBy(*levels).agg(
        F.sum("requests").alias("requests"), F.hll_union_agg("users").alias("users"), F.kll_merge_agg_double("values").alias("values")
    )
    known = F.kll_sketch_get_n_double("values") > 0
    quantiles = [F.when(known, F.kll_sketch_get_quantile_double("values", F.lit(float(p)))).alias(name) for name, p in percentiles.items()]
    return merged.withColumn("users", F.hll_sketch_estimate("users")).select("*", *quantiles).drop("values")
