"""Windowed and de-duplicated streams. Event time must be TIMESTAMP; watermarks refuse TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalloom.functions.text import pass_flag


def stream_dedup(df: DataFrame, key: str = "request_id", ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Drop repeats of a request that arrive within `delay` of the first; state older than that is freed."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def hourly_counts(df: DataFrame, *by: str, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Requests per clock hour. An hour comes out once the watermark has passed its end."""
    counted = df.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour"), *by)
    return counted.agg(F.count(F.lit(1)).alias("requests")).select(
        F.col("window.start").alias("hour"), *by, "requests"
    )


def sliding_pass_rate(
    df: DataFrame, *by: str, ts: str = "ts", rating: str = "rating", width: str = "1 day",
    slide: str = "1 hour", delay: str = "1 hour",
) -> DataFrame:
    """Pass rate over the last `width`, every `slide`.

    Rows are folded into one tumbling window per `slide` first; only those few are then copied into
    every sliding window they belong to.
    """
    folded = df.withWatermark(ts, delay).groupBy(F.window(ts, slide), *by).agg(
        F.count(pass_flag(rating)).alias("judged"), F.sum(pass_flag(rating)).alias("passed")
    )
    windows = folded.groupBy(F.window(F.window_time("window"), width, slide), *by)
    return windows.agg(F.sum("judged").alias("judged"), F.sum("passed").alias("passed")).select(
        F.col("window.end").alias("until"),
        *by,
        "judged",
        (F.col("passed") / F.nullif(F.col("judged"), F.lit(0))).alias("pass_rate"),
    )
