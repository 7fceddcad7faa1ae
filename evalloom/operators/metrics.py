"""Aggregations over judged rows and request logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.functions.text import pass_flag, words
from evalloom.operators.predicates import since
from evalloom.operators.ranks import count_values, percentiles_of
from evalloom.session import stage


def pass_rate(
    df: DataFrame, as_of: Column, by: Sequence[str] = (), *, rating: str = "rating", date: str = "date",
    days: int = 1,
) -> DataFrame:
    """Average pass flag per date (and `by`) over the dates from `days` before `as_of` on."""
    flagged = since(df, date, as_of, days).withColumn("pass", pass_flag(rating))
    return flagged.groupBy(date, *by).agg(F.avg("pass").alias("avg_pass_rate"))


def pass_rate_alerts(rates: DataFrame, floor: float) -> DataFrame:
    """The slices whose pass rate fell below `floor`."""
    return rates.filter(F.col("avg_pass_rate") < floor)


def rolling_pass_rate(
    df: DataFrame, days: int, by: Sequence[str] = (), *, ts: str = "ts", rating: str = "rating"
) -> DataFrame:
    """Pass rate over the `days` up to each hour.

    The rows are folded to one per hour first, so the window sorts hours and not requests.
    """
    hourly = (
        df.withColumn("pass", pass_flag(rating))
        .groupBy(F.date_trunc("hour", ts).alias("hour"), *by)
        .agg(F.sum("pass").alias("passed"), F.count("pass").alias("judged"))
    )
    window = (
        W.partitionBy(*by)
        .orderBy(F.unix_seconds(F.col("hour").cast("timestamp")))
        .rangeBetween(-(days * 86400 - 3600), 0)
    )
    return hourly.select(
        "hour", *by,
        F.sum("judged").over(window).alias("judged"),
        (F.sum("passed").over(window) / F.nullif(F.sum("judged").over(window), F.lit(0))).alias("pass_rate"),
    )


def tag_names(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Distinct tag names."""
    return df.select(F.explode(tags).alias("tag_name")).distinct()


def dedup_first(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key by `order`, which must be unique within a key.

    `row_number() = 1` plans as a group limit on both sides of the shuffle, so a hot key sends one row
    per map task.
    """
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return ranked.filter("__rank = 1").drop("__rank")


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles, by levels of counters, without holding a group in one task."""
    return percentiles_of(count_values(df, by, value), by, probabilities)


def beside(sums: DataFrame, tails: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two tables with one row per group at most, side by side; groups may have null names."""
    renamed = tails.withColumnsRenamed({c: f"__{c}" for c in by})
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`")) for c in by], F.lit(True))
    return sums.join(renamed, same, "left").drop(*[f"__{c}" for c in by])


def run_scorecard(results: DataFrame, run: str = "run_id", *, exact: bool = False) -> DataFrame:
    """Quality, cost and latency per run, from columns `rating, tokens, latency_ms`.

    Latency percentiles are sketches by default. With `exact` they are exact, and all sums follow from the counted
    latencies, so the rows are read once.
    """
    wanted = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}
    if not exact:
        sketches = [F.percentile_approx("latency_ms", p, 10000).alias(n) for n, p in wanted.items()]
        return results.groupBy(run).agg(
            F.count(F.lit(1)).alias("requests"), F.avg(pass_flag("rating")).alias("pass_rate"),
            F.sum("tokens").alias("tokens"), F.avg("latency_ms").alias("avg_latency_ms"), *sketches,
        )
    flag = pass_flag("rating")
    counted = count_values(results, [run], "latency_ms", {
        "tokens": F.col("tokens"), "passed": flag, "judged": F.when(flag.isNotNull(), 1).otherwise(0)
    })
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    sums = counted.groupBy(F.col("group")[run].alias(run)).agg(
        F.sum("n").alias("requests"), (F.sum("passed") / F.nullif(F.sum("judged"), F.lit(0))).alias("pass_rate"),
        F.sum("tokens").alias("tokens"), (F.sum(F.col("value") * known) / F.sum(known)).alias("avg_latency_ms"),
    )
    return beside(sums, percentiles_of(counted, [run], wanted), [run])


def root_causes(results: DataFrame, judges: Sequence[str]) -> DataFrame:
    """How often each judge is the first to fail, most frequent first."""
    first_failure = F.coalesce(*[F.when(F.col(j) == "no", F.lit(j)) for j in judges])
    counted = (
        results.withColumn("root_cause", first_failure)
        .filter(F.col("root_cause").isNotNull())
        .groupBy("root_cause")
        .agg(F.count(F.lit(1)).alias("failures"))
    )
    return counted.withColumn(
        "place", F.row_number().over(W.orderBy(F.desc("failures"), "root_cause"))
    )


def scorecard_rollup(results: DataFrame, *levels: str) -> DataFrame:
    """Requests and pass rate per level combination, per prefix of the levels, and in total."""
    return results.rollup(*levels).agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("requests"),
        F.avg(pass_flag("rating")).alias("pass_rate"),
    )


def top_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties by value."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(k)


def word_counts(df: DataFrame, text: str, k: int) -> DataFrame:
    """The k most frequent words of a text column."""
    return top_counts(df.select(F.explode(words(text)).alias("word")), "word", k)


def review_progress(evals: DataFrame) -> DataFrame:
    """Evaluation rows per review state; rows without one are a group of their own."""
    return evals.groupBy("review_status").agg(F.count(F.lit(1)).alias("evals"))


def profile(df: DataFrame, by: Sequence[str], user: str, size: str, *, exact: bool = False) -> DataFrame:
    """Rows, distinct users and size percentiles per group; sketches unless `exact` is set, which reads the rows once."""
    wanted = {"p50": 0.5, "p90": 0.9}
    if not exact:
        return df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"),
            F.approx_count_distinct(user).alias("users"),
            *[F.percentile_approx(size, p, 10000).alias(n) for n, p in wanted.items()],
        )
    narrow = stage(df.select(*by, user, size), "profiled")
    counted = count_values(narrow, by, size)
    users = narrow.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(user)).alias("users"))
    return beside(users, percentiles_of(counted, by, wanted), by)
