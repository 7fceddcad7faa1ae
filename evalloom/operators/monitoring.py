"""The monitoring cycle: pick requests, judge them, and write the verdicts back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.operators.joins import merge_matched, with_feedback
from evalloom.operators.metrics import dedup_first
from evalloom.operators.predicates import since, unprocessed
from evalloom.operators.sampling import cap_per_hour, hash_draw, hash_sample
from evalloom.operators.traces import advance_status
from evalloom.session import stage
from evalloom.sources import merge_stored, read_stored


def select_requests(
    log: DataFrame, assessments: DataFrame, as_of: Column, *, rate: float = K.SAMPLE_RATE,
    days: int = K.LOOKBACK_DAYS, ts: str = "timestamp", seed: int = 0,
) -> DataFrame:
    """Ids to judge: a sample of the recent unprocessed requests, and all that got human feedback."""
    fresh = since(unprocessed(log), ts, as_of, days)
    sampled = hash_sample(fresh, rate, "request_id", seed).select("request_id")
    return sampled.union(with_feedback(log, assessments, as_of, ts=ts, days=days)).distinct()


def run_cycle(
    log: DataFrame, assessments: DataFrame, as_of: Column, judge: Callable[[DataFrame], DataFrame],
    run_id: str, *, rate: float = K.SAMPLE_RATE, days: int = K.LOOKBACK_DAYS, cap: int = K.HOURLY_CAP,
    ts: str = "timestamp", seed: int = 0,
) -> DataFrame:
    """The log after one cycle.

    Unprocessed requests that are not picked become `skipped`; picked ones are judged, at most `cap` per
    hour, and get the run id and the columns `judge` returns for them; picked ones over the cap stay
    `to_process` and are judged by a later cycle. `judge` gets one row per request id and must keep it.

    The picked ids and the verdicts are staged: ids are read twice, and judging costs too much to be
    repeated when a task is lost.
    """
    picked = stage(select_requests(log, assessments, as_of, rate=rate, days=days, ts=ts, seed=seed), "picked")
    marked = advance_status(log, picked)
    waiting = marked.filter(F.col("run_id") == K.TO_PROCESS)
    # Rows of one request with one time are told apart by their content, so that the choice repeats.
    content = F.xxhash64(*[F.col(f"`{name}`") for name, kind in waiting.dtypes if "map<" not in kind])
    once = dedup_first(waiting, "request_id", F.col(ts), content)
    judged = judge(cap_per_hour(once, cap, ts=ts, seed=seed)).withColumn("run_id", F.lit(run_id))
    return merge_matched(marked, stage(judged, "verdicts"), "request_id")


def run_stored_cycle(
    path: str, assessments: DataFrame, as_of: Column, judge: Callable[[DataFrame], DataFrame], run_id: str, *,
    rate: float = K.SAMPLE_RATE, days: int = K.LOOKBACK_DAYS, cap: int = K.HOURLY_CAP, ts: str = "timestamp", seed: int = 0,
    partition_by: str = "date",
) -> list:
    """One cycle over the log stored at `path` by date, and the partitions that were rewritten.

    What happens to the requests is as in `run_cycle`. The log is read once for the choice: an unprocessed request is
    picked if its digest falls under the rate and it is recent, or if it got recent feedback. All changes, the new states
    and the verdicts, are one table of updates with one row per request id, merged into the partitions that hold them.
    """
    spark = assessments.sparkSession
    log = read_stored(spark, path)
    heard = since(assessments, ts, as_of, days).select("request_id").distinct().withColumn("__heard", F.lit(True))
    open_rows = log.filter(F.col("run_id").isNull() | (F.col("run_id") == K.TO_PROCESS)).join(heard, "request_id", "left")
    drawn = hash_draw("request_id", seed) < F.lit(rate) * 4294967296
    recent = F.col(ts) >= as_of - F.expr(f"INTERVAL {int(days)} DAYS")
    picked = F.coalesce((drawn & recent) | F.col("__heard"), F.lit(False)) | F.col("run_id").isNotNull()
    state = F.when(picked, F.lit(K.TO_PROCESS)).otherwise(F.lit(K.SKIPPED))
    content = F.xxhash64(*[F.col(f"`{name}`") for name, kind in log.dtypes if "map<" not in kind])
    # Rows of one request differ in time at most: if one of them is picked, the request is.
    marked = stage(dedup_first(open_rows.withColumn("run_id", state), "request_id", F.desc("run_id"), F.col(ts), content).drop("__heard"), "marked")
    waiting = marked.filter(F.col("run_id") == K.TO_PROCESS)
    judged = stage(judge(cap_per_hour(waiting, cap, ts=ts, seed=seed)).withColumn("run_id", F.lit(run_id)), "verdicts")
    updates = merge_matched(marked.select("request_id", "run_id"), judged, "request_id")

    def merge(rows: DataFrame, new: DataFrame) -> DataFrame:
        # Rows that were judged before keep what they have, even if a later row of their request was not.
        later = merge_matched(rows.filter(F.col("run_id").isNull() | (F.col("run_id") == K.TO_PROCESS)), new, "request_id")
        return later.unionByName(rows.filter(F.col("run_id") != K.TO_PROCESS), allowMissingColumns=True)

    return merge_stored(path, stage(updates, "updates"), "request_id", merge, partition_by=partition_by)
