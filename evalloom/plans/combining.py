"""Joins, merges and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom import sources as S
from evalloom.functions import text as X
from evalloom.operators import evalset as E
from evalloom.operators import joins as J
from evalloom.operators import monitoring as MO
from evalloom.operators import predicates as P
from evalloom.operators import traces as T
from evalloom.plans.base import EVALS, LOG, eval_rows, query, request_log
from evalloom.session import scratch_path, stage
from evalloom.sources import load

# Unjudged requests are those without a rating; the error events stand for human feedback.
STATUS = f"""{LOG}, status AS (
  SELECT request_id, ts, version, CASE WHEN rating IS NOT NULL THEN 'run-1' END AS run_id FROM log),
  as_of AS (SELECT max(ts) AS t FROM log)"""
FEEDBACK = """feedback AS (
  SELECT request_id FROM status WHERE run_id IS NULL AND request_id IN (
    SELECT event_id FROM events, as_of WHERE event_type = 'error' AND ts >= t - INTERVAL 14 DAY))"""
SAMPLED = """sampled AS (
  SELECT request_id FROM status, as_of WHERE run_id IS NULL AND ts >= t - INTERVAL 14 DAY
    AND CAST('0x' || substr(md5('7:' || request_id), 1, 8) AS BIGINT) < 0.3 * 4294967296)"""
SELECTED = f"""{STATUS}, {FEEDBACK}, {SAMPLED},
  selected AS (SELECT request_id FROM sampled UNION SELECT request_id FROM feedback)"""


def status_log(spark: SparkSession, base: str) -> DataFrame:
    log = request_log(spark, base).withColumn("run_id", F.when(F.col("rating").isNotNull(), F.lit("run-1")))
    return log.select("request_id", "ts", "version", "run_id")


def assessments(spark: SparkSession, base: str) -> DataFrame:
    errors = load(spark, "events", base).filter("event_type = 'error'")
    return errors.select(F.col("event_id").alias("request_id"), "ts")


def selected_requests(spark: SparkSession, base: str) -> DataFrame:
    as_of = P.latest(load(spark, "events", base), "ts")
    return MO.select_requests(
        status_log(spark, base), assessments(spark, base), as_of, days=14, ts="ts", seed=7
    )


@query("feedback_join", f"WITH {STATUS}, {FEEDBACK} SELECT request_id FROM feedback")
def feedback_join(spark: SparkSession, base: str) -> DataFrame:
    as_of = P.latest(load(spark, "events", base), "ts")
    return J.with_feedback(status_log(spark, base), assessments(spark, base), as_of, ts="ts", days=14)


@query(
    "mark_selected",
    f"""WITH {SELECTED} SELECT request_id, version,
        CASE WHEN request_id IN (SELECT request_id FROM selected) THEN 'to_process' ELSE run_id END AS run_id
        FROM status""",
)
def mark_selected(spark: SparkSession, base: str) -> DataFrame:
    marked = J.mark(status_log(spark, base), selected_requests(spark, base), K.TO_PROCESS)
    return marked.select("request_id", "version", "run_id")


@query("selected_union", f"WITH {SELECTED} SELECT request_id FROM selected")
def selected_union(spark: SparkSession, base: str) -> DataFrame:
    return selected_requests(spark, base)


@query(
    "status_transition",
    f"""WITH {SELECTED} SELECT request_id, CASE WHEN run_id IS NOT NULL THEN run_id
        WHEN request_id IN (SELECT request_id FROM selected) THEN 'to_process' ELSE 'skipped' END AS run_id
        FROM status""",
)
def status_transition(spark: SparkSession, base: str) -> DataFrame:
    advanced = T.advance_status(status_log(spark, base), selected_requests(spark, base))
    return advanced.select("request_id", "run_id")


@query(
    "merge_matched",
    f"""WITH {LOG}, updates AS (
          SELECT request_id, CASE WHEN tokens >= 10 THEN latency_ms END AS latency_ms, rating AS verdict
          FROM log WHERE version = 'error')
        SELECT l.request_id, l.version, u.verdict,
          CASE WHEN u.request_id IS NOT NULL THEN u.latency_ms ELSE l.latency_ms END AS latency_ms
        FROM log l LEFT JOIN updates u ON l.request_id = u.request_id""",
)
def merge_matched(spark: SparkSession, base: str) -> DataFrame:
    log = request_log(spark, base)
    updates = log.filter("version = 'error'").select(
        "request_id",
        F.when(F.col("tokens") >= 10, F.col("latency_ms")).alias("latency_ms"),
        F.col("rating").alias("verdict"),
    )
    return J.merge_matched(log.select("request_id", "version", "latency_ms"), updates, "request_id")


@query(
    "stored_merge",
    f"""WITH {LOG}, updates AS (
          SELECT request_id, CASE WHEN tokens >= 10 THEN latency_ms END AS latency_ms, rating AS verdict
          FROM log WHERE version = 'error' AND date > (SELECT max(date) FROM log) - INTERVAL 5 DAY)
        SELECT l.request_id, CAST(l.date AS VARCHAR) AS date, l.version, u.verdict,
          CASE WHEN u.request_id IS NOT NULL THEN u.latency_ms ELSE l.latency_ms END AS latency_ms
        FROM log l LEFT JOIN updates u ON l.request_id = u.request_id""",
)
def stored_merge(spark: SparkSession, base: str) -> DataFrame:
    """Verdicts of the last days merged into the log stored by date; the partitions of other days are not written."""
    log, path = request_log(spark, base), scratch_path(spark, "log")
    log.select("request_id", "date", "version", "latency_ms").write.partitionBy("date").parquet(path)
    latest = log.agg(F.max("date")).scalar()
    updates = log.filter((F.col("version") == "error") & (F.col("date") > F.date_sub(latest, 5))).select(
        "request_id", F.when(F.col("tokens") >= 10, F.col("latency_ms")).alias("latency_ms"), F.col("rating").alias("verdict")
    )
    S.merge_stored(path, stage(updates, "updates"), "request_id", lambda rows, new: J.merge_matched(rows, new, "request_id"))
    return S.read_stored(spark, path).withColumn("date", F.col("date").cast("string"))


@query(
    "merge_set_expr",
    f"""WITH {LOG} SELECT request_id, version, CASE WHEN rating = 'no' THEN upper(version) END AS topic FROM log""",
)
def merge_set_expr(spark: SparkSession, base: str) -> DataFrame:
    log = request_log(spark, base)
    failed = log.filter("rating = 'no'").select("request_id")
    target = log.select("request_id", "version")
    return J.merge_set(target, failed, "request_id", "topic", F.upper("version"))


@query(
    "remaining_docs_anti",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def remaining_docs_anti(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, "documents", base).select("doc_id", "lang", "n_chars")
    return J.remaining_docs(docs, load(spark, "labels", base), "doc_id", "doc_id")


@query(
    "eval_source_join",
    f"""WITH {EVALS} SELECT e.request_id, e.source_id, l.quality, l.toxic
        FROM evals e LEFT JOIN labels l ON e.source_id = CAST(l.doc_id AS VARCHAR)""",
)
def eval_source_join(spark: SparkSession, base: str) -> DataFrame:
    labelled = load(spark, "labels", base).withColumn("doc_id", F.col("doc_id").cast("string"))
    evals = eval_rows(spark, base).select("request_id", "source_id")
    return J.with_source(evals, labelled, uri="doc_id").select("request_id", "source_id", "quality", "toxic")


@query(
    "compare_runs",
    """WITH b AS (SELECT doc_id, quality = 1 AS before FROM labels),
            a AS (SELECT doc_id, n_chars >= 1000 AS after FROM documents WHERE lang <> 'en')
       SELECT doc_id, before, after,
         CASE WHEN a.doc_id IS NULL THEN 'only_before' WHEN b.doc_id IS NULL THEN 'only_after'
              WHEN before IS NULL OR after IS NULL THEN 'unknown' WHEN before = after THEN 'same'
              WHEN after THEN 'better' ELSE 'worse' END AS change
       FROM b FULL JOIN a USING (doc_id)""",
)
def compare_runs(spark: SparkSession, base: str) -> DataFrame:
    before = load(spark, "labels", base).select("doc_id", (F.col("quality") == 1).alias("passed"))
    after = load(spark, "documents", base).filter("lang <> 'en'")
    return J.compare_runs(before, after.select("doc_id", (F.col("n_chars") >= 1000).alias("passed")), "doc_id")


@query(
    "add_evals",
    f"""WITH {EVALS}, have AS (SELECT request_id, request, source_id FROM evals WHERE review_status = 'ACCEPTED'),
        made AS (SELECT sha256('Summarise ' || lang || chr(10) || source) AS request_id,
                 'Summarise ' || lang AS request, source AS source_id FROM documents GROUP BY lang, source),
        more AS (SELECT request_id, request, source_id FROM evals UNION SELECT * FROM made)
        SELECT request_id, request, source_id FROM have UNION ALL
        SELECT * FROM more WHERE request_id NOT IN (SELECT request_id FROM have)""",
)
def add_evals(spark: SparkSession, base: str) -> DataFrame:
    rows = eval_rows(spark, base).select("request_id", "request", "source_id", "review_status")
    have = P.by_review_status(rows, "ACCEPTED").drop("review_status")
    unnamed = load(spark, "documents", base).select(
        F.lit(None).cast("string").alias("request_id"),
        F.concat(F.lit("Summarise "), F.col("lang")).alias("request"),
        F.col("source").alias("source_id"),
    )
    return E.add_evals(have, rows.drop("review_status").unionByName(unnamed))


@query(
    "source_type",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN 'HUMAN_SOURCE' WHEN lang = 'fr' THEN 'SYNTHETIC_FROM_DOC'
       WHEN lang = 'de' THEN 'HUMAN_SOURCE' END AS source_type FROM documents""",
)
def source_type(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, "documents", base)
    first = F.when(F.col("lang") == "en", "HUMAN review").when(F.col("lang") == "fr", "Synthetic docs").otherwise("")
    second = F.when(F.col("lang") == "de", "a human and a synthetic source").otherwise("crawl")
    return docs.select("doc_id", X.source_type(first, second).alias("source_type"))
