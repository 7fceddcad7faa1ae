"""Streams over the event log, run until everything available is processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom import streaming as ST
from evalloom.functions.text import pass_flag
from evalloom.operators.joins import merge_set
from evalloom.plans.base import as_text, query, sql_text
from evalloom.session import scratch_path
from evalloom.sources import load, read_stored


def _event_stream(spark: SparkSession, base: str) -> DataFrame:
    schema = load(spark, "events", base).schema
    events = ST.request_stream(spark, _source(base), schema)
    tokens = F.from_json("props", "k INT")["k"]
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        F.col("event_type").alias("version"),
        F.when(tokens >= 50, "yes").when(tokens >= 10, "no").alias("rating"),
    )


def _source(base: str) -> str:
    # File streams list folders or globs; the table may be either one file or a folder of files.
    return f"{base.rstrip('/')}/events.parque[t]"


def _collected(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """What the stream appends to its sink."""
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    ST.append_stream(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "stream_ingest",
    f"""SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS run_id, CAST(NULL AS DOUBLE) AS "{K.PRECISION_COLUMN}"
        FROM events""",
)
def stream_ingest(spark: SparkSession, base: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "requests"), scratch_path(spark, "requests-checkpoint")
    schema = load(spark, "events", base).schema
    for _ in range(2):  # the second run finds nothing new
        ST.ingest(spark, _source(base), schema, out, checkpoint)
    return spark.read.parquet(out).select("event_id", "event_type", "run_id", K.PRECISION_COLUMN)


JUDGED = """judged AS (SELECT event_id AS request_id, ts, event_type AS version,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 THEN 1
       WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 10 THEN 0 END AS pass FROM events)"""


@query(
    "stream_foreach_batch",
    f"WITH {JUDGED} SELECT version, count(*) AS requests, CAST(sum(pass) AS BIGINT) AS passed FROM judged GROUP BY version",
)
def stream_foreach_batch(spark: SparkSession, base: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "judged"), scratch_path(spark, "judged-checkpoint")

    def evaluate(batch: DataFrame) -> DataFrame:
        return batch.groupBy("version").agg(
            F.count(F.lit(1)).alias("requests"), F.sum(pass_flag("rating")).alias("passed")
        )

    ST.evaluate_batches(_event_stream(spark, base), evaluate, out, checkpoint)
    batches = spark.read.parquet(out)
    return batches.groupBy("version").agg(F.sum("requests").alias("requests"), F.sum("passed").alias("passed"))


@query(
    "stream_merge",
    f"""WITH {JUDGED} SELECT request_id, version, CAST(pass AS BIGINT) AS pass, CAST(1 AS INTEGER) AS times FROM judged""",
)
def stream_merge(spark: SparkSession, base: str) -> DataFrame:
    """Verdicts merged into the stored log batch by batch; then every batch comes again and must change nothing."""
    log, arriving, ledger = (scratch_path(spark, x) for x in ("log", "arriving", "ledger"))
    events = load(spark, "events", base)
    events.select(
        F.col("event_id").alias("request_id"), F.to_date("ts").alias("date"), F.col("event_type").alias("version"), F.lit(0).alias("times")
    ).write.partitionBy("date").parquet(log)
    events.repartition(3, "event_id").write.parquet(arriving)

    def evaluate(batch: DataFrame) -> DataFrame:
        tokens = F.from_json("props", "k INT")["k"]
        rating = F.when(tokens >= 50, "yes").when(tokens >= 10, "no")
        return batch.withColumn("rating", rating).select(F.col("event_id").alias("request_id"), pass_flag("rating").cast("bigint").alias("pass"))

    for _ in range(2):  # a new checkpoint makes the stream deliver the same batches under the same numbers
        stream = ST.request_stream(spark, arriving, events.schema, files_per_batch=1)
        ST.merge_batches(
            stream, evaluate, log, ledger, scratch_path(spark, "merge-checkpoint"), "request_id",
            merge=lambda rows, new: merge_set(rows, new, "request_id", "times", F.col("times") + 1),
        )
    return read_stored(spark, log).select("request_id", "version", "pass", "times")


@query("stream_dedup", "SELECT DISTINCT user_id FROM events")
def stream_dedup(spark: SparkSession, base: str) -> DataFrame:
    # Within 60 days, so over the whole log each user is kept once; which of their requests is open.
    once = ST.stream_dedup(_event_stream(spark, base), "user_id", delay="60 days")
    return _collected(spark, once.select("user_id"), "users")


# A window comes out once the watermark, one hour behind the last request, has passed its end.
CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


@query(
    "stream_tumbling",
    f"""SELECT {sql_text('hour')} AS hour, version, requests FROM (
          SELECT date_trunc('hour', ts) AS hour, event_type AS version, count(*) AS requests FROM events GROUP BY 1, 2)
        WHERE hour + INTERVAL 1 HOUR <= {CLOSED}""",
)
def stream_tumbling(spark: SparkSession, base: str) -> DataFrame:
    counts = _collected(spark, ST.hourly_counts(_event_stream(spark, base), "version"), "hours")
    return counts.select(as_text("hour").alias("hour"), "version", "requests")


@query(
    "stream_sliding",
    f"""WITH {JUDGED}, hourly AS (
          SELECT date_trunc('hour', ts) AS hour, count(pass) AS judged, sum(pass) AS passed FROM judged GROUP BY 1),
        ends AS (SELECT hour, judged, passed, hour + unnest(range(1, 25)) * INTERVAL 1 HOUR AS until FROM hourly),
        closed AS (SELECT * FROM ends WHERE hour + INTERVAL 1 HOUR <= {CLOSED})
        SELECT {sql_text('until')} AS until, CAST(sum(judged) AS BIGINT) AS judged,
          round(sum(passed) / nullif(sum(judged), 0), 6) AS pass_rate
        FROM closed WHERE until <= {CLOSED} GROUP BY until""",
)
def stream_sliding(spark: SparkSession, base: str) -> DataFrame:
    rates = _collected(spark, ST.sliding_pass_rate(_event_stream(spark, base)), "sliding")
    return rates.select(as_text("until").alias("until"), "judged", F.round("pass_rate", 6).alias("pass_rate"))
