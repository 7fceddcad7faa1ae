"""Registry, and the views of the test tables that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions import text as X
from evalloom.sources import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


# --- SQL pieces -----------------------------------------------------------------------------------

SPACE = K.PY_SPACE


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def sql_sentences(x: str) -> str:
    pieces = rf"regexp_split_to_array({x}, '[.!?\n]+')"
    return f"list_filter(list_transform({pieces}, lambda s: {sql_strip('s')}), lambda s: s <> '')"


LOG = """log AS (
  SELECT event_id AS request_id, ts, CAST(ts AS DATE) AS date, user_id, event_type AS version,
         value AS latency_ms, CAST(json_extract_string(props, '$.k') AS INTEGER) AS tokens,
         CASE WHEN tokens >= 50 THEN 'yes' WHEN tokens >= 10 THEN 'no' END AS rating
  FROM events)"""

EVALS = rf"""evals AS (
  SELECT 'req-' || doc_id AS request_id, 'What does document ' || doc_id || ' state?' AS request,
         {sql_sentences('text')} AS expected_facts,
         [{{'doc_uri': source}}, {{'doc_uri': lang}}] AS expected_retrieved_context,
         CASE lang WHEN 'en' THEN 'HUMAN_SOURCE' WHEN 'fr' THEN 'SYNTHETIC_FROM_DOC' END AS source_type,
         CAST(doc_id AS VARCHAR) AS source_id, [lang, source] AS tags,
         CASE n_chars % 5 WHEN 0 THEN 'DRAFT' WHEN 1 THEN 'REVIEWED' WHEN 2 THEN 'ACCEPTED'
              WHEN 3 THEN 'REJECTED' END AS review_status
  FROM documents)"""


# --- the same views in Spark ----------------------------------------------------------------------


def request_log(spark: SparkSession, base: str) -> DataFrame:
    events = load(spark, "events", base)
    tokens = F.from_json("props", "k INT")["k"]
    return events.select(
        F.col("event_id").alias("request_id"),
        "ts",
        F.to_date("ts").alias("date"),
        "user_id",
        F.col("event_type").alias("version"),
        F.col("value").alias("latency_ms"),
        tokens.alias("tokens"),
    ).withColumn("rating", F.when(F.col("tokens") >= 50, "yes").when(F.col("tokens") >= 10, "no"))


def documents(spark: SparkSession, base: str) -> DataFrame:
    """The documents, for queries that work through their text."""
    return load(spark, "documents", base, spread_by="doc_id")


def eval_rows(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    number = F.col("doc_id").cast("string")
    state = F.col("n_chars") % 5
    return docs.select(
        F.concat(F.lit("req-"), number).alias("request_id"),
        F.concat(F.lit("What does document "), number, F.lit(" state?")).alias("request"),
        X.sentences("text").alias("expected_facts"),
        F.array(
            F.struct(F.col("source").alias("doc_uri")), F.struct(F.col("lang").alias("doc_uri"))
        ).alias("expected_retrieved_context"),
        F.when(F.col("lang") == "en", K.HUMAN_SOURCE)
        .when(F.col("lang") == "fr", K.SYNTHETIC_SOURCE)
        .alias("source_type"),
        number.alias("source_id"),
        F.array("lang", "source").alias("tags"),
        F.when(state == 0, "DRAFT").when(state == 1, "REVIEWED").when(state == 2, "ACCEPTED")
        .when(state == 3, "REJECTED").alias("review_status"),
    )


def corpus(spark: SparkSession, base: str) -> DataFrame:
    return documents(spark, base).select(
        F.col("doc_id").alias("corpus_pos"), F.col("text").alias("content"), "n_chars"
    )


def as_text(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def sql_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"
