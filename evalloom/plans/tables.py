"""Sources, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom import sources as S
from evalloom.operators import predicates as P
from evalloom.plans.base import EVALS, LOG, as_text, eval_rows, query, request_log, sql_text
from evalloom.session import scratch_path


@query("scan_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_table(spark: SparkSession, base: str) -> DataFrame:
    S.load(spark, "orders", base).createOrReplaceTempView("orders_table")
    return S.load(spark, "orders_table").select("o_orderkey", "o_custkey", "o_totalprice")


@query("scan_parquet", "SELECT doc_id, lang, n_chars FROM documents")
def scan_parquet(spark: SparkSession, base: str) -> DataFrame:
    return S.load(spark, "documents", base).select("doc_id", "lang", "n_chars")


@query("scan_jsonl", "SELECT conv_id, turn, role, text FROM conversations")
def scan_jsonl(spark: SparkSession, base: str) -> DataFrame:
    turns = S.load(spark, "conversations", base)
    path = scratch_path(spark, "conversations-jsonl")
    S.save_jsonl(turns, path)
    return S.load_jsonl(spark, path, turns.schema)


@query(
    "values_scan",
    """SELECT s.severity, count(*) AS requests
       FROM (VALUES ('error', 'high'), ('purchase', 'low'), ('signup', 'low')) s(event_type, severity)
       JOIN events USING (event_type) GROUP BY s.severity""",
)
def values_scan(spark: SparkSession, base: str) -> DataFrame:
    records = [
        {"event_type": "error", "severity": "high"},
        {"event_type": "purchase", "severity": "low"},
        {"event_type": "signup", "severity": "low"},
    ]
    severities = S.from_records(spark, records, "event_type string, severity string")
    joined = S.load(spark, "events", base).join(severities, "event_type")
    return joined.groupBy("severity").agg(F.count(F.lit(1)).alias("requests"))


@query("sink_roundtrip", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def sink_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    path = scratch_path(spark, "customer")
    name = "customer_" + path.rsplit("-", 1)[1]
    rows = S.load(spark, "customer", base).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return S.save(rows, name, path=path)


@query(
    "append_evolving",
    """SELECT event_id, event_type, CAST(NULL AS DOUBLE) AS value FROM events WHERE event_type = 'error'
       UNION ALL SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'""",
)
def append_evolving(spark: SparkSession, base: str) -> DataFrame:
    events = S.load(spark, "events", base)
    old = events.filter("event_type = 'error'").select("event_id", "event_type")
    return S.append_evolving(old, events.filter("event_type <> 'error'").select("event_id", "event_type", "value"))


@query(
    "stored_append",
    """SELECT event_id, event_type, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS BIGINT) AS user_id FROM events WHERE event_type = 'error'
       UNION ALL SELECT event_id, event_type, value, NULL FROM events WHERE event_type = 'click'
       UNION ALL SELECT event_id, NULL, NULL, user_id FROM events WHERE event_type NOT IN ('error', 'click')""",
)
def stored_append(spark: SparkSession, base: str) -> DataFrame:
    """Three appends to one stored table, each with other columns."""
    events, path = S.load(spark, "events", base), scratch_path(spark, "appended")
    S.append_stored(events.filter("event_type = 'error'").select("event_id", "event_type"), path)
    S.append_stored(events.filter("event_type = 'click'").select("event_id", "event_type", "value"), path)
    S.append_stored(events.filter("event_type NOT IN ('error', 'click')").select("user_id", "event_id"), path)
    return S.read_stored(spark, path)


@query("sink_jsonl_roundtrip", "SELECT l.doc_id, d.lang, l.quality, l.toxic FROM labels l JOIN documents d USING (doc_id)")
def sink_jsonl_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    docs = S.load(spark, "documents", base).select("doc_id", "lang")
    rows = S.load(spark, "labels", base).join(docs, "doc_id").select("doc_id", "lang", "quality", "toxic")
    path = scratch_path(spark, "labels-jsonl")
    S.save_jsonl(rows, path)
    return S.load_jsonl(spark, path, rows.schema)


@query(
    "kv_metadata_map",
    """WITH latest AS (SELECT event_type AS key, CAST(max(event_id) AS VARCHAR) AS value FROM events GROUP BY 1)
       SELECT string_agg(key || '=' || value, ',' ORDER BY key) AS metadata FROM latest""",
)
def kv_metadata_map(spark: SparkSession, base: str) -> DataFrame:
    pairs = S.load(spark, "events", base).select(
        F.col("event_type").alias("key"), F.col("event_id").cast("string").alias("value"), "event_id"
    )
    entries = F.array_sort(F.map_entries("metadata"))
    shown = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return S.kv_to_map(pairs, "event_id").select(F.array_join(shown, ",").alias("metadata"))


@query("docs_normalized", "SELECT text AS content, CAST(doc_id AS VARCHAR) AS doc_uri FROM documents")
def docs_normalized(spark: SparkSession, base: str) -> DataFrame:
    return P.as_docs(S.load(spark, "documents", base), "text", "doc_id")


@query(
    "nested_field_projection",
    f"""WITH {EVALS} SELECT request_id,
        array_to_string(list_transform(expected_retrieved_context, lambda c: c.doc_uri), ',') AS uris FROM evals""",
)
def nested_field_projection(spark: SparkSession, base: str) -> DataFrame:
    rows = P.expected_uris(eval_rows(spark, base))
    return rows.select("request_id", F.array_join("expected_retrieved_context", ",").alias("uris"))


@query(
    "status_columns",
    f"""SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS run_id,
        CAST(NULL AS DOUBLE) AS "{K.PRECISION_COLUMN}" FROM events""",
)
def status_columns(spark: SparkSession, base: str) -> DataFrame:
    return P.with_status_columns(S.load(spark, "events", base).select("event_id", "event_type"))


@query(
    "drop_columns",
    """SELECT event_id AS request_id, event_type, value, 'run-1' AS run_id, 'exp-1' AS experiment_id,
       CAST(NULL AS VARCHAR) AS topic FROM events""",
)
def drop_columns(spark: SparkSession, base: str) -> DataFrame:
    judged = S.load(spark, "events", base).select(
        F.col("event_id").alias("request_id"), F.col("props").alias("request"), "event_type", "value",
        F.lit("answer").alias("response"), F.lit("[]").alias("trace"),
    )
    return P.with_run_columns(judged, "request_id", "run-1", "exp-1")


@query("select_except", "SELECT * EXCLUDE (c_acctbal, c_nationkey) FROM customer")
def select_except(spark: SparkSession, base: str) -> DataFrame:
    S.load(spark, "customer", base).createOrReplaceTempView("customer_table")
    return spark.sql("SELECT * EXCEPT (c_acctbal, c_nationkey) FROM customer_table")


@query("distinct_column_list", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def distinct_column_list(spark: SparkSession, base: str) -> DataFrame:
    columns = P.result_columns("p_partkey", "p_name", "p_brand", ["p_name", "p_type", "p_brand"])
    return S.load(spark, "part", base).select(*columns)


@query(
    "uri_exclusion",
    "SELECT page_id, url FROM pages WHERE NOT contains(url, '/de/') AND NOT contains(url, '/fr/')",
)
def uri_exclusion(spark: SparkSession, base: str) -> DataFrame:
    pages = S.load(spark, "pages", base).select("page_id", "url")
    return P.exclude_uri(pages, ["/de/", "/fr/"], "url")


@query("review_status_filter", f"WITH {EVALS} SELECT request_id, request FROM evals WHERE review_status = 'REVIEWED'")
def review_status_filter(spark: SparkSession, base: str) -> DataFrame:
    return P.by_review_status(eval_rows(spark, base), "REVIEWED").select("request_id", "request")


@query("tag_filter", f"WITH {EVALS} SELECT request_id, source_id FROM evals WHERE list_contains(tags, 'fr')")
def tag_filter(spark: SparkSession, base: str) -> DataFrame:
    return P.with_tag(eval_rows(spark, base), "fr").select("request_id", "source_id")


@query(
    "recent_rows",
    f"""SELECT event_id, {sql_text('ts')} AS ts FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def recent_rows(spark: SparkSession, base: str) -> DataFrame:
    events = S.load(spark, "events", base)
    recent = P.since(events, "ts", P.latest(events, "ts"), 7)
    return recent.select("event_id", as_text("ts").alias("ts"))


@query("unprocessed_rows", f"WITH {LOG} SELECT request_id, version FROM log WHERE rating IS NULL")
def unprocessed_rows(spark: SparkSession, base: str) -> DataFrame:
    # A request without a rating has not been judged by any run.
    log = request_log(spark, base).withColumn("run_id", F.when(F.col("rating").isNotNull(), F.lit("run-1")))
    return P.unprocessed(log).select("request_id", "version")


PART_FIELDS = ("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def _filtered_parts(spark: SparkSession, base: str, spec: list) -> DataFrame:
    parts = S.load(spark, "part", base).filter(P.compile_filters(spec, PART_FIELDS))
    return parts.select("p_partkey", "p_name", "p_brand", "p_size")


PARTS = "SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE "


@query("filter_eq", PARTS + "p_type = 'ECONOMY'")
def filter_eq(spark: SparkSession, base: str) -> DataFrame:
    return _filtered_parts(spark, base, [{"field": "p_type", "filter": "ECONOMY"}])


@query("filter_in", PARTS + "p_brand IN ('Brand#2', 'Brand#17')")
def filter_in(spark: SparkSession, base: str) -> DataFrame:
    return _filtered_parts(spark, base, [{"field": "p_brand", "filter": ["Brand#2", "Brand#17"]}])


@query("filter_range", PARTS + "p_size >= 10 AND p_size < 30 AND p_retailprice <= 1000")
def filter_range(spark: SparkSession, base: str) -> DataFrame:
    spec = [
        {"field": "p_size", "filter": {">=": 10}},
        {"field": "p_size", "filter": {"<": 30}},
        {"field": "p_retailprice", "filter": {"<=": 1000}},
    ]
    return _filtered_parts(spark, base, spec)


@query("filter_like", PARTS + "p_name LIKE '%ring%'")
def filter_like(spark: SparkSession, base: str) -> DataFrame:
    return _filtered_parts(spark, base, [{"field": "p_name", "filter": {"LIKE": "%ring%"}}])


@query("filter_not", PARTS + "p_type <> 'ECONOMY'")
def filter_not(spark: SparkSession, base: str) -> DataFrame:
    return _filtered_parts(spark, base, [{"field": "p_type", "filter": {"not": "ECONOMY"}}])


@query(
    "user_orders",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def user_orders(spark: SparkSession, base: str) -> DataFrame:
    debtors = S.load(spark, "customer", base).filter("c_acctbal < 0").withColumnRenamed("c_custkey", "o_custkey")
    return P.user_orders(S.load(spark, "orders", base), debtors, "o_custkey", "o_orderkey", "o_totalprice")
