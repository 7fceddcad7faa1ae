"""Aggregations and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom.operators import evalset as E
from evalloom.operators import metrics as M
from evalloom.operators import predicates as P
from evalloom.operators import sketches as SK
from evalloom.operators import traces as T
from evalloom.plans.base import EVALS, LOG, as_text, documents, eval_rows, query, request_log, sql_text, sql_words
from evalloom.session import scratch_path
from evalloom.sources import load

PASS = "CASE rating WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END"


@query("count_rows", "SELECT count(*) AS num_rows FROM events")
def count_rows(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, "events", base).agg(F.count(F.lit(1)).alias("num_rows"))


def _pass_rate(spark: SparkSession, base: str, days: int, *by: str) -> DataFrame:
    log = request_log(spark, base)
    rates = M.pass_rate(log, P.latest(load(spark, "events", base), "ts"), by, days=days)
    return rates.select(
        F.col("date").cast("string").alias("date"), *by, F.round("avg_pass_rate", 6).alias("avg_pass_rate")
    )


def _pass_rate_sql(days: int, by: str = "") -> str:
    return f"""SELECT CAST(date AS VARCHAR) AS date, {by} round(avg({PASS}), 6) AS avg_pass_rate FROM log
      WHERE CAST(date AS TIMESTAMP) >= (SELECT max(ts) FROM log) - INTERVAL {days} DAY GROUP BY ALL"""


@query("pass_rate_daily", f"WITH {LOG} {_pass_rate_sql(1)}")
def pass_rate_daily(spark: SparkSession, base: str) -> DataFrame:
    return _pass_rate(spark, base, 1)


@query("pass_rate_by_version", f"WITH {LOG} {_pass_rate_sql(30, 'version,')}")
def pass_rate_by_version(spark: SparkSession, base: str) -> DataFrame:
    return _pass_rate(spark, base, 30, "version")


@query(
    "pass_rate_alerts",
    f"WITH {LOG}, rates AS ({_pass_rate_sql(30, 'version,')}) SELECT * FROM rates WHERE avg_pass_rate < 0.5",
)
def pass_rate_alerts(spark: SparkSession, base: str) -> DataFrame:
    return M.pass_rate_alerts(_pass_rate(spark, base, 30, "version"), 0.5)


@query(
    "rolling_pass_rate",
    f"""WITH {LOG}, hourly AS (SELECT date_trunc('hour', ts) AS hour, version, sum({PASS}) AS passed,
          count({PASS}) AS judged FROM log GROUP BY ALL),
        rolled AS (SELECT hour, version, sum(judged) OVER w AS judged, sum(passed) OVER w AS passed FROM hourly
          WINDOW w AS (PARTITION BY version ORDER BY hour RANGE BETWEEN INTERVAL 167 HOUR PRECEDING AND CURRENT ROW))
        SELECT {sql_text('hour')} AS hour, version, CAST(judged AS BIGINT) AS judged,
          round(passed / nullif(judged, 0), 6) AS pass_rate FROM rolled""",
)
def rolling_pass_rate(spark: SparkSession, base: str) -> DataFrame:
    rates = M.rolling_pass_rate(request_log(spark, base), 7, ["version"])
    return rates.select(
        as_text("hour").alias("hour"), "version", "judged", F.round("pass_rate", 6).alias("pass_rate")
    )


@query(
    "group_by_all",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY ALL",
)
def group_by_all(spark: SparkSession, base: str) -> DataFrame:
    load(spark, "orders", base).createOrReplaceTempView("orders_by_status")
    return spark.sql(
        "SELECT o_orderstatus, o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS amount "
        "FROM orders_by_status GROUP BY ALL"
    )


@query("distinct_tags", f"WITH {EVALS} SELECT DISTINCT unnest(tags) AS tag_name FROM evals")
def distinct_tags(spark: SparkSession, base: str) -> DataFrame:
    return M.tag_names(eval_rows(spark, base))


@query(
    "dedup_first",
    """SELECT user_id, event_id, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""",
)
def dedup_first(spark: SparkSession, base: str) -> DataFrame:
    # The user stands for the request id, since event ids do not repeat.
    events = load(spark, "events", base).select("user_id", "event_id", "event_type", "ts")
    return M.dedup_first(events, "user_id", F.col("ts"), F.col("event_id")).drop("ts")


@query(
    "run_scorecard",
    f"""WITH {LOG} SELECT version, count(*) AS requests, round(avg({PASS}), 6) AS pass_rate,
        CAST(sum(tokens) AS BIGINT) AS tokens, round(avg(latency_ms), 6) AS avg_latency_ms,
        round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency_ms,
        round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms FROM log GROUP BY version""",
)
def run_scorecard(spark: SparkSession, base: str) -> DataFrame:
    card = M.run_scorecard(request_log(spark, base), "version", exact=True)
    rounded = ("pass_rate", "avg_latency_ms", "p50_latency_ms", "p95_latency_ms")
    return card.select("version", "requests", "tokens", *[F.round(c, 6).alias(c) for c in rounded])


VERDICTS = """verdicts AS (
  SELECT request_id, CASE WHEN tokens >= 20 THEN 'yes' ELSE 'no' END AS chunk_relevance,
    CASE WHEN latency_ms < 60 THEN 'yes' ELSE 'no' END AS groundedness,
    CASE WHEN version <> 'error' THEN 'yes' ELSE 'no' END AS safety FROM log)"""


@query(
    "root_cause_ranking",
    f"""WITH {LOG}, {VERDICTS}, causes AS (
          SELECT CASE WHEN chunk_relevance = 'no' THEN 'chunk_relevance' WHEN groundedness = 'no' THEN 'groundedness'
            WHEN safety = 'no' THEN 'safety' END AS root_cause FROM verdicts),
        counted AS (SELECT root_cause, count(*) AS failures FROM causes WHERE root_cause IS NOT NULL GROUP BY 1)
        SELECT root_cause, failures, CAST(row_number() OVER (ORDER BY failures DESC, root_cause) AS INTEGER) AS place
        FROM counted""",
)
def root_cause_ranking(spark: SparkSession, base: str) -> DataFrame:
    def verdict(passed: Column) -> Column:
        return F.when(passed, "yes").otherwise("no")

    judged = request_log(spark, base).select(
        verdict(F.col("tokens") >= 20).alias("chunk_relevance"),
        verdict(F.col("latency_ms") < 60).alias("groundedness"),
        verdict(F.col("version") != "error").alias("safety"),
    )
    return M.root_causes(judged, ["chunk_relevance", "groundedness", "safety"])


@query(
    "scorecard_rollup",
    f"""WITH {LOG} SELECT version, CAST(date AS VARCHAR) AS date, CAST(grouping_id(version, date) AS BIGINT) AS level,
        count(*) AS requests, round(avg({PASS}), 6) AS pass_rate FROM log GROUP BY ROLLUP (version, date)""",
)
def scorecard_rollup(spark: SparkSession, base: str) -> DataFrame:
    rolled = M.scorecard_rollup(request_log(spark, base), "version", "date")
    return rolled.select(
        "version", F.col("date").cast("string").alias("date"), "level", "requests",
        F.round("pass_rate", 6).alias("pass_rate"),
    )


@query(
    "top_issues",
    "SELECT source, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def top_issues(spark: SparkSession, base: str) -> DataFrame:
    poor = load(spark, "labels", base).filter("quality = 0").select("doc_id")
    docs = load(spark, "documents", base).select("doc_id", "source")
    return M.top_counts(docs.join(poor, "doc_id"), "source", 10)


@query(
    "word_frequency",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest({sql_words('text')}) AS word FROM documents)
        GROUP BY word ORDER BY n DESC, word LIMIT 50""",
)
def word_frequency(spark: SparkSession, base: str) -> DataFrame:
    return M.word_counts(documents(spark, base), "text", 50)


@query("review_progress", f"WITH {EVALS} SELECT review_status, count(*) AS evals FROM evals GROUP BY 1")
def review_progress(spark: SparkSession, base: str) -> DataFrame:
    return M.review_progress(eval_rows(spark, base))


@query(
    "log_profile",
    """SELECT event_type, count(*) AS rows, count(DISTINCT user_id) AS users, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type""",
)
def log_profile(spark: SparkSession, base: str) -> DataFrame:
    profiled = M.profile(load(spark, "events", base), ["event_type"], "user_id", "value", exact=True)
    return profiled.select(
        "event_type", "rows", "users", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90")
    )


@query(
    "latest_revision",
    """SELECT conv_id, turn, role FROM (
         SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r = 1""",
)
def latest_revision(spark: SparkSession, base: str) -> DataFrame:
    # Turns stand for the revisions of an evaluation row.
    history = load(spark, "conversations", base).select("conv_id", "turn", "role")
    return E.latest_revision(history, "conv_id", "turn")


@query(
    "revision_diff",
    """WITH l AS (SELECT conv_id, turn, role, lag(turn) OVER w AS prev_turn, lag(role) OVER w AS prev_role
         FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
       SELECT conv_id, turn, prev_role AS before, role AS after FROM l
       WHERE prev_turn IS NULL OR role IS DISTINCT FROM prev_role""",
)
def revision_diff(spark: SparkSession, base: str) -> DataFrame:
    history = load(spark, "conversations", base).select("conv_id", "turn", "role")
    return E.revision_diff(history, "role", "conv_id", "turn")


@query(
    "turn_sequence",
    """SELECT conv_id, turn, role, prev_role, coalesce(prev_role = role AND role <> 'tool', false) AS repeated,
         role = 'tool' AND NOT coalesce(prev_role IN ('assistant', 'tool'), false) AS orphan_tool
       FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role FROM conversations)""",
)
def turn_sequence(spark: SparkSession, base: str) -> DataFrame:
    return T.turn_sequence(load(spark, "conversations", base).select("conv_id", "turn", "role"))


# A trace per request: the agent's span, then one for its search, one for the model, which has no end if it failed,
# and one for the embedding inside the search.
SPANS = """spans AS (
  SELECT request_id, 0 AS span_no, 'rag_agent' AS name, 'AGENT' AS span_type, 0 AS "start",
         CAST(1000 + tokens AS BIGINT) AS "end" FROM log
  UNION ALL SELECT request_id, 1, 'search', 'RETRIEVER', 0, CAST(tokens AS BIGINT) FROM log
  UNION ALL SELECT request_id, 2, 'model', 'CHAT_MODEL', tokens,
         CASE WHEN version <> 'error' THEN CAST(tokens + floor(latency_ms) AS BIGINT) END FROM log
  UNION ALL SELECT request_id, 3, 'embed', 'EMBEDDING', 0, CAST(tokens // 2 AS BIGINT) FROM log)"""
# The parent of a span is the last before it, by start and falling end, that ends with it or after it.
SPAN_TREE = """around AS (
    SELECT x.request_id, x.span_no, arg_max(y.span_no, (y."start", -y."end", y.span_no)) AS parent
    FROM spans x JOIN spans y ON x.request_id = y.request_id AND y."end" >= coalesce(x."end", x."start")
      AND (y."start" < x."start" OR y."start" = x."start" AND (x."end" IS NULL OR y."end" > x."end" OR y."end" = x."end" AND y.span_no < x.span_no))
    GROUP BY 1, 2),
  tree AS (SELECT s.*, parent FROM spans s LEFT JOIN around USING (request_id, span_no)),
  depths AS (
    SELECT request_id, span_no, 0 AS depth FROM tree WHERE parent IS NULL
    UNION ALL SELECT t.request_id, t.span_no, d.depth + 1 FROM tree t JOIN depths d ON d.request_id = t.request_id AND d.span_no = t.parent),
  used AS (SELECT request_id, parent AS span_no, CAST(sum("end" - "start") AS BIGINT) AS used FROM tree GROUP BY 1, 2)"""


def traced_requests(spark: SparkSession, base: str) -> DataFrame:
    def span(name: str, kind: str, start: Column, end: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.lit(kind).alias("span_type"),
            start.cast("bigint").alias("start"), end.cast("bigint").alias("end"),
        )

    tokens = F.col("tokens")
    answered = F.when(F.col("version") != "error", tokens + F.floor("latency_ms"))
    made = F.array(
        span("rag_agent", "AGENT", F.lit(0), tokens + 1000),
        span("search", "RETRIEVER", F.lit(0), tokens),
        span("model", "CHAT_MODEL", tokens, answered),
        span("embed", "EMBEDDING", F.lit(0), F.floor(tokens / 2)),
    )
    return request_log(spark, base).select("request_id", F.to_json(made).alias("trace"))


@query(
    "trace_spans",
    f"""WITH RECURSIVE {LOG}, {SPANS}, {SPAN_TREE} SELECT t.request_id, t.span_no, name, span_type, CAST("start" AS BIGINT) AS "start",
          "end", "end" - "start" AS duration, parent, depth, CASE WHEN "end" IS NOT NULL
            THEN greatest("end" - "start" - coalesce(used, 0), 0) END AS self_time
        FROM tree t JOIN depths USING (request_id, span_no) LEFT JOIN used USING (request_id, span_no)""",
)
def trace_spans(spark: SparkSession, base: str) -> DataFrame:
    return T.span_tree(traced_requests(spark, base), "trace", "request_id")


@query(
    "span_latency",
    f"""WITH {LOG}, {SPANS}, d AS (SELECT span_type, "end" - "start" AS duration FROM spans)
        SELECT span_type, count(*) AS spans, round(avg(duration), 6) AS avg_duration,
          round(quantile_cont(duration, 0.5), 6) AS p50_duration, round(quantile_cont(duration, 0.95), 6) AS p95_duration
        FROM d GROUP BY span_type""",
)
def span_latency(spark: SparkSession, base: str) -> DataFrame:
    latency = T.span_latency(T.spans(traced_requests(spark, base), "trace"), exact=True)
    rounded = ("avg_duration", "p50_duration", "p95_duration")
    return latency.select("span_type", "spans", *[F.round(c, 6).alias(c) for c in rounded])


@query(
    "sketch_levels",
    f"""WITH {LOG}, levels AS (
          SELECT version, CAST(date AS VARCHAR) AS day, count(*) AS requests FROM log GROUP BY ROLLUP (version, date))
        SELECT *, true AS users_close, true AS p50_close, true AS p95_close FROM levels WHERE version IS NOT NULL OR day IS NULL""",
)
def sketch_levels(spark: SparkSession, base: str) -> DataFrame:
    """Per version and day, per version and in total, from the stored hourly sketches, each held against the exact value.

    Distinct users must be within 5 %. A percentile must lie between the exact ones 3 % of the ranks below and above.
    """
    log, path = request_log(spark, base), scratch_path(spark, "sketches")
    SK.sketch_hours(log, ["version"]).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("day", F.to_date("hour").cast("string"))
    sized = log.withColumn("day", F.col("date").cast("string"))
    wanted = {"p50": 0.5, "p95": 0.95}
    found = []
    for levels in (["version", "day"], ["version"], []):
        near = SK.from_sketches(stored, levels, wanted)
        sides = [(f"{n}_{side}", min(max(p + d, 0.0), 1.0)) for n, p in wanted.items() for side, d in (("low", -0.03), ("high", 0.03))]
        # Distinct users on their own: next to another aggregate each user of a level would get digests of its own.
        users = sized.groupBy(*levels).agg(F.count_distinct("user_id").alias("exact_users"))
        bounds = sized.groupBy(*levels).agg(F.percentile_approx("latency_ms", [p for _, p in sides], 10000).alias("bounds")).select(
            *levels, *[F.col("bounds")[i].alias(name) for i, (name, _) in enumerate(sides)]
        )
        # Side by side by a union and a fold, which has no join for the level without a key.
        rows = near.unionByName(users, allowMissingColumns=True).unionByName(bounds, allowMissingColumns=True)
        both = rows.groupBy(*levels).agg(*[F.max(c).alias(c) for c in rows.columns if c not in levels])
        closes = [F.col(n).between(F.col(f"{n}_low"), F.col(f"{n}_high")).alias(f"{n}_close") for n in wanted]
        names = [(F.col(c) if c in levels else F.lit(None).cast("string")).alias(c) for c in ("version", "day")]
        found.append(both.select(
            *names, "requests", (F.abs(F.col("users") - F.col("exact_users")) <= 0.05 * F.col("exact_users")).alias("users_close"), *closes
        ))
    return found[0].union(found[1]).union(found[2])
