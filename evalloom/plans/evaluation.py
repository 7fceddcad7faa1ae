"""Evaluation sets and judges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions import judging as JF
from evalloom.functions import messages as MS
from evalloom.functions import text as X
from evalloom.operators import evalset as E
from evalloom.operators import joins as JN
from evalloom.operators import judges as J
from evalloom.operators import monitoring as MO
from evalloom.operators import predicates as P
from evalloom.operators import retrieval as R
from evalloom.operators import sampling as S
from evalloom.operators import udfs as U
from evalloom.plans.base import corpus, documents, query, sql_sentences, sql_words
from evalloom.plans.columns import NOTES_SQL, sql_parse_notes
from evalloom.plans.combining import SELECTED, assessments, status_log
from evalloom.plans.ranking import PAIRS, benchmark_queries
from evalloom.session import scratch_path, stage
from evalloom.sources import append_stored, load, read_stored


def sql_overlap(claim: str, support: str) -> str:
    claimed = f"list_distinct({sql_words(claim)})"
    shared = f"len(list_intersect({claimed}, {sql_words(support)}))"
    return f"(CASE WHEN len({claimed}) > 0 THEN CAST({shared} AS DOUBLE) / len({claimed}) END)"


def sql_coverage(response: str, facts: str) -> str:
    held = f"len(list_filter({facts}, lambda f: contains(lower({response}), lower(f))))"
    return f"(CASE WHEN len({facts}) > 0 THEN CAST({held} AS DOUBLE) / len({facts}) END)"


def sql_yes_no(x: str) -> str:
    return f"CASE WHEN {x} THEN 'yes' WHEN NOT ({x}) THEN 'no' END"


# --- evaluation sets ------------------------------------------------------------------------------


def docs_to_ask(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    return docs.select(F.col("doc_id").alias("corpus_pos"), F.col("doc_id").cast("string").alias("doc_uri"), F.col("text").alias("content"))


@query(
    "eval_quota",
    """WITH n AS (SELECT count(*) AS total FROM documents),
       r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM documents),
       q AS (SELECT doc_id, 2500 // total + CASE WHEN rank <= 2500 % total THEN 1 ELSE 0 END AS quota FROM r, n)
       SELECT doc_id, CAST(unnest(range(1, quota + 1)) AS INTEGER) AS question_no FROM q""",
)
def eval_quota(spark: SparkSession, base: str) -> DataFrame:
    planned = E.plan_evals(docs_to_ask(spark, base), 2500)
    return planned.select(F.col("corpus_pos").alias("doc_id"), "question_no")


@query(
    "generate_evals",
    f"""WITH asked AS (SELECT CAST(doc_id AS VARCHAR) AS uri, {sql_sentences('text')} AS s, unnest([1, 2, 3]) AS n FROM documents),
        made AS (SELECT 'What does ' || uri || ' state in part ' || n || '?' AS request, uri,
                 array_to_string(s[2 * n - 1 : 2 * n], '|') AS facts FROM asked)
        SELECT sha256(request || chr(10) || uri) AS request_id, request, facts, uri AS source_id FROM made""",
)
def generate_evals(spark: SparkSession, base: str) -> DataFrame:
    made = E.generate_evals(E.plan_evals(docs_to_ask(spark, base), per_doc=3))
    return made.select("request_id", "request", F.array_join("expected_facts", "|").alias("facts"), "source_id")


LEGACY = f"""{NOTES_SQL}, legacy AS (
  SELECT 'old-' || d.doc_id AS request_id,
    CASE WHEN n_chars % 4 <> 0 THEN [lang] ELSE CAST([] AS VARCHAR[]) END AS expected_facts,
    CASE n_chars % 3 WHEN 0 THEN notes END AS grading_notes,
    CASE n_chars % 3 WHEN 1 THEN text END AS response,
    CASE lang WHEN 'en' THEN 'HUMAN_SOURCE' WHEN 'fr' THEN 'SYNTHETIC_FROM_DOC' END AS source_type,
    CASE lang WHEN 'fr' THEN source ELSE 'sme-' || lang END AS source_id,
    CASE WHEN n_chars % 2 = 0 THEN 'ACCEPTED' ELSE 'DRAFT' END AS review_status, lang AS tags
  FROM documents d JOIN notes USING (doc_id))"""
ANSWER_FACTS = f"list_filter({sql_sentences('response')}, lambda f, i: list_position({sql_sentences('response')}, f) = i)"


@query(
    "migrate_evals",
    f"""WITH {LEGACY} SELECT request_id, source_type, source_id, tags, review_status, array_to_string(CASE
          WHEN grading_notes IS NOT NULL THEN list_concat(expected_facts, {sql_parse_notes('grading_notes')})
          WHEN response <> '' THEN {ANSWER_FACTS} ELSE expected_facts END, '|') AS facts FROM legacy""",
)
def migrate_evals(spark: SparkSession, base: str) -> DataFrame:
    return E.migrate_evals(legacy_evals(spark, base)).select(
        "request_id", "source_type", "source_id", F.array_join("tags", ",").alias("tags"), "review_status",
        F.array_join("expected_facts", "|").alias("facts"),
    )


def legacy_evals(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    third = F.col("n_chars") % 3
    return docs.select(
        F.concat(F.lit("old-"), F.col("doc_id").cast("string")).alias("request_id"),
        F.when(F.col("n_chars") % 4 != 0, F.array("lang")).alias("expected_facts"),
        F.when(third == 0, X.render_notes(X.sentences("text"))).when(third == 1, "").alias("grading_notes"),
        F.lit("").alias("expected_response"),
        F.when(third == 1, F.col("text")).alias("ground_truth"),
        F.lit("").alias("source_type"),
        F.when(F.col("lang") == "en", "Human SME").when(F.col("lang") == "fr", "synthetic").alias("request_source"),
        F.lit("").alias("source_id"),
        F.col("source").alias("synthetic_source_doc_id"),
        F.concat(F.lit("sme-"), F.col("lang")).alias("created_by"),
        F.array(F.struct(F.col("lang").alias("tag_name"))).alias("tags"),
        F.when(F.col("n_chars") % 2 == 0, "ACCEPTED").otherwise("").alias("review_status"),
        F.lit("DRAFT").alias("status"),
    )


@query(
    "migrate_dataset",
    f"""WITH {LEGACY}, moved AS (SELECT request_id, source_type, review_status, array_to_string(CASE
          WHEN grading_notes IS NOT NULL THEN list_concat(expected_facts, {sql_parse_notes('grading_notes')})
          WHEN response <> '' THEN {ANSWER_FACTS} ELSE expected_facts END, '|') AS facts FROM legacy),
        dataset AS (
          SELECT request_id, NULL AS source_type, NULL AS review_status, 'kept' AS facts FROM moved WHERE request_id LIKE '%7'
          UNION ALL SELECT * FROM moved WHERE request_id NOT LIKE '%7')
        SELECT d.*, (SELECT count(DISTINCT lang) FROM documents) AS n_tags, 'evals of ' || (SELECT max(source) FROM documents) AS name FROM dataset d""",
)
def migrate_dataset(spark: SparkSession, base: str) -> DataFrame:
    """A legacy dataset with its metadata and tags, moved twice into a dataset that has some of its rows already."""
    path = scratch_path(spark, "dataset")
    legacy, docs = legacy_evals(spark, base), load(spark, "documents", base)
    legacy.createOrReplaceTempView("legacy_dataset_view")
    name = F.concat(F.lit("evals of "), F.max("source"))
    docs.agg(name.alias("value")).select(F.lit("name").alias("key"), "value").createOrReplaceTempView("legacy_dataset")
    docs.select(F.col("lang").alias("tag_name")).createOrReplaceTempView("legacy_dataset_tags")
    there = E.migrate_evals(legacy).filter("request_id LIKE '%7'").select("request_id", F.array(F.lit("kept")).alias("expected_facts"))
    append_stored(there, f"{path}/evals")
    for _ in range(2):  # the second migration finds nothing to add
        metadata = E.migrate_dataset(spark, "legacy_dataset", path)
    named = metadata.filter("key = 'name'").select("value").scalar()
    n_tags = read_stored(spark, f"{path}/tags").agg(F.count(F.lit(1))).scalar()
    return read_stored(spark, f"{path}/evals").select(
        "request_id", "source_type", "review_status", F.array_join("expected_facts", "|").alias("facts"), n_tags.alias("n_tags"), named.alias("name")
    )


# --- judges over retrieved documents --------------------------------------------------------------

BEST = f"""{PAIRS}, best AS (
  SELECT r.query_id, r.rank, r.corpus_pos, b.text AS request, d.text AS response
  FROM ranked r JOIN benchmark b ON b.item_id = r.query_id JOIN documents d ON d.doc_id = r.corpus_pos WHERE rank <= 3)"""


def best_documents(spark: SparkSession, base: str, asked: DataFrame | None = None, hits: DataFrame | None = None) -> DataFrame:
    """The three best documents of every benchmark passage, with both texts."""
    docs = corpus(spark, base)
    asked = benchmark_queries(spark, base) if asked is None else asked
    ranked = R.keyword_rank(asked, docs, 3, hits=hits)
    kept = ranked.withColumn("kept_chars", F.col("n_chars"))
    requests = load(spark, "benchmark", base).select(F.col("item_id").alias("query_id"), F.col("text").alias("request"))
    texts = R.with_text(kept, docs, "response").join(requests, "query_id")
    return texts.select("query_id", "rank", "corpus_pos", "request", "response")


def passages(spark: SparkSession, base: str) -> DataFrame:
    """Every benchmark passage as its own and only keyword."""
    return load(spark, "benchmark", base).select(F.col("item_id").alias("query_id"), F.array("text").alias("keywords"))


def looked_up(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The benchmark queries, the hits of their keywords and of the whole passages, and `query_id, corpus_pos` of the
    documents that hold a passage: one look into the corpus serves both sets."""
    docs, asked, whole = corpus(spark, base), benchmark_queries(spark, base), passages(spark, base)
    hits = R.keyword_hits([asked, whole], docs)
    return asked, hits, R.keyword_matches(whole, docs, hits=hits).select("query_id", "corpus_pos")


HOLDERS = """holders AS (SELECT item_id AS query_id, doc_id AS corpus_pos FROM benchmark b, documents d
  WHERE contains(lower(d.text), lower(b.text)))"""


@query(
    "chunk_precision",
    f"""WITH {BEST} SELECT query_id, count(*) AS chunks,
        round(avg(CASE WHEN {sql_overlap('request', 'response')} >= 0.2 THEN 1 ELSE 0 END), 6) AS precision
        FROM best GROUP BY 1""",
)
def chunk_precision(spark: SparkSession, base: str) -> DataFrame:
    judged = J.chunk_precision(best_documents(spark, base), chunk="response")
    return judged.select("query_id", "chunks", F.round("precision", 6).alias("precision"))


@query(
    "retrieval_recall",
    f"""WITH {PAIRS}, {HOLDERS} SELECT b.item_id AS query_id, count(h.corpus_pos) AS expected, count(r.corpus_pos) AS found,
          round(count(r.corpus_pos) / nullif(count(h.corpus_pos), 0), 6) AS recall
        FROM benchmark b LEFT JOIN holders h ON h.query_id = b.item_id
          LEFT JOIN (SELECT * FROM ranked WHERE rank <= 10) r
          ON r.query_id = h.query_id AND r.corpus_pos = h.corpus_pos GROUP BY 1""",
)
def retrieval_recall(spark: SparkSession, base: str) -> DataFrame:
    asked, hits, holders = looked_up(spark, base)
    retrieved = R.keyword_rank(asked, corpus(spark, base), 10, hits=hits)
    recall = J.recall_of(retrieved, holders, "corpus_pos", requests=asked.select("query_id"))
    return recall.select("query_id", "expected", "found", F.round("recall", 6).alias("recall"))


@query(
    "groundedness",
    f"WITH {BEST} SELECT query_id, rank, round({sql_overlap('request', 'response')}, 6) AS groundedness FROM best",
)
def groundedness(spark: SparkSession, base: str) -> DataFrame:
    # The passage is the claim and the retrieved document its support.
    score = JF.groundedness("request", "response")
    return best_documents(spark, base).select("query_id", "rank", F.round(score, 6).alias("groundedness"))


@query(
    "query_relevance",
    f"""WITH t AS (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS asked FROM conversations)
        SELECT conv_id, turn, round({sql_overlap('asked', 'text')}, 6) AS relevance FROM t
        WHERE role = 'assistant' AND asked IS NOT NULL""",
)
def query_relevance(spark: SparkSession, base: str) -> DataFrame:
    turns = S.segmented_lag(load(spark, "conversations", base), "conv_id", "turn", ["text"])
    answers = turns.filter("role = 'assistant' AND prev_text IS NOT NULL")
    score = JF.query_relevance("prev_text", "text")
    return answers.select("conv_id", "turn", F.round(score, 6).alias("relevance"))


FACTS = f"""facts AS (SELECT doc_id, text, {sql_sentences("text || '. ' || source || '. Src1'")} AS facts FROM documents)"""


@query("fact_coverage", f"WITH {FACTS} SELECT doc_id, round({sql_coverage('text', 'facts')}, 6) AS coverage, {sql_coverage('text', 'facts')} = 1 AS passed FROM facts")
def fact_coverage(spark: SparkSession, base: str) -> DataFrame:
    # Two facts are added to the document's own sentences that it rarely holds.
    facts = X.sentences(F.concat("text", F.lit(". "), "source", F.lit(". Src1")))
    docs = documents(spark, base).select("doc_id", "text", facts.alias("facts"))
    covered = docs.select("doc_id", JF.fact_coverage("text", "facts").alias("share"))
    return covered.select("doc_id", F.round("share", 6).alias("coverage"), (F.col("share") == 1).alias("passed"))


UNSAFE = ("worthless", "password", "kill")


@query(
    "safety_rate",
    """WITH s AS (SELECT lang, NOT (coalesce(toxic = 1, false) OR contains(lower(text), 'worthless')
         OR contains(lower(text), 'password') OR contains(lower(text), 'kill')) AS safe
         FROM documents LEFT JOIN labels USING (doc_id))
       SELECT lang, count(*) AS docs, round(avg(CAST(safe AS INTEGER)), 6) AS safety_rate FROM s GROUP BY lang""",
)
def safety_rate(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base).select("doc_id", "lang", "text")
    judged = J.safety(docs, load(spark, "labels", base), "text", UNSAFE)
    return judged.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.round(F.avg(F.col("safe").cast("int")), 6).alias("safety_rate")
    )


PII_ANY = " OR ".join(f"regexp_matches(text, '{p.replace(chr(39), chr(39) * 2)}')" for p in JF.PII_PATTERNS.values())


@query("pii_score", f"SELECT doc_id, CASE WHEN {PII_ANY} THEN 1 ELSE 5 END AS pii_score FROM documents")
def pii_score(spark: SparkSession, base: str) -> DataFrame:
    return documents(spark, base).select("doc_id", JF.pii_score("text").alias("pii_score"))


@query(
    "pii_counts",
    "SELECT doc_id, " + ", ".join(
        f"CAST(len(regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}')) AS INTEGER) AS {kind}"
        for kind, p in JF.PII_PATTERNS.items()
    ) + " FROM documents",
)
def pii_counts(spark: SparkSession, base: str) -> DataFrame:
    return documents(spark, base).select("doc_id", *JF.pii_counts("text").values())


PANEL = f"""{BEST}, {HOLDERS}, all_holders AS (SELECT query_id, min(corpus_pos) AS lowest, max(corpus_pos) AS highest FROM holders GROUP BY 1),
  second AS (SELECT query_id, response AS context FROM best WHERE rank = 2),
  panel AS (SELECT b.query_id,
    {sql_yes_no(sql_overlap('request', "coalesce(context, '')") + ' >= 0.2')} AS "retrieval/chunk_relevance",
    {sql_yes_no('lowest = corpus_pos AND highest = corpus_pos')} AS "retrieval/context_sufficiency",
    {sql_yes_no(sql_coverage('response', sql_sentences('request')) + ' = 1')} AS "response/correctness",
    {sql_yes_no(sql_overlap('response', "coalesce(context, '')") + ' >= 0.5')} AS "response/groundedness",
    {sql_yes_no(sql_overlap('request', 'response') + ' >= 0.2')} AS "response/relevance_to_query",
    {sql_yes_no('NOT (' + PII_ANY.replace('(text', '(response') + ')')} AS "response/safety"
  FROM best b LEFT JOIN all_holders f ON f.query_id = b.query_id LEFT JOIN second s ON s.query_id = b.query_id WHERE rank = 1)"""


def panel(spark: SparkSession, base: str) -> DataFrame:
    """Judge the best document of every benchmark passage as if it were the answer, and the second as its context.

    One document is retrieved. Whether it is all that is expected shows in the lowest and highest of those that
    hold the passage, so they need not be gathered.
    """
    asked, hits, holders = looked_up(spark, base)
    ends = holders.groupBy("query_id").agg(
        F.array_distinct(F.array(F.min("corpus_pos"), F.max("corpus_pos"))).alias("expected")
    )
    best = stage(best_documents(spark, base, asked, hits), "best-documents")  # read twice
    second = best.filter("rank = 2").select("query_id", F.col("response").alias("context"))
    rows = best.filter("rank = 1").join(ends, "query_id", "left").join(second, "query_id", "left").select(
        "query_id", "request", "response",
        F.coalesce("context", F.lit("")).alias("context"),
        X.sentences("request").alias("expected_facts"),
        F.array("corpus_pos").alias("retrieved"),
        "expected",
    )
    judged = J.run_judges(rows, K.JUDGES)
    return judged.select("query_id", *[F.col(f"`{c}`") for c in J.judge_columns(judged)])


@query("judge_panel", f"WITH {PANEL} SELECT * FROM panel")
def judge_panel(spark: SparkSession, base: str) -> DataFrame:
    return panel(spark, base)


VERDICTS = ("retrieval/chunk_relevance", "retrieval/context_sufficiency", "response/correctness",
            "response/groundedness", "response/relevance_to_query", "response/safety")
ANY_NO = " OR ".join(f"coalesce(\"{v}\" = 'no', false)" for v in VERDICTS)
ALL_NULL = " AND ".join(f'"{v}" IS NULL' for v in VERDICTS)


@query(
    "overall_rating",
    f"WITH {PANEL} SELECT query_id, CASE WHEN {ALL_NULL} THEN NULL WHEN {ANY_NO} THEN 'no' ELSE 'yes' END AS overall FROM panel",
)
def overall_rating(spark: SparkSession, base: str) -> DataFrame:
    return J.with_overall(panel(spark, base)).select("query_id", "overall")


# --- judges over whole tables ---------------------------------------------------------------------

TOPICS = {"nursing": ["nurs", "care"], "german": ["sch", "ung", "keit"], "french": ["eau", "que", "ment"], "spanish": ["ción"]}


def sql_topic(text: str) -> str:
    def score(terms: list[str]) -> str:
        return " + ".join(f"CAST(contains(lower({text}), '{t}') AS INTEGER)" for t in terms)

    listed = ", ".join(f"{{'s': {score(terms)}, 'o': {-n}, 't': '{name}'}}" for n, (name, terms) in enumerate(TOPICS.items()))
    best = f"list_reverse_sort([{listed}])[1]"
    return f"CASE WHEN {best}.s > 0 THEN {best}.t ELSE 'other' END"


@query("topic_keyword", f"SELECT doc_id, {sql_topic('text')} AS topic FROM documents")
def topic_keyword(spark: SparkSession, base: str) -> DataFrame:
    return documents(spark, base).select("doc_id", JF.topic_keyword("text", TOPICS).alias("topic"))


@query(
    "judge_agreement",
    """WITH j AS (SELECT CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS j, quality AS h FROM labels JOIN documents USING (doc_id)),
       c AS (SELECT count(*) FILTER (j = 1 AND h = 1) AS both_yes, count(*) FILTER (j = 1 AND h = 0) AS judge_yes,
               count(*) FILTER (j = 0 AND h = 1) AS human_yes, count(*) FILTER (j = 0 AND h = 0) AS both_no, count(*) AS n FROM j),
       r AS (SELECT *, (both_yes + both_no) / n AS accuracy, ((both_yes + judge_yes) * (both_yes + human_yes)
               + (both_no + human_yes) * (both_no + judge_yes)) / (n * n) AS chance FROM c)
       SELECT both_yes, judge_yes, human_yes, both_no, round(accuracy, 6) AS accuracy,
         round((accuracy - chance) / nullif(1 - chance, 0), 6) AS kappa FROM r""",
)
def judge_agreement(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, "documents", base).select("doc_id", "n_chars")
    both = load(spark, "labels", base).join(docs, "doc_id").select(
        JF.yes_no(F.col("n_chars") >= 1000).alias("judge"), JF.yes_no(F.col("quality") == 1).alias("human")
    )
    counted = J.judge_agreement(both, "judge", "human")
    exact = ("both_yes", "judge_yes", "human_yes", "both_no")
    return counted.select(*exact, F.round("accuracy", 6).alias("accuracy"), F.round("kappa", 6).alias("kappa"))


# --- the whole monitoring cycle -------------------------------------------------------------------


@query(
    "monitoring_cycle",
    f"""WITH {SELECTED}, capped AS (
          SELECT request_id FROM status JOIN selected USING (request_id) WHERE run_id IS NULL
          QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY md5('7:' || request_id), request_id) <= 2),
        after AS (
          SELECT s.request_id, version, CASE WHEN run_id IS NOT NULL THEN run_id
              WHEN s.request_id IN (SELECT request_id FROM capped) THEN 'run-2'
              WHEN s.request_id IN (SELECT request_id FROM selected) THEN 'to_process' ELSE 'skipped' END AS run_id,
            CASE WHEN s.request_id IN (SELECT request_id FROM capped) THEN
              CASE WHEN version IN ('error', 'view') THEN 'no' ELSE 'yes' END END AS rating FROM status s)
        SELECT version, run_id, count(*) AS requests,
          round(avg(CASE rating WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END), 6) AS pass_rate FROM after GROUP BY 1, 2""",
)
def monitoring_cycle(spark: SparkSession, base: str) -> DataFrame:
    def judge(requests: DataFrame) -> DataFrame:
        verdict = F.when(F.col("version").isin("error", "view"), "no").otherwise("yes")
        return requests.select("request_id", verdict.alias("rating"))

    after = MO.run_cycle(
        status_log(spark, base), assessments(spark, base), P.latest(load(spark, "events", base), "ts"),
        judge, "run-2", days=14, cap=2, ts="ts", seed=7,
    )
    rated = after.withColumn("pass", X.pass_flag("rating"))
    return rated.groupBy("version", "run_id").agg(
        F.count(F.lit(1)).alias("requests"), F.round(F.avg("pass"), 6).alias("pass_rate")
    )


CYCLE_TOPICS = {"theme": ["the", "th"], "error": ["er", "or"], "nation": ["tion", "ing"]}


def _sql_cycle_topic(text: str) -> str:
    scores = ", ".join(
        "{'s': " + " + ".join(f"CAST(contains(lower({text}), '{t}') AS INTEGER)" for t in terms) + f", 'o': {-n}, 't': '{name}'}}"
        for n, (name, terms) in enumerate(CYCLE_TOPICS.items())
    )
    return f"CASE WHEN list_reverse_sort([{scores}])[1].s > 0 THEN list_reverse_sort([{scores}])[1].t ELSE 'other' END"


@query(
    "monitoring_judged",
    f"""WITH asked AS (
          SELECT conv_id AS request_id, arg_min(text, turn) FILTER (role = 'user') AS request, arg_max(text, turn) FILTER (role = 'assistant') AS response,
            TIMESTAMP '2024-01-01' + conv_id * INTERVAL 37 MINUTE AS ts FROM conversations GROUP BY 1),
        picked AS (SELECT *, request_id % 10 = 0 OR CAST('0x' || substr(md5('7:' || request_id), 1, 8) AS BIGINT) < 0.5 * 4294967296
            AND ts >= (SELECT max(ts) FROM asked) - INTERVAL 10 DAY AS chosen FROM asked),
        capped AS (SELECT request_id FROM picked WHERE chosen
          QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY md5('7:' || request_id), request_id) <= 1),
        judged AS (SELECT p.*, CASE WHEN response IS NOT NULL THEN {sql_yes_no(sql_overlap('request', 'response') + ' >= 0.2')} END AS relevance,
            {sql_yes_no('NOT (' + PII_ANY.replace('(text', '(response') + ')')} AS safety, {_sql_cycle_topic('request')} AS topic
          FROM picked p JOIN capped USING (request_id)),
        rated AS (SELECT *, CASE WHEN relevance IS NULL AND safety IS NULL THEN NULL
          WHEN coalesce(relevance = 'no', false) OR coalesce(safety = 'no', false) THEN 'no' ELSE 'yes' END AS rating FROM judged),
        after AS (SELECT p.request_id, topic, rating, CASE WHEN r.request_id IS NOT NULL THEN 'run-2' WHEN p.chosen THEN 'to_process' ELSE 'skipped' END AS run_id
          FROM picked p LEFT JOIN rated r USING (request_id))
        SELECT topic, run_id, count(*) AS requests, round(avg(CASE rating WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END), 6) AS pass_rate
        FROM after GROUP BY 1, 2""",
)
def monitoring_judged(spark: SparkSession, base: str) -> DataFrame:
    """The whole cycle over a stored log: parse, choose, de-duplicate, cap, judge, topic, merge, and the pass rates.

    Requests are conversations: the first user turn as a chat body, the last assistant turn as the answer.
    """
    turns, path = load(spark, "conversations", base), scratch_path(spark, "request-log")
    role = lambda name, column: F.when(F.col("role") == name, F.col(column))
    asked = turns.groupBy(F.col("conv_id").alias("request_id")).agg(
        F.min_by(role("user", "text"), role("user", "turn")).alias("request"),
        F.max_by(role("assistant", "text"), role("assistant", "turn")).alias("response"),
    )
    body = F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.col("request").alias("content"))).alias("messages")))
    started = F.timestamp_seconds(F.lit(1704067200) + F.col("request_id") * 37 * 60)
    log = asked.select(
        "request_id", body.alias("request_raw"), "response", started.alias("ts"), F.to_date(started).alias("date"),
        F.lit(None).cast("string").alias("run_id"),
    )
    append_stored(log, path, partition_by="date")
    stored = read_stored(spark, path)
    feedback = stored.filter("request_id % 10 = 0").select("request_id", F.lit("2100-01-01").cast("timestamp").alias("ts"))

    def judge(rows: DataFrame) -> DataFrame:
        query = MS.user_query(MS.parse_request("request_raw")["messages"])
        answered = rows.select("request_id", "response", query.alias("request"))
        judged = J.with_overall(J.run_judges(answered, ["relevance_to_query", "safety"]), "rating")
        return judged.withColumn("topic", JF.topic_keyword("request", CYCLE_TOPICS)).drop("request", "response")

    MO.run_stored_cycle(path, feedback, P.latest(stored, "ts"), judge, "run-2", rate=0.5, days=10, cap=1, ts="ts", seed=7)
    rated = read_stored(spark, path).withColumn("pass", X.pass_flag("rating"))
    return rated.groupBy("topic", "run_id").agg(F.count(F.lit(1)).alias("requests"), F.round(F.avg("pass"), 6).alias("pass_rate"))


# --- a whole evaluation run -----------------------------------------------------------------------


def quoting_agent() -> Callable[[str], str]:
    """An offline stand-in for an agent: it quotes the context up to the first line end."""
    return lambda context: context.split("\n")[0]


@query(
    "evaluation_run",
    f"""WITH made AS (SELECT doc_id, lang, {sql_sentences('text')}[1:2] AS facts, string_split(text, chr(10))[1] AS response
          FROM documents),
        judged AS (SELECT lang, response, {sql_yes_no(sql_coverage('response', 'facts') + ' = 1')} AS correctness,
          {sql_yes_no('NOT (' + PII_ANY.replace('(text', '(response') + ')')} AS safety FROM made),
        rated AS (SELECT *, CASE WHEN correctness IS NULL AND safety IS NULL THEN NULL
          WHEN coalesce(correctness = 'no', false) OR coalesce(safety = 'no', false) THEN 'no' ELSE 'yes' END AS rating FROM judged)
        SELECT lang, count(*) AS requests, round(avg(CASE rating WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END), 6) AS pass_rate,
          count(*) FILTER (correctness = 'no') AS incorrect, count(*) FILTER (safety = 'no') AS unsafe,
          CAST(sum(length(response)) AS BIGINT) AS answer_chars FROM rated GROUP BY lang""",
)
def evaluation_run(spark: SparkSession, base: str) -> DataFrame:
    """Generate one question per document, answer it from its source, judge the answers, sum up per language."""
    docs = documents(spark, base).select(
        F.col("doc_id").alias("corpus_pos"), F.col("doc_id").cast("string").alias("doc_uri"), "lang",
        F.col("text").alias("content"),
    )
    evals = E.generate_evals(E.plan_evals(docs, per_doc=1))
    sourced = JN.with_source(evals, docs.select("doc_uri", "lang", "content"))
    answered = U.batch_predict(
        sourced.select("request_id", "lang", "request", "expected_facts", "content"), quoting_agent, "content", attempts=1
    )
    judged = J.with_overall(J.run_judges(answered, ["correctness", "safety"]), "rating")
    return judged.groupBy("lang").agg(
        F.count(F.lit(1)).alias("requests"),
        F.round(F.avg(X.pass_flag("rating")), 6).alias("pass_rate"),
        F.count_if(F.col("`response/correctness`") == "no").alias("incorrect"),
        F.count_if(F.col("`response/safety`") == "no").alias("unsafe"),
        F.sum(F.length("response")).alias("answer_chars"),
    )
