"""Keyword, vector and hybrid retrieval, samples and prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions import text as X
from evalloom.operators import judges as JD
from evalloom.operators import predicates as P
from evalloom.operators import retrieval as R
from evalloom.operators import sampling as S
from evalloom.operators import vector_index as VI
from evalloom.operators import vectors as V
from evalloom.plans.base import LOG, as_text, corpus, documents, query, request_log, sql_text, sql_words
from evalloom.session import kept_path, stage
from evalloom.sources import load

# Queries are the benchmark passages; their keywords are the five rarest words that the corpus holds.
KEYWORDS = f"""asked AS (
    SELECT item_id AS query_id, unnest(list_distinct({sql_words('text')})) AS word FROM benchmark),
  frequency AS (
    SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct({sql_words('text')})) AS word FROM documents) GROUP BY 1),
  keywords AS (
    SELECT query_id, word AS keyword, df FROM asked JOIN frequency USING (word)
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY df, word) <= 5)"""
PAIRS = f"""{KEYWORDS}, pairs AS (
    SELECT query_id, doc_id AS corpus_pos, CAST(sum(CAST(contains(lower(text), keyword) AS INTEGER)) AS BIGINT) AS score,
      CAST(any_value(n_chars) AS INTEGER) AS n_chars FROM keywords, documents GROUP BY 1, 2),
  ranked AS (
    SELECT *, CAST(row_number() OVER w AS INTEGER) AS rank,
      coalesce(sum(n_chars) OVER (PARTITION BY query_id ORDER BY score DESC, corpus_pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM pairs WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, corpus_pos)),
  kept AS (
    SELECT query_id, rank, corpus_pos, score, CAST(least(n_chars, {K.MAX_CONTEXT_CHARS} - before) AS INTEGER) AS kept_chars
    FROM ranked WHERE before <= {K.MAX_CONTEXT_CHARS})"""


def benchmark_queries(spark: SparkSession, base: str) -> DataFrame:
    """`query_id, keywords` for every benchmark passage, staged because retrieval reads it repeatedly.

    One query set is worth no index of the corpus: here and below its keywords are looked up in the text.
    """
    asked = load(spark, "benchmark", base).withColumnRenamed("item_id", "query_id")
    return stage(R.salient_keywords(asked, corpus(spark, base), 5), "benchmark-queries")


@query(
    "salient_keywords",
    f"""WITH {KEYWORDS} SELECT item_id AS query_id,
        coalesce(string_agg(keyword, ',' ORDER BY df, keyword), '') AS keywords
        FROM benchmark LEFT JOIN keywords ON item_id = query_id GROUP BY 1""",
)
def salient_keywords(spark: SparkSession, base: str) -> DataFrame:
    asked = load(spark, "benchmark", base).withColumnRenamed("item_id", "query_id")
    picked = R.salient_keywords(asked, corpus(spark, base), 5)
    return picked.select("query_id", F.array_join("keywords", ",").alias("keywords"))


SCORED = ("the", "THE", "ment", "sch", "", "zurü")


@query(
    "keyword_scores",
    "SELECT doc_id, " + " + ".join(
        f"CAST(contains(lower(text), lower('{word}')) AS INTEGER)" for word in SCORED
    ) + " AS score FROM documents",
)
def keyword_scores(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    return docs.select("doc_id", X.keyword_score("text", SCORED).alias("score"))


@query("keyword_matches", f"WITH {PAIRS} SELECT query_id, corpus_pos, score FROM pairs WHERE score > 0")
def keyword_matches(spark: SparkSession, base: str) -> DataFrame:
    matches = R.keyword_matches(benchmark_queries(spark, base), corpus(spark, base))
    return matches.select("query_id", "corpus_pos", "score")


@query("keyword_rank", f"WITH {PAIRS} SELECT query_id, rank, corpus_pos, score FROM ranked WHERE rank <= 10")
def keyword_rank(spark: SparkSession, base: str) -> DataFrame:
    return R.keyword_rank(benchmark_queries(spark, base), corpus(spark, base), 10).drop("n_chars")


@query("context_budget", f"WITH {PAIRS} SELECT query_id, rank, corpus_pos, score, kept_chars FROM kept")
def context_budget(spark: SparkSession, base: str) -> DataFrame:
    return R.retrieve_context(benchmark_queries(spark, base), corpus(spark, base))


@query(
    "build_prompt",
    f"""WITH {PAIRS}, contexts AS (
          SELECT query_id, string_agg(substr(text, 1, kept_chars), chr(10) || chr(10) ORDER BY rank) AS context
          FROM kept JOIN documents ON doc_id = corpus_pos GROUP BY 1),
        prompts AS (
          SELECT item_id AS query_id, replace(replace('{K.PROMPT}', '{{user_query}}', text), '{{context}}', coalesce(context, ''))
            AS prompt FROM benchmark LEFT JOIN contexts ON item_id = query_id)
        SELECT query_id, CAST(length(prompt) AS INTEGER) AS prompt_chars, md5(prompt) AS prompt_md5 FROM prompts""",
)
def build_prompt(spark: SparkSession, base: str) -> DataFrame:
    docs = corpus(spark, base)
    asked = load(spark, "benchmark", base).withColumnRenamed("item_id", "query_id")
    kept = R.retrieve_context(benchmark_queries(spark, base), docs)
    prompts = R.build_prompts(asked, kept, docs)
    return prompts.select("query_id", F.length("prompt").alias("prompt_chars"), F.md5("prompt").alias("prompt_md5"))


# Vector queries are the topics: the mean vector of each label over the whole table.
CENTROIDS = """dims AS (SELECT vec_id, CAST(label AS BIGINT) AS label, unnest(range(1, 65)) AS dim, unnest(embedding) AS x FROM embeddings),
  centres AS (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS x FROM dims GROUP BY 1, 2),
  centroids AS (SELECT label, list(x ORDER BY dim) AS centre FROM centres GROUP BY 1),
  near AS (SELECT c.label AS query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 6) AS score
           FROM embeddings e, centroids c)"""


def topk_sql(k: int) -> str:
    return f"""{CENTROIDS}, nearest AS (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score FROM near QUALIFY rank <= {k})"""


def topic_queries(spark: SparkSession, base: str) -> DataFrame:
    return V.centroids(load(spark, "embeddings", base))


@query("vector_topk", f"WITH {topk_sql(10)} SELECT * FROM nearest")
def vector_topk(spark: SparkSession, base: str) -> DataFrame:
    return V.vector_topk(topic_queries(spark, base), load(spark, "embeddings", base), 10)


@query("similarity_threshold", f"WITH {topk_sql(10)} SELECT * FROM nearest WHERE score >= 0.36")
def similarity_threshold(spark: SparkSession, base: str) -> DataFrame:
    return P.min_score(vector_topk(spark, base), 0.36)


@query(
    "filtered_search",
    f"""WITH {CENTROIDS}, nearest AS (
          SELECT n.query_id, CAST(row_number() OVER (PARTITION BY n.query_id ORDER BY score DESC, n.vec_id) AS INTEGER) AS rank,
            n.vec_id, score FROM near n JOIN embeddings e ON e.vec_id = n.vec_id WHERE e.label IN (1, 2, 3, 4, 5)
          QUALIFY rank <= 5)
        SELECT query_id, rank, vec_id, score FROM nearest WHERE score >= 0.36""",
)
def filtered_search(spark: SparkSession, base: str) -> DataFrame:
    """Filter spec before the search, so it reaches the scan; score threshold after it."""
    spec = [{"field": "label", "filter": [1, 2, 3, 4, 5]}]
    vectors = load(spark, "embeddings", base).filter(P.compile_filters(spec, ["label"]))
    return P.min_score(V.vector_topk(topic_queries(spark, base), vectors), 0.36)


# The sides of 8 hyperplanes in each of 16 tables; a query also looks into the buckets across one plane.
BUCKETS = """planes AS (
    SELECT t, b, d, CASE WHEN substr(md5('0:' || t || ':' || b || ':' || d), 1, 1) < '8' THEN 1 ELSE -1 END AS s
    FROM range(16) ts(t), range(8) bs(b), range(64) ds(d)),
  held_sides AS (SELECT vec_id, t, b, sum(CAST(x AS DOUBLE) * s) AS side FROM dims JOIN planes ON d = dim - 1 GROUP BY 1, 2, 3),
  held AS (SELECT vec_id, t, CAST(sum(CASE WHEN side > 0 THEN 1 << b ELSE 0 END) AS INTEGER) AS signature FROM held_sides GROUP BY 1, 2),
  asked_sides AS (SELECT label, t, b, sum(x * s) AS side FROM centres JOIN planes ON d = dim - 1 GROUP BY 1, 2, 3),
  asked AS (SELECT label, t, CAST(sum(CASE WHEN side > 0 THEN 1 << b ELSE 0 END) AS INTEGER) AS signature FROM asked_sides GROUP BY 1, 2),
  met AS (SELECT DISTINCT label AS query_id, vec_id FROM asked a JOIN held h ON a.t = h.t AND bit_count(xor(a.signature, h.signature)) <= 1)"""


@query(
    "vector_topk_ann",
    f"""WITH {CENTROIDS}, {BUCKETS}
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
          vec_id, score FROM near JOIN met USING (query_id, vec_id) QUALIFY rank <= 10""",
)
def vector_topk_ann(spark: SparkSession, base: str) -> DataFrame:
    vectors = load(spark, "embeddings", base).select("vec_id", "embedding")
    index = stage(V.lsh_signatures(vectors, dimensions=64), "vector-index")
    asked = V.lsh_signatures(topic_queries(spark, base), dimensions=64)
    return V.vector_topk_ann(asked, index, 10)


def cells_sql(sample: int = VI.SAMPLE, rounds: int = VI.ROUNDS) -> str:
    """The trained cells: as many as the root of the vectors, from the first in order of digests, in rounds of means."""
    def scaled(v: str) -> str:
        return f"list_transform({v}, lambda x: x / sqrt(list_inner_product({v}, {v})))"

    def nearest(rows: str, centres: str) -> str:
        return f"""SELECT vec_id, cell, u FROM {rows}, {centres} WHERE true
          QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_inner_product(u, c) DESC, cell) = 1"""

    steps = [
        f"""units AS MATERIALIZED (SELECT vec_id, {scaled('v')} AS u, row_number() OVER (ORDER BY md5('0:' || vec_id), vec_id) - 1 AS place
              FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
          trained AS (SELECT * FROM units WHERE place < {sample}),
          cells0 AS (SELECT place AS cell, u AS c FROM trained WHERE place < (SELECT ceil(sqrt(count(*))) FROM units))"""
    ]
    for i in range(rounds):
        steps.append(f"""near{i} AS MATERIALIZED ({nearest('trained', f'cells{i}')}),
          mean{i} AS (SELECT cell, list(x ORDER BY d) AS m FROM (
            SELECT cell, d, avg(u[d]) AS x FROM near{i}, range(1, 65) ds(d) GROUP BY 1, 2) GROUP BY 1),
          cells{i + 1} AS MATERIALIZED (SELECT cell, coalesce({scaled('m')}, c) AS c FROM cells{i} LEFT JOIN mean{i} USING (cell))""")
    return ", ".join([*steps, f"celled AS MATERIALIZED ({nearest('units', f'cells{rounds}')})"])


@query(
    "vector_topk_index",
    f"""WITH {CENTROIDS}, {cells_sql()},
        probed AS (SELECT label AS query_id, cell FROM centroids, cells{VI.ROUNDS} WHERE true
          QUALIFY row_number() OVER (PARTITION BY label ORDER BY list_inner_product(centre, c) DESC, cell)
            <= ceil((SELECT count(*) FROM cells0) ^ {VI.PROBE_POWER}))
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM near JOIN celled USING (vec_id) JOIN probed USING (query_id, cell) QUALIFY rank <= 10""",
)
def vector_topk_index(spark: SparkSession, base: str) -> DataFrame:
    """Through the stored index, which the first query over a table builds."""
    vectors = load(spark, "embeddings", base)
    path = kept_path(vectors, "vector-index", lambda path: VI.build_vector_index(vectors, path, dimensions=64))
    return VI.search_index(topic_queries(spark, base), VI.open_vector_index(spark, path), 10)


@query(
    "hybrid_topk",
    f"""WITH {topk_sql(20)}, spread AS (
          SELECT label, unnest({sql_words('text')}) AS word FROM documents JOIN embeddings ON doc_id = vec_id),
        counted AS (
          SELECT CAST(label AS BIGINT) AS query_id, word, count(*) AS n FROM spread WHERE length(word) >= 6 GROUP BY 1, 2),
        terms AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, word) <= 4),
        matched AS (
          SELECT query_id, doc_id, sum(CAST(contains(lower(text), word) AS INTEGER)) AS score FROM terms, documents
          GROUP BY 1, 2 HAVING score > 0),
        by_keyword AS (
          SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS keyword_rank
          FROM matched QUALIFY keyword_rank <= 20),
        fused AS (
          SELECT coalesce(k.query_id, n.query_id) AS query_id, coalesce(k.doc_id, n.vec_id) AS doc_id, keyword_rank,
            n.rank AS vector_rank,
            round(coalesce(1.0 / (60 + keyword_rank), 0) + coalesce(1.0 / (60 + n.rank), 0), 9) AS score
          FROM by_keyword k FULL JOIN nearest n ON k.query_id = n.query_id AND k.doc_id = n.vec_id)
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
        FROM fused QUALIFY rank <= 10""",
)
def hybrid_topk(spark: SparkSession, base: str) -> DataFrame:
    vectors = load(spark, "embeddings", base)
    docs = documents(spark, base)
    labelled = docs.join(vectors.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id")
    terms = JD.term_frequency_topics(labelled, "text", "label", 4, min_letters=6)
    asked = stage(terms.select(F.col("label").cast("bigint").alias("query_id"), "keywords"), "topic-terms")
    by_keyword = R.keyword_rank(asked, corpus(spark, base), 20, min_score=1)
    by_vector = V.vector_topk(topic_queries(spark, base), vectors, 20)
    return R.fuse_ranks(
        by_keyword.withColumnRenamed("corpus_pos", "doc_id"),
        by_vector.withColumnRenamed("vec_id", "doc_id"),
        10, "doc_id",
    )


@query(
    "topic_centroid",
    f"""WITH {CENTROIDS} SELECT vec_id, query_id AS topic, score FROM near
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, query_id) = 1""",
)
def topic_centroid(spark: SparkSession, base: str) -> DataFrame:
    return V.nearest_topic(load(spark, "embeddings", base), topic_queries(spark, base))


@query(
    "hourly_cap",
    f"""WITH {LOG} SELECT request_id, {sql_text('ts')} AS ts FROM log
        QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY md5('3:' || request_id), request_id) <= 5""",
)
def hourly_cap(spark: SparkSession, base: str) -> DataFrame:
    capped = S.cap_per_hour(request_log(spark, base).select("request_id", "ts"), 5, ts="ts", seed=3)
    return capped.select("request_id", as_text("ts").alias("ts"))


@query(
    "hash_sample",
    """SELECT event_id, event_type FROM events
       WHERE CAST('0x' || substr(md5('11:' || event_id), 1, 8) AS BIGINT) < 0.3 * 4294967296""",
)
def hash_sample(spark: SparkSession, base: str) -> DataFrame:
    return S.hash_sample(load(spark, "events", base).select("event_id", "event_type"), 0.3, "event_id", 11)


@query("random_n", "SELECT doc_id, lang FROM documents ORDER BY md5('5:' || doc_id), doc_id LIMIT 100")
def random_n(spark: SparkSession, base: str) -> DataFrame:
    return S.random_n(load(spark, "documents", base).select("doc_id", "lang"), 100, "doc_id", 5)


@query("first_n", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 500")
def first_n(spark: SparkSession, base: str) -> DataFrame:
    return S.first_n(load(spark, "documents", base).select("doc_id", "lang", "n_chars"), 500, "doc_id")
