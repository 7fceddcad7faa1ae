"""User functions, table functions and callables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions.judging import PII_PATTERNS
from evalloom.operators import traces as T
from evalloom.operators import udfs as U
from evalloom.plans.base import documents, query
from evalloom.plans.columns import SKU_TRANSLATED, sku_parts
from evalloom.sources import load


def translate_old_sku(sku: str) -> str:
    """Translate a SKU from the old format to the new one."""
    import re

    found = re.match(K.SKU_PATTERN, sku)
    return f"NEW-{found[2]}-{found[1]}" if found else K.SKU_ERROR


@query("udf_scalar", SKU_TRANSLATED)
def udf_scalar(spark: SparkSession, base: str) -> DataFrame:
    U.register_scalar(spark, translate_old_sku)
    sku_parts(spark, base).createOrReplaceTempView("sku_parts")
    return spark.sql("SELECT p_partkey, translate_old_sku(sku) AS sku FROM sku_parts")


@query(
    "sql_table_function",
    """SELECT c_custkey, o_orderkey AS order_id, o_totalprice AS amount FROM customer
       JOIN orders ON o_custkey = c_custkey""",
)
def sql_table_function(spark: SparkSession, base: str) -> DataFrame:
    load(spark, "orders", base).createOrReplaceTempView("function_orders")
    load(spark, "customer", base).createOrReplaceTempView("function_customers")
    U.register_table_fn(
        spark, "user_orders", "user_id BIGINT", "order_id BIGINT, amount DOUBLE",
        "SELECT o_orderkey, o_totalprice FROM function_orders WHERE o_custkey = user_orders.user_id",
    )
    return spark.sql(
        "SELECT c_custkey, order_id, amount FROM function_customers, LATERAL user_orders(c_custkey)"
    )


def first_sentence_agent() -> Callable[[str], str]:
    """An offline stand-in for an agent: it answers with the first sentence, and refuses `ß`.

    As a busy service does, it turns away the first two calls for each question.
    """
    calls: dict[str, int] = {}

    def answer(question: str) -> str:
        calls[question] = calls.get(question, 0) + 1
        if calls[question] <= 2:
            raise ConnectionError("busy")
        if "ß" in question:
            raise ValueError("unsupported letter")
        return question.split(".")[0]

    return answer


@query(
    "batch_predict",
    """SELECT conv_id, turn, CASE WHEN NOT contains(text, 'ß') THEN string_split(text, '.')[1] END AS response,
       CASE WHEN contains(text, 'ß') THEN 'ValueError: unsupported letter' END AS error
       FROM conversations WHERE role = 'user'""",
)
def batch_predict(spark: SparkSession, base: str) -> DataFrame:
    asked = load(spark, "conversations", base).filter("role = 'user'").select("conv_id", "turn", "text")
    return U.batch_predict(asked, first_sentence_agent, "text", attempts=3, min_seconds=0.0, concurrency=4).drop("text")


def email_judge() -> Callable[[str], str]:
    """An offline stand-in for a judging model: 1 if the prompt shows an e-mail address, else 5."""
    import re

    email = re.compile(PII_PATTERNS["email"])
    return lambda prompt: "1" if email.search(prompt) else "5"


@query(
    "prompt_judge",
    f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{PII_PATTERNS['email']}') THEN '1' ELSE '5' END AS no_email,
        CAST(NULL AS VARCHAR) AS no_email_error FROM documents""",
)
def prompt_judge(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base).select("doc_id", "text")
    template = "Rate 5 if this text shows no address and 1 if it does: '{response}'"
    return U.prompt_judge(docs, "no_email", template, email_judge, response="text", attempts=1, keep=["doc_id"])


CHUNKS = """WITH starts AS (
    SELECT doc_id, text, unnest(range(0, greatest(length(text) - 50, 1), 350)) AS start FROM documents)
  SELECT doc_id, CAST(start // 350 AS INTEGER) AS chunk_no, substr(text, CAST(start + 1 AS BIGINT), 400) AS chunk FROM starts"""


@query("udtf_chunks", CHUNKS)
def udtf_chunks(spark: SparkSession, base: str) -> DataFrame:
    U.register_chunker(spark)
    documents(spark, base).createOrReplaceTempView("documents_to_chunk")
    return spark.sql(
        "SELECT doc_id, c.chunk_no, c.chunk FROM documents_to_chunk, LATERAL chunk_text(text, 400, 50) AS c"
    )


@query(
    "table_search",
    """WITH words AS (SELECT *, len(list_intersect(['red', 'steel', 'ring', 'bolt'], list_distinct(string_split(p_name, ' ')))) AS score FROM part)
       SELECT p_partkey, p_name, p_brand, CAST(score AS INTEGER) AS search_score,
         CAST(row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS INTEGER) AS search_rank
       FROM words WHERE score > 0 QUALIFY search_rank <= 3""",
)
def table_search(spark: SparkSession, base: str) -> DataFrame:
    """The three best products of each brand for a topic, through a table function that takes the table."""
    U.register_table_search(spark)
    load(spark, "part", base).select("p_partkey", "p_name", "p_brand").createOrReplaceTempView("products_to_search")
    return spark.sql(
        "SELECT * FROM search_table(TABLE(products_to_search) PARTITION BY (p_brand), 'Red steel ring, bolt', 3, 'p_name', 'p_partkey')"
    )


@query("chunk_docs", CHUNKS)
def chunk_docs(spark: SparkSession, base: str) -> DataFrame:
    return U.chunk_docs(documents(spark, base).select("doc_id", "text"), "text", 400, 50)


@query(
    "loop_depth",
    """SELECT conv_id, CAST(count(*) FILTER (role = 'assistant') AS INTEGER) AS depth,
              count(*) FILTER (role = 'assistant') >= 3 AS at_limit FROM conversations GROUP BY 1""",
)
def loop_depth(spark: SparkSession, base: str) -> DataFrame:
    # The conversations hold no tool turns: assistant turns stand for them.
    turns = load(spark, "conversations", base)
    as_tools = turns.withColumn("role", F.when(F.col("role") == "assistant", "tool").otherwise(F.col("role")))
    return T.tool_depth(as_tools, limit=3)
