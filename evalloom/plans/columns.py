"""Scalar functions over text, chat messages and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions import messages as M
from evalloom.functions import text as X
from evalloom.operators import evalset as E
from evalloom.operators import traces as T
from evalloom.operators import vectors as V
from evalloom.plans.base import as_text, documents, query, sql_sentences, sql_strip, sql_text
from evalloom.sources import load

# Parts have no SKU: this makes one from type and key, and every third is not in the old format.
SKU_SQL = """CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE
  'OLD-' || upper(substr(p_type, 1, 3)) || '-' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') END"""


def sku_parts(spark: SparkSession, base: str) -> DataFrame:
    number = F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0")
    made = F.concat(F.lit("OLD-"), F.upper(F.substring("p_type", 1, 3)), F.lit("-"), number)
    sku = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(made)
    return load(spark, "part", base).select("p_partkey", sku.alias("sku"))


SKU_TRANSLATED = f"""SELECT p_partkey, CASE WHEN regexp_matches(sku, '{K.SKU_PATTERN}')
  THEN 'NEW-' || regexp_extract(sku, '{K.SKU_PATTERN}', 2) || '-' || regexp_extract(sku, '{K.SKU_PATTERN}', 1)
  ELSE '{K.SKU_ERROR}' END AS sku FROM (SELECT p_partkey, {SKU_SQL} AS sku FROM part)"""


@query("translate_sku", SKU_TRANSLATED)
def translate_sku(spark: SparkSession, base: str) -> DataFrame:
    return sku_parts(spark, base).select("p_partkey", X.translate_sku("sku").alias("sku"))


@query(
    "parse_keywords",
    f"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, ','), lambda w: {sql_strip('w')}),
        lambda w: w <> ''), '|') AS keywords FROM documents""",
)
def parse_keywords(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    return docs.select("doc_id", F.array_join(X.parse_keywords("text"), "|").alias("keywords"))


NOTES_SQL = f"""notes AS (
  SELECT doc_id, {sql_sentences('text')} AS facts,
    CASE WHEN len(facts) > 0 THEN '{K.NOTES_HEADER}' || chr(10) || '- ' || array_to_string(facts, chr(10) || '- ') END
    AS notes FROM documents)"""


def graded_docs(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    return docs.select("doc_id", "text", X.render_notes(X.sentences("text")).alias("notes"))


@query("render_grading_notes", f"WITH {NOTES_SQL} SELECT doc_id, md5(notes) AS notes_md5 FROM notes")
def render_grading_notes(spark: SparkSession, base: str) -> DataFrame:
    return graded_docs(spark, base).select("doc_id", F.md5("notes").alias("notes_md5"))


def sql_undash(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '^[- ]+', '')")


def sql_parse_notes(notes: str) -> str:
    lines = f"string_split({notes}, chr(10))"
    body = f"CASE WHEN starts_with({sql_undash(notes)}, '{K.NOTES_PREFIX}') THEN {lines}[2:] ELSE {lines} END"
    return f"list_filter(list_transform({body}, lambda l: {sql_undash('l')}), lambda l: l <> '')"


@query(
    "parse_grading_notes",
    f"""WITH {NOTES_SQL}, mixed AS (SELECT doc_id, notes FROM notes UNION ALL SELECT doc_id, text FROM documents)
        SELECT doc_id, array_to_string({sql_parse_notes('notes')}, '|') AS facts FROM mixed WHERE notes IS NOT NULL""",
)
def parse_grading_notes(spark: SparkSession, base: str) -> DataFrame:
    graded = graded_docs(spark, base)
    mixed = graded.select("doc_id", "notes").union(graded.select("doc_id", "text")).filter("notes IS NOT NULL")
    return mixed.select("doc_id", F.array_join(X.parse_notes("notes"), "|").alias("facts"))


@query(
    "first_filled",
    """SELECT doc_id, coalesce(CASE WHEN lang = 'en' THEN source END, nullif(CASE WHEN lang = 'fr' THEN '' ELSE lang END, ''),
       'none') AS value FROM documents""",
)
def first_filled(spark: SparkSession, base: str) -> DataFrame:
    english = F.when(F.col("lang") == "en", F.col("source"))
    other = F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("lang"))
    docs = load(spark, "documents", base)
    return docs.select("doc_id", X.first_filled(english, other, F.lit("none")).alias("value"))


@query(
    "principal_slug",
    "SELECT page_id, replace(string_split('crawl.' || split_part(url, '/', 3) || '@example.com', '@')[1], '.', '_') AS slug FROM pages",
)
def principal_slug(spark: SparkSession, base: str) -> DataFrame:
    address = F.concat(F.lit("crawl."), F.split_part("url", F.lit("/"), F.lit(3)), F.lit("@example.com"))
    return load(spark, "pages", base).select("page_id", X.principal_slug(address).alias("slug"))


@query(
    "quote_identifier",
    """SELECT page_id, '`' || replace(host, '.', '`.`') || '`' AS quoted, replace(host, '.', '__') AS tool,
       replace(host, '.', '/') AS folder FROM (SELECT page_id, split_part(url, '/', 3) AS host FROM pages)""",
)
def quote_identifier(spark: SparkSession, base: str) -> DataFrame:
    host = F.split_part("url", F.lit("/"), F.lit(3))
    return load(spark, "pages", base).select(
        "page_id", X.quote_ident(host).alias("quoted"), X.tool_name(host).alias("tool"),
        X.folder_name(host).alias("folder"),
    )


@query(
    "percent_text",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS discount
       FROM lineitem""",
)
def percent_text(spark: SparkSession, base: str) -> DataFrame:
    items = load(spark, "lineitem", base)
    return items.select("l_orderkey", "l_linenumber", "l_partkey", X.pct("l_discount").alias("discount"))


HOUR = "date_trunc('hour', ts)"


@query("hour_bucket", f"SELECT event_id, {sql_text(HOUR)} AS hour FROM events")
def hour_bucket(spark: SparkSession, base: str) -> DataFrame:
    events = load(spark, "events", base).select("event_id", X.hour_of("ts").alias("hour"))
    return events.select("event_id", as_text("hour").alias("hour"))


# --- chat messages --------------------------------------------------------------------------------

# One text per message, to compare.
SHOWN = "md5(role || ':' || text)"


def shown(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", "role", F.md5(F.concat("role", F.lit(":"), "text")).alias("shown"))


@query(
    "messages_from_turns",
    """WITH m AS (SELECT conv_id, turn // 3 AS part, list({'role': role, 'content': text} ORDER BY turn) AS messages
               FROM conversations GROUP BY 1, 2)
       SELECT conv_id, part, CAST(len(messages) AS INTEGER) AS turns,
              md5(array_to_string(list_transform(messages, lambda m: m.role || ':' || m.content), '|')) AS shown FROM m""",
)
def messages_from_turns(spark: SparkSession, base: str) -> DataFrame:
    parts = T.messages_from_turns(load(spark, "conversations", base), part_turns=3)
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return parts.select("conv_id", "part", F.size("messages").alias("turns"), F.md5(text).alias("shown"))


@query(
    "parse_request_json",
    """SELECT conv_id, turn, role, text AS content FROM conversations WHERE conv_id % 10 <> 3""",
)
def parse_request_json(spark: SparkSession, base: str) -> DataFrame:
    turns = load(spark, "conversations", base)
    body = F.struct(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages"))
    # Some bodies are cut off on the way: they hold no messages.
    whole = F.to_json(body)
    sent = F.when(F.col("conv_id") % 10 == 3, F.expr("left(r, length(r) - 2)")).otherwise(F.col("r"))
    raw = turns.withColumn("r", whole).select("conv_id", "turn", sent.alias("request_raw"))
    parsed = raw.select("conv_id", "turn", F.explode(M.parse_request("request_raw")["messages"]).alias("m"))
    return parsed.select("conv_id", "turn", "m.role", "m.content")


@query("user_query", "SELECT conv_id, arg_max(text, turn) AS user_query FROM conversations GROUP BY 1")
def user_query(spark: SparkSession, base: str) -> DataFrame:
    return T.last_query(load(spark, "conversations", base))


@query(
    "chat_history",
    f"""SELECT conv_id, turn, role, {SHOWN} AS shown FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) > 1""",
)
def chat_history(spark: SparkSession, base: str) -> DataFrame:
    return shown(T.history(load(spark, "conversations", base)))


PROMPT = "Answer from the documents."
FIRST = "first AS (SELECT conv_id, min(turn) AS turn, arg_min(role, turn) AS role FROM conversations GROUP BY 1)"


@query(
    "ensure_system_prompt",
    f"""WITH {FIRST}, added AS (SELECT conv_id, turn - 1 AS turn, 'system' AS role, '{PROMPT}' AS text FROM first
          WHERE role <> 'system')
        SELECT conv_id, turn, role, {SHOWN} AS shown FROM conversations
        UNION ALL SELECT conv_id, turn, role, {SHOWN} FROM added""",
)
def ensure_system_prompt(spark: SparkSession, base: str) -> DataFrame:
    return shown(T.with_system(load(spark, "conversations", base), PROMPT))


@query(
    "strip_system_prompt",
    f"""WITH {FIRST} SELECT c.conv_id, c.turn, c.role, md5(c.role || ':' || text) AS shown
        FROM conversations c JOIN first f USING (conv_id) WHERE NOT (c.turn = f.turn AND f.role = 'system')""",
)
def strip_system_prompt(spark: SparkSession, base: str) -> DataFrame:
    return shown(T.without_system(load(spark, "conversations", base)))


@query(
    "append_messages",
    f"""WITH l AS (SELECT conv_id, max(turn) AS last, arg_max(text, turn) AS said FROM conversations GROUP BY 1),
          more AS (SELECT conv_id, last + 1 AS turn, 'assistant' AS role, said AS text FROM l
                   UNION ALL SELECT conv_id, last + 2, 'tool', '[]' FROM l)
        SELECT conv_id, turn, role, {SHOWN} AS shown FROM conversations
        UNION ALL SELECT conv_id, turn, role, {SHOWN} FROM more""",
)
def append_messages(spark: SparkSession, base: str) -> DataFrame:
    turns = load(spark, "conversations", base)
    more = T.last_query(turns).select("conv_id", F.explode(F.array(
        F.struct(F.lit(1).alias("place"), F.lit("assistant").alias("role"), F.col("user_query").alias("text")),
        F.struct(F.lit(2).alias("place"), F.lit("tool").alias("role"), F.lit("[]").alias("text")),
    )).alias("m")).select("conv_id", "m.*")
    return shown(T.answered(turns, more))


@query(
    "drop_struct_fields",
    """SELECT conv_id, turn, CAST(to_json({'role': role, 'turn': turn}) AS VARCHAR) AS message FROM conversations""",
)
def drop_struct_fields(spark: SparkSession, base: str) -> DataFrame:
    message = F.struct("role", F.col("text").alias("content"), "turn", F.lit(None).cast("string").alias("audio"))
    turns = load(spark, "conversations", base)
    kept = M.drop_fields(message, ["content", "function_call", "audio"])
    return turns.select("conv_id", "turn", M.to_result_json(kept).alias("message"))


@query(
    "parse_tool_args",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_type = 'error' THEN NULL ELSE 1 END AS arguments FROM events",
)
def parse_tool_args(spark: SparkSession, base: str) -> DataFrame:
    # An error event's arguments are cut short here, so they do not parse.
    events = load(spark, "events", base)
    cut = F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(F.col("props"))
    return events.select(
        "event_id", M.parse_args("props")["k"].alias("k"), F.size(M.parse_args(cut)).alias("arguments")
    )


@query(
    "result_to_json",
    """SELECT p_partkey, CAST(to_json({'id': p_partkey, 'name': p_name, 'size': p_size}) AS VARCHAR) AS result FROM part""",
)
def result_to_json(spark: SparkSession, base: str) -> DataFrame:
    row = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return load(spark, "part", base).select("p_partkey", M.to_result_json(row).alias("result"))


@query(
    "as_document",
    """SELECT p_name AS page_content, CAST(p_partkey AS VARCHAR) AS id, p_brand AS brand,
       CAST(p_size AS VARCHAR) AS score FROM part""",
)
def as_document(spark: SparkSession, base: str) -> DataFrame:
    results = load(spark, "part", base).select("p_partkey", "p_name", "p_brand", F.col("p_size").alias("score"))
    meta = F.col("metadata")
    return V.as_document(results, "p_name").select(
        "page_content", meta["p_partkey"].alias("id"), meta["p_brand"].alias("brand"),
        meta["similarity_score"].alias("score"),
    )


@query("normalize_tags", "SELECT doc_id, lang || ',' || source AS names, lang || ',' || source AS structs FROM documents")
def normalize_tags(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, "documents", base)
    names = F.array("lang", "source")
    structs = F.array(*[F.struct(F.col(c).alias("tag_name")) for c in ("lang", "source")])
    return docs.select(
        "doc_id",
        F.array_join(M.tag_list(names, structs=False), ",").alias("names"),
        F.array_join(M.tag_list(structs, structs=True), ",").alias("structs"),
    )


@query(
    "error_struct",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS result,
       CASE WHEN event_type = 'error' THEN 'Tool failed.' END AS status,
       CASE WHEN event_type = 'error' THEN props END AS error FROM events""",
)
def error_struct(spark: SparkSession, base: str) -> DataFrame:
    events = load(spark, "events", base)
    outcome = M.error_struct(F.col("event_type") != "error", "value", "Tool failed.", "props")
    return events.select("event_id", outcome.alias("outcome")).select("event_id", "outcome.*")


@query(
    "facts_from_answer",
    f"""WITH s AS (SELECT conv_id, turn, {sql_sentences('text')} AS facts FROM conversations WHERE role = 'assistant')
        SELECT conv_id, turn, array_to_string(list_filter(facts, lambda f, i: list_position(facts, f) = i), '|') AS facts FROM s""",
)
def facts_from_answer(spark: SparkSession, base: str) -> DataFrame:
    answers = load(spark, "conversations", base).filter("role = 'assistant'")
    return answers.select("conv_id", "turn", F.array_join(E.facts_from_answer("text"), "|").alias("facts"))


@query(
    "prompt_places",
    f"""WITH ends AS (SELECT conv_id, max(turn) AS last, min(turn) AS first, arg_min(role, turn) AS opens, arg_max(text, turn) AS question
          FROM conversations GROUP BY 1),
        prompts AS (SELECT *, replace(replace('{K.PROMPT}', '{{user_query}}', question), '{{context}}', opens) AS prompt FROM ends),
        placed AS (
          SELECT 'user' AS place, conv_id, turn, CASE WHEN turn = last THEN 'user' ELSE role END AS role,
            CASE WHEN turn = last THEN prompt ELSE text END AS text FROM conversations JOIN prompts USING (conv_id)
          UNION ALL SELECT 'system', conv_id, turn, role, CASE WHEN turn = first AND opens = 'system' THEN prompt ELSE text END
            FROM conversations JOIN prompts USING (conv_id)
          UNION ALL SELECT 'system', conv_id, first - 1, 'system', prompt FROM prompts WHERE opens <> 'system')
        SELECT place, conv_id, turn, role, md5(text) AS text_md5 FROM placed""",
)
def prompt_places(spark: SparkSession, base: str) -> DataFrame:
    """The prompt of every conversation in each of its two places; the role that opens it stands for the context."""
    turns = load(spark, "conversations", base)
    ends = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("question"), F.min_by("role", "turn").alias("opens"))
    prompts = ends.select("conv_id", X.fill_prompt("opens", "question").alias("prompt"))
    placed = [T.with_prompt(turns, prompts, place).withColumn("place", F.lit(place)) for place in ("user", "system")]
    return placed[0].union(placed[1]).select("place", "conv_id", "turn", "role", F.md5("text").alias("text_md5"))
