"""Chat messages: arrays of `struct<role, content>`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalloom import schemas
from evalloom.functions.text import ColumnLike, as_column


def parse_request(raw: ColumnLike) -> Column:
    """The request body as a struct; text that is not JSON gives null messages."""
    return F.from_json(as_column(raw), schemas.REQUEST_BODY)


def user_query(messages: ColumnLike) -> Column:
    """Content of the last message; null if there is none."""
    return F.try_element_at(as_column(messages), F.lit(-1))["content"]


def chat_history(messages: ColumnLike) -> Column:
    """Every message but the last."""
    messages = as_column(messages)
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def starts_with_system(messages: ColumnLike) -> Column:
    first = F.try_element_at(as_column(messages), F.lit(1))
    return F.coalesce(first["role"] == "system", F.lit(False))


def ensure_system(messages: ColumnLike, prompt: str) -> Column:
    """Put a system message first unless the first one already is."""
    messages = as_column(messages)
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")))
    return F.when(starts_with_system(messages), messages).otherwise(F.concat(system, messages))


def strip_system(messages: ColumnLike) -> Column:
    """Remove the first message if it is a system message, before the answer goes back to the caller."""
    messages = as_column(messages)
    rest = F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0)))
    return F.when(starts_with_system(messages), rest).otherwise(messages)


def append_turns(messages: ColumnLike, *more: ColumnLike) -> Column:
    """Messages followed by the arrays in `more` (the assistant turn, then its tool results)."""
    return F.concat(as_column(messages), *[as_column(m) for m in more])


def drop_fields(message: ColumnLike, names: Sequence[str]) -> Column:
    """A message struct without the named fields. Names it does not have are ignored."""
    return as_column(message).dropFields(*names)


def parse_args(arguments: ColumnLike) -> Column:
    """Tool-call arguments as a map; arguments that are not a JSON object give null."""
    return F.from_json(as_column(arguments), "map<string,string>")


def to_result_json(result: ColumnLike) -> Column:
    """A struct, map or array as JSON text."""
    return F.to_json(as_column(result), {"ignoreNullFields": "false"})


def tag_list(tags: ColumnLike, structs: bool) -> Column:
    """Tag names, from tags kept as names or as structs with a `tag_name`."""
    tags = as_column(tags)
    return F.transform(tags, lambda tag: tag["tag_name"]) if structs else tags


def error_struct(ok: ColumnLike, result: ColumnLike, status: str, error: ColumnLike) -> Column:
    """`struct<result, status, error>`: a failure fills the last two in place of raising."""
    ok = as_column(ok)
    return F.struct(
        F.when(ok, as_column(result)).alias("result"),
        F.when(~ok, F.lit(status)).alias("status"),
        F.when(~ok, as_column(error)).alias("error"),
    )


def tool_turns(messages: ColumnLike) -> Column:
    """How many messages are tool results."""
    return F.size(F.filter(as_column(messages), lambda m: m["role"] == "tool"))
