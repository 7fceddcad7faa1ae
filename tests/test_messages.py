import json

import pytest
from pyspark.sql import functions as F

from evalloom.functions import messages as M

CHAT = "m array<struct<role:string,content:string>>"


def pairs(messages):
    return [(m["role"], m["content"]) for m in messages]


@pytest.mark.parametrize(
    ("raw", "messages"),
    [
        ('{"messages": [{"role": "user", "content": "hi"}]}', [("user", "hi")]),
        ('{"messages": []}', []),
        ("not json", None),
        ("{}", None),
        (None, None),
    ],
)
def test_parse_request(one, raw, messages):
    body = one(M.parse_request("a"), row=(raw,))
    found = body and body["messages"]
    assert (pairs(found) if found is not None else None) == messages


def test_query_and_history(one):
    chat = [("system", "s"), ("user", "a"), ("assistant", "b"), ("user", "c")]
    assert one(M.user_query("m"), CHAT, (chat,)) == "c"
    assert pairs(one(M.chat_history("m"), CHAT, (chat,))) == chat[:-1]
    assert one(M.user_query("m"), CHAT, ([],)) is None
    assert one(M.chat_history("m"), CHAT, ([],)) == []
    assert one(M.chat_history("m"), CHAT, ([("user", "a")],)) == []


def test_system_message(one):
    user = [("user", "a")]
    added = one(M.ensure_system("m", "P"), CHAT, (user,))
    assert pairs(added) == [("system", "P"), ("user", "a")]
    assert pairs(one(M.ensure_system("m", "P"), CHAT, ([("system", "s")],))) == [("system", "s")]
    assert pairs(one(M.ensure_system("m", "P"), CHAT, ([],))) == [("system", "P")]
    assert pairs(one(M.strip_system("m"), CHAT, ([("system", "P"), *user],))) == user
    assert pairs(one(M.strip_system("m"), CHAT, (user,))) == user
    assert one(M.strip_system("m"), CHAT, ([],)) == []


def test_append_and_count_tool_turns(one):
    more = F.array(F.struct(F.lit("tool").alias("role"), F.lit("[]").alias("content")))
    assert pairs(one(M.append_turns("m", more, more), CHAT, ([("user", "a")],))) == [
        ("user", "a"), ("tool", "[]"), ("tool", "[]"),
    ]
    assert one(M.tool_turns("m"), CHAT, ([("tool", "x"), ("user", "y")],)) == 1


def test_drop_fields_ignores_unknown(one):
    struct = F.struct(F.lit(1).alias("a"), F.lit(2).alias("content"))
    assert one(M.drop_fields(struct, ["content", "audio"])).asDict() == {"a": 1}


def test_arguments_and_results(one):
    assert one(M.parse_args("a"), row=('{"query": ["x"], "n": 2}',)) == {"query": '["x"]', "n": "2"}
    assert one(M.parse_args("a"), row=("[oops",)) is None
    struct = F.struct(F.lit("x").alias("a"), F.lit(None).cast("string").alias("b"))
    assert json.loads(one(M.to_result_json(struct))) == {"a": "x", "b": None}


def test_tags(one):
    assert one(M.tag_list("t", structs=False), "t array<string>", (["x", "y"],)) == ["x", "y"]
    assert one(M.tag_list("t", structs=True), "t array<struct<tag_name:string>>", ([("x",)],)) == ["x"]


def test_error_struct(one):
    good = one(M.error_struct(F.lit(True), F.lit(1), "failed", F.lit("why"))).asDict()
    assert good == {"result": 1, "status": None, "error": None}
    bad = one(M.error_struct(F.lit(False), F.lit(1), "failed", F.lit("why"))).asDict()
    assert bad == {"result": None, "status": "failed", "error": "why"}
