import datetime as dt
import json
import random

from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.operators import monitoring as MO
from evalloom.operators import traces as T


def test_long_conversations_are_cut_in_parts(spark):
    turns = [("long", n, "user" if n % 2 else "assistant", f"t{n}") for n in range(25)] + [("short", 3, "user", "x")]
    table = spark.createDataFrame(turns, "conv_id string, turn int, role string, text string").repartition(4)
    parts = sorted(T.messages_from_turns(table, part_turns=10).collect())
    assert [(r.conv_id, r.part, len(r.messages)) for r in parts] == [
        ("long", 0, 10), ("long", 1, 10), ("long", 2, 5), ("short", 0, 1),
    ]
    assert [m.content for r in parts[:3] for m in r.messages] == [f"t{n}" for n in range(25)]


def test_long_conversations_stay_whole(spark):
    """2,500 turns: the first and last message, counts and order are those of the whole conversation."""
    roles = ["user", "assistant", "tool", "assistant"]
    turns = [("long", n, roles[n % 4], f"t{n}") for n in range(2500)]
    turns += [("led", 5, "system", "s"), ("led", 7, "user", "q"), ("one", 2, "user", "only")]
    table = spark.createDataFrame(turns, "conv_id string, turn int, role string, text string").repartition(4)

    def of(df, key):
        return [(r.turn, r.role, r.text) for r in sorted(df.filter(F.col("conv_id") == key).collect(), key=lambda r: r.turn)]

    assert {r.conv_id: r.user_query for r in T.last_query(table).collect()} == {"long": "t2499", "led": "q", "one": "only"}
    assert len(of(T.history(table), "long")) == 2499 and of(T.history(table), "one") == []
    with_system = T.with_system(table, "p")
    assert of(with_system, "long")[:2] == [(-1, "system", "p"), (0, "user", "t0")] and len(of(with_system, "long")) == 2501
    assert of(with_system, "led") == [(5, "system", "s"), (7, "user", "q")]
    assert of(T.without_system(table), "led") == [(7, "user", "q")] and len(of(T.without_system(table), "long")) == 2500
    more = spark.createDataFrame([("long", 1, "assistant", "a"), ("long", 2, "tool", "[]")],
                                 "conv_id string, place int, role string, text string")
    assert of(T.answered(table, more), "long")[-3:] == [(2499, "assistant", "t2499"), (2500, "assistant", "a"), (2501, "tool", "[]")]
    assert {r.conv_id: (r.depth, r.at_limit) for r in T.tool_depth(table, limit=625).collect()} == {
        "long": (625, True), "led": (0, False), "one": (0, False)}


def test_spans(spark):
    trace = json.dumps(
        [{"name": "agent", "span_type": "AGENT", "start": 0, "end": 9}, {"name": "llm", "span_type": "CHAT_MODEL", "start": 2}]
    )
    table = spark.createDataFrame([("a", trace), ("b", "no json"), ("c", "[]"), ("d", None)], "request_id string, trace string")
    found = [(r.request_id, r.span_no, r.span_type, r.duration) for r in T.spans(table, "trace", "request_id").collect()]
    assert found == [("a", 0, "AGENT", 9), ("a", 1, "CHAT_MODEL", None)]
    latency = {r.span_type: (r.spans, r.p50_duration) for r in T.span_latency(T.spans(table), exact=True).collect()}
    assert latency == {"AGENT": (1, 9.0), "CHAT_MODEL": (1, None)}
    assert {r.span_type: r.spans for r in T.span_latency(T.spans(table)).collect()} == {"AGENT": 1, "CHAT_MODEL": 1}


def test_span_tree_is_the_brute_force_one(spark):
    rng = random.Random(2)
    traces = {}
    for n in range(60):
        spans = [{"name": "root", "start": 0, "end": 40}] if n % 3 else []
        for i in range(rng.randrange(12)):
            start = rng.choice([None, *range(30)]) if i % 5 == 4 else rng.randrange(30)
            spans.append({"name": f"s{i}", "start": start, "end": None if start is None or rng.random() < 0.1 else start + rng.randrange(12)})
        traces[n] = spans
    table = spark.createDataFrame([(n, json.dumps(t)) for n, t in traces.items()] + [(99, "no json"), (98, None)], "id int, trace string")
    found = {(r.id, r.span_no): (r.parent, r.depth, r.self_time) for r in T.span_tree(table, "trace", "id").collect()}
    expected = {}
    for n, spans in traces.items():
        order = sorted((i for i, s in enumerate(spans) if s["start"] is not None),
                       key=lambda i: (spans[i]["start"], spans[i]["end"] is None, -(spans[i]["end"] or 0), i))
        parent = dict.fromkeys(range(len(spans)))
        for at, i in enumerate(order):
            until = spans[i]["end"] if spans[i]["end"] is not None else spans[i]["start"]
            parent[i] = next((j for j in reversed(order[:at]) if spans[j]["end"] is not None and spans[j]["end"] >= until), None)
        for i, s in enumerate(spans):
            depth, up = 0, parent[i]
            while up is not None:
                depth, up = depth + 1, parent[up]
            took = None if s["end"] is None else s["end"] - s["start"]
            used = sum(x["end"] - x["start"] for j, x in enumerate(spans) if parent[j] == i and x["end"] is not None)
            expected[n, i] = (parent[i], depth, None if took is None else max(0, took - used))
    assert found == expected and max(x[1] for x in expected.values()) >= 3


def test_loop_depth(spark):
    chats = [("few", [("tool", "x")] * 9), ("limit", [("tool", "x")] * 10), ("none", [])]
    table = spark.createDataFrame(chats, "id string, messages array<struct<role:string,content:string>>")
    assert {r.id: (r.depth, r.at_limit) for r in T.loop_depth(table).collect()} == {
        "few": (9, False), "limit": (10, True), "none": (0, False),
    }


def test_turn_sequence(spark):
    roles = ["tool", "user", "user", "assistant", "tool", "tool", "assistant", "user", "tool"]
    table = spark.createDataFrame([("c", n, r) for n, r in enumerate(roles)], "conv_id string, turn int, role string")
    found = T.turn_sequence(table).orderBy("turn").collect()
    assert [r.turn for r in found if r.repeated] == [2]
    assert [r.turn for r in found if r.orphan_tool] == [0, 8]
    assert [r.prev_role for r in found] == [None, *roles[:-1]]


def test_monitoring_cycle(spark):
    now = dt.datetime(2024, 1, 31, 12, 59)
    log = spark.createDataFrame(
        [(f"r{i}", now - dt.timedelta(minutes=i), None, None) for i in range(40)]
        + [("old", now - dt.timedelta(days=31), None, None), ("done", now, "run-0", "yes")],
        "request_id string, timestamp timestamp, run_id string, rating string",
    )
    feedback = spark.createDataFrame([("r39", now), ("old", now)], "request_id string, timestamp timestamp")

    def judge(rows):
        return rows.select("request_id", F.lit("no").alias("rating"))

    def cycle(table):
        return MO.run_cycle(table, feedback, F.lit(now), judge, "run-1", rate=1.0, cap=10)

    after = cycle(log)
    rows = {r.request_id: r for r in after.collect()}
    assert rows["done"].run_id == "run-0" and rows["done"].rating == "yes"
    # The old request is outside the sample's days but got recent feedback.
    assert rows["old"].run_id == "run-1" and rows["old"].rating == "no"
    states = [rows[f"r{i}"].run_id for i in range(40)]
    assert states.count("run-1") == 10 and states.count(K.TO_PROCESS) == 30
    # What was over the cap waits, and comes up in the next cycles.
    again = cycle(after)
    assert sum(r.run_id == K.TO_PROCESS for r in again.collect()) == 20
