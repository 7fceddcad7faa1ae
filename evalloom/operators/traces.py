"""Conversations, traces and request life-cycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom import schemas
from evalloom.functions.messages import tool_turns
from evalloom.operators.joins import mark
from evalloom.operators.metrics import beside
from evalloom.operators.ranks import count_values, percentiles_of
from evalloom.operators.sampling import segmented_lag


def messages_from_turns(
    turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    part_turns: int = 1000,
) -> DataFrame:
    """The messages of each conversation in order, in numbered parts of `part_turns` turns.

    Parts keep a row bounded; a part is not a conversation. What depends on the first or last message of a
    conversation, or counts over it, is done on its turns: `last_query`, `history`, `with_system`,
    `without_system`, `answered`, `tool_depth`.
    """
    part = F.floor(F.col(turn) / part_turns)
    gathered = turns.groupBy(key, part.alias("part")).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")))
        ).alias("turns")
    )
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return gathered.select(key, "part", messages.alias("messages"))


def last_query(turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """The content of each conversation's last turn, folded map-side however long it is."""
    return turns.groupBy(key).agg(F.max_by(text, turn).alias("user_query"))


def history(turns: DataFrame, *, key: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Every turn but the last of each conversation."""
    last = turns.groupBy(key).agg(F.max(turn).alias("__last"))
    return turns.join(last, key).filter(F.col(turn) < F.col("__last")).drop("__last")


def _first(turns: DataFrame, key: str, turn: str, role: str) -> DataFrame:
    return turns.groupBy(key).agg(F.min(turn).alias("__first"), F.min_by(role, turn).alias("__opens"))


def with_system(
    turns: DataFrame, prompt: str, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The turns, with a system turn before the first one of each conversation that does not open with one."""
    lacking = _first(turns, key, turn, role).filter(~F.col("__opens").eqNullSafe("system"))
    added = lacking.select(
        key, (F.col("__first") - 1).cast(turns.schema[turn].dataType).alias(turn), F.lit("system").alias(role),
        F.lit(prompt).alias(text),
    )
    return turns.select(key, turn, role, text).unionByName(added)


def without_system(turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """The turns without the first of a conversation if it is a system turn."""
    opens = _first(turns, key, turn, role).filter(F.col("__opens") == "system").select(key, F.col("__first").alias(turn))
    return turns.join(opens, [key, turn], "left_anti")


def answered(
    turns: DataFrame, more: DataFrame, *, key: str = "conv_id", turn: str = "turn", place: str = "place"
) -> DataFrame:
    """The turns, followed in each conversation by its rows of `more` in order of `place` (1, 2, ...)."""
    last = turns.groupBy(key).agg(F.max(turn).alias("__last"))
    added = more.join(last, key).withColumn(turn, (F.col("__last") + F.col(place)).cast(turns.schema[turn].dataType))
    return turns.unionByName(added.select(*turns.columns))


def with_prompt(
    turns: DataFrame, prompts: DataFrame, place: str = "user", *, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", prompt: str = "prompt",
) -> DataFrame:
    """The turns of each conversation with its prompt, from `prompts` (one row per key), put in its place.

    With `place="user"` the prompt takes the place of the last turn. With `place="system"` it becomes the first turn: in
    place of a system turn that opens the conversation, or before the first one. Conversations without a prompt stay.
    """
    if place not in ("user", "system"):
        raise ValueError(f"place must be 'user' or 'system', not {place!r}")
    end = F.max if place == "user" else F.min
    ends = turns.groupBy(key).agg(end(turn).alias("__end"), F.min_by(role, turn).alias("__opens"))
    asked = ends.join(prompts.select(key, F.col(prompt).alias("__prompt")), key)
    joined = turns.select(key, turn, role, text).join(asked, key, "left")
    replaces = F.lit(True) if place == "user" else F.coalesce(F.col("__opens") == "system", F.lit(False))
    here = F.coalesce((F.col(turn) == F.col("__end")) & replaces, F.lit(False))
    changed = joined.select(
        key, turn, F.when(here, F.lit(place)).otherwise(F.col(role)).alias(role), F.when(here, F.col("__prompt")).otherwise(F.col(text)).alias(text)
    )
    if place == "user":
        return changed
    added = asked.filter(~F.col("__opens").eqNullSafe("system")).select(
        key, (F.col("__end") - 1).cast(turns.schema[turn].dataType).alias(turn), F.lit(place).alias(role), F.col("__prompt").alias(text)
    )
    return changed.unionByName(added)


def tool_depth(
    turns: DataFrame, *, key: str = "conv_id", role: str = "role", limit: int = K.MAX_TOOL_ITERATIONS
) -> DataFrame:
    """Tool results per conversation, and whether they reach the ceiling on tool-call rounds."""
    depth = F.sum(F.when(F.col(role) == "tool", 1).otherwise(0)).cast("int")
    return turns.groupBy(key).agg(depth.alias("depth")).withColumn("at_limit", F.col("depth") >= limit)


_OPEN = "struct<span_no: int, parent: int, depth: int, until: bigint, used: bigint>"


def _sweep(parsed: Column) -> Column:
    """For each span, by number: the number of the innermost span around it, its depth, and the time of its children.

    Spans are taken by start, longer ones first. Those that end before the next one does are closed; the innermost that
    is still open is its parent. A span around a closed one's later parts would be around the newer one as well, so a
    closed span is never needed again, and the sweep is linear in the spans but for the copying of arrays.
    """
    numbered = F.transform(parsed, lambda s, i: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), i.cast("int").alias("span_no"), s["end"].alias("end")
    ))
    # Of one start, spans that never ended come last.
    ordered = F.array_sort(numbered, lambda a, b: F.coalesce(
        F.nullif(F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0), F.lit(0)),
        F.nullif(F.when(a["back"].isNull() & b["back"].isNotNull(), 1).when(a["back"].isNotNull() & b["back"].isNull(), -1)
                 .when(a["back"] < b["back"], -1).when(a["back"] > b["back"], 1).otherwise(0), F.lit(0)),
        a["span_no"] - b["span_no"],
    ))
    placed = F.filter(ordered, lambda s: s["start"].isNotNull())
    none = F.array().cast(f"array<{_OPEN}>")

    def step(held: Column, span: Column) -> Column:
        around = lambda s: s["until"] >= F.coalesce(span["end"], span["start"])
        kept = F.filter(held["open"], around)
        parent = F.try_element_at(kept, F.lit(-1))
        own = F.struct(
            span["span_no"].alias("span_no"), parent["span_no"].alias("parent"), (F.coalesce(parent["depth"], F.lit(-1)) + 1).alias("depth"),
            span["end"].alias("until"), F.lit(0).cast("bigint").alias("used"),
        ).cast(_OPEN)
        longer = F.transform(kept, lambda s, i: F.struct(
            s["span_no"].alias("span_no"), s["parent"].alias("parent"), s["depth"].alias("depth"), s["until"].alias("until"),
            F.when(i == F.size(kept) - 1, s["used"] + span["end"] - span["start"]).otherwise(s["used"]).alias("used"),
        ).cast(_OPEN))
        ended = span["end"].isNotNull()
        return F.struct(
            F.when(ended, F.concat(longer, F.array(own))).otherwise(held["open"]).alias("open"),
            F.concat(held["done"], F.when(ended, F.filter(held["open"], lambda s: ~around(s))).otherwise(F.array(own))).alias("done"),
        )

    swept = F.aggregate(placed, F.struct(none.alias("open"), none.alias("done")), step, lambda h: F.concat(h["done"], h["open"]))
    # Spans without a start lie nowhere: they have no parent and are nobody's.
    lost = F.transform(F.filter(ordered, lambda s: s["start"].isNull()), lambda s: F.struct(
        s["span_no"].alias("span_no"), F.lit(None).cast("int").alias("parent"), F.lit(0).alias("depth"),
        F.lit(None).cast("bigint").alias("until"), F.lit(0).cast("bigint").alias("used"),
    ).cast(_OPEN))
    return F.array_sort(F.concat(swept, lost))


def spans(df: DataFrame, trace: str = "trace", *keys: str) -> DataFrame:
    """One row per span of a JSON trace, in span order. A trace that is not JSON has no spans."""
    parsed = F.from_json(F.col(trace), schemas.SPANS)
    flat = df.select(*keys, F.posexplode(parsed).alias("span_no", "span"))
    return flat.select(*keys, "span_no", "span.*").withColumn("duration", F.col("end") - F.col("start"))


def span_tree(df: DataFrame, trace: str = "trace", *keys: str) -> DataFrame:
    """The rows of `spans`, each with its place in the tree of spans of its trace.

    `parent` is the number of the innermost span that lies around it in time (of spans of equal extent the earlier
    is around the later), null for the outermost, which have `depth` 0. `self_time` is what is left of the duration
    without the children, at least 0. A span that never ended is around nothing; one without a start has no place.
    """
    parsed = df.select(*keys, F.from_json(F.col(trace), schemas.SPANS).alias("spans")).filter("spans IS NOT NULL")
    swept = parsed.withColumn("tree", _sweep(F.col("spans")))
    flat = swept.select(*keys, F.posexplode(F.arrays_zip("spans", "tree")).alias("span_no", "s"))
    duration = F.col("s.spans.end") - F.col("s.spans.start")
    return flat.select(
        *keys, "span_no", "s.spans.*", duration.alias("duration"), F.col("s.tree.parent").alias("parent"),
        F.col("s.tree.depth").alias("depth"), F.greatest(duration - F.col("s.tree.used"), F.when(duration.isNotNull(), 0)).alias("self_time"),
    )


def span_latency(spans: DataFrame, *, exact: bool = False) -> DataFrame:
    """Count and latency per span type; spans that never ended count but have no latency.

    With `exact` the percentiles are exact, and count and mean follow from the counted durations: traces are parsed once.
    """
    wanted = {"p50_duration": 0.5, "p95_duration": 0.95}
    if not exact:
        sketches = [F.percentile_approx("duration", p, 10000).alias(n) for n, p in wanted.items()]
        return spans.groupBy("span_type").agg(F.count(F.lit(1)).alias("spans"), F.avg("duration").alias("avg_duration"), *sketches)
    counted = count_values(spans, ["span_type"], "duration")
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    sums = counted.groupBy(F.col("group")["span_type"].alias("span_type")).agg(
        F.sum("n").alias("spans"), (F.sum(F.col("value") * known) / F.sum(known)).alias("avg_duration")
    )
    return beside(sums, percentiles_of(counted, ["span_type"], wanted), ["span_type"])


def loop_depth(df: DataFrame, messages: str = "messages", limit: int = K.MAX_TOOL_ITERATIONS) -> DataFrame:
    """Tool results per request that holds its messages, and whether they reach the ceiling on tool-call rounds."""
    depth: Column = tool_turns(messages)
    return df.withColumn("depth", depth).withColumn("at_limit", F.col("depth") >= limit)


def turn_sequence(
    turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role"
) -> DataFrame:
    """Each turn with the role before it, whether a role repeats, and whether a tool result is misplaced.

    A tool result belongs after an assistant turn or after another tool result.
    """
    lagged = segmented_lag(turns, key, turn, [role])
    prev = F.col(f"prev_{role}")
    orphan = (F.col(role) == "tool") & ~F.coalesce(prev.isin("assistant", "tool"), F.lit(False))
    return lagged.withColumns(
        {
            "repeated": F.coalesce((prev == F.col(role)) & (F.col(role) != "tool"), F.lit(False)),
            "orphan_tool": orphan,
        }
    )


def advance_status(df: DataFrame, selected: DataFrame, key: str = "request_id") -> DataFrame:
    """Unprocessed rows become `to_process` if selected and `skipped` if not; all others stay as they are."""
    flagged = mark(df.withColumn("__chosen", F.lit(None).cast("string")), selected, "yes", key, "__chosen")
    fresh = F.when(F.col("__chosen").isNotNull(), F.lit(K.TO_PROCESS)).otherwise(F.lit(K.SKIPPED))
    return flagged.withColumn("run_id", F.coalesce("run_id", fresh)).drop("__chosen")
