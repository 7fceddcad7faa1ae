"""Reply trees as formatted conversations, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.llm.ordering import dense, in_order
from evalloom.session import stage

# The template: `<turn ROLE>`, a line end, the text, `</turn>` on a line of its own.
OPEN, ROLE_END, CLOSE = "<turn ", ">\n", "\n</turn>\n"
# A mark inside a text gets a backslash behind its `<`, one more than it has already; roles are written as in URLs.
MARK = r"<(\\*/?turn)"
MARKED = r"<\\(\\*/?turn)"
IN_ROLES = {"%": "%25", "<": "%3C", ">": "%3E", "\n": "%0A"}
MOST_DOUBLINGS = 62


def escape(text: Column) -> Column:
    return F.regexp_replace(text, MARK, r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, MARKED, r"<$1")


def _escape_role(role: Column) -> Column:
    for plain, written in IN_ROLES.items():
        role = F.replace(role, F.lit(plain), F.lit(written))
    return role


def _read_role(role: Column) -> Column:
    for plain, written in reversed(IN_ROLES.items()):
        role = F.replace(role, F.lit(written), F.lit(plain))
    return role


def chain(turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of turns as messages, each the reply to the one before: a tree with one branch per conversation.

    Turns of one number follow each other by role and a digest of the text, null numbers come first, and a null conversation is one
    conversation. Repeated rows are turns of their own.
    """
    rows = turns.select(
        F.col(conversation).alias("tree"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = dense(in_order(rows.withColumn("digest", F.xxhash64("text")), "tree", "turn", "role", "digest"), name="message")
    firsts = rows.groupBy("tree").agg(F.min("message").alias("first")).withColumnRenamed("tree", "__tree")
    return rows.join(firsts, F.col("tree").eqNullSafe(F.col("__tree"))).select(
        "tree", "message", F.when(F.col("message") > F.col("first"), F.col("message") - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text",
    )


def _nodes(messages: DataFrame) -> DataFrame:
    """`row, up, tree, score`: one row per message of a tree, `up` the row it replies to."""
    alone = F.when(F.col("message").isNull(), F.col("row"))
    heads = messages.groupBy("tree", "message", alone).agg(F.min(F.struct("row", "parent", "score")).alias("m"))
    heads = heads.select("tree", "message", "m.*")
    above = heads.filter("message is not null").select(
        F.col("tree").alias("t"), F.col("message").alias("m"), F.col("row").alias("up")
    )
    linked = heads.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("m")), "left")
    return linked.select("row", "up", "tree", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Per node its depth and the sum of scores up to its root; and the jumps of 1, 2, 4, ... replies upwards.

    Each round joins the nodes that have not reached their root with all nodes: what a node knows about the stretch
    above it is extended by what the end of that stretch knows. The rounds are the logarithm of the deepest reply.
    """
    done, jumps = [], []
    active = nodes.select("row", "up", F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    while True:
        state = stage(active, "climb")
        done.append(state.filter("up is null"))
        active = state.filter("up is not null")
        if not active.limit(1).count():
            return reduce(DataFrame.union, done), jumps
        if len(jumps) == MOST_DOUBLINGS:
            raise ValueError("some messages reply to each other in a circle")
        jumps.append(active.select("row", "up"))
        above = reduce(DataFrame.union, [*done, active]).select(
            F.col("row").alias("end"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("rest")
        )
        active = active.join(above, F.col("up") == F.col("end")).select(
            "row", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("rest")).alias("total")
        )


def branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """`branch, tree, rank, place, row`: the messages on the way from the root to each chosen leaf.

    Leaves of a tree are ranked by the mean score on their way, the best first, then the leaf of the smaller row;
    the first `keep` are chosen, all without it. The ways are enumerated by self-joins that double in length.
    """
    nodes = stage(_nodes(messages), "nodes")
    state, jumps = _climb(nodes)
    parents = nodes.filter("up is not null").select(F.col("up").alias("row")).distinct()
    leaves = state.join(parents, "row", "left_anti").join(nodes.select("row", "tree"), "row")
    leaves = leaves.withColumn("worse", -F.col("total") / F.col("depth"))
    leaves = dense(in_order(leaves, "tree", "worse", "row"))
    best = leaves.groupBy("tree").agg(F.min("position").alias("best")).withColumnRenamed("tree", "__tree")
    ranked = leaves.join(best, F.col("tree").eqNullSafe(F.col("__tree"))).withColumn("rank", F.col("position") - F.col("best") + 1)
    if keep is not None:
        ranked = ranked.filter(F.col("rank") <= keep)
    chosen = stage(ranked.select(F.col("row").alias("branch"), "tree", "rank", "depth"), "branches")
    ways = [chosen.select("branch", "tree", "rank", "depth", F.col("branch").alias("row"), F.lit(0).cast("long").alias("back"))]
    for k, jump in enumerate(jumps):
        longer = reduce(DataFrame.union, ways).filter(F.col("depth") > (1 << k))
        further = longer.join(jump, "row").select("branch", "tree", "rank", "depth", F.col("up").alias("row"), (F.col("back") + (1 << k)).alias("back"))
        ways.append(stage(further, "ways"))
    return reduce(DataFrame.union, ways).select("branch", "tree", "rank", (F.col("depth") - 1 - F.col("back")).alias("place"), "row")


def format_trees(
    messages: DataFrame, *, keep: int | None = None, tree: str = "tree", message: str = "message", parent: str = "parent",
    score: str = "score", role: str = "role", text: str = "text", learn: str = "assistant",
) -> DataFrame:
    """`tree, branch, rank, n_turns, formatted, loss_spans`: one conversation per chosen way through a tree of replies.

    A turn is written `<turn ROLE>`, line end, text, line end, `</turn>`, line end. `loss_spans` holds, in order, the
    place of each text of the role `learn` in `formatted`: `start` and `length` in characters (code points),
    `byte_start` and `byte_length` in UTF-8. `read_turns` and `read_loss` give back roles and texts exactly.

    Nulls: a null role or text is empty, a null score 0; a null tree is a tree of its own; a null parent, or one that
    is not in the tree, makes a root; a null message cannot be replied to. Of rows with one message of one tree the
    first stored is taken. Messages that reply to each other in a
    circle have no root: an error is raised after 62 rounds. Ties of score go by row. Empty tables give no rows.
    Other columns are left out, so their names cannot clash. A conversation must fit into one row (2 GB).
    """
    rows = stage(messages.select(
        F.monotonically_increasing_id().alias("row"), F.col(tree).alias("tree"), F.col(message).alias("message"),
        F.col(parent).alias("parent"), F.col(score).alias("score"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ), "messages")
    ways = branches(rows.select("row", "tree", "message", "parent", "score"), keep)
    head = F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit(ROLE_END))
    pieces = ways.join(rows.select("row", "role", head.alias("head"), escape(F.col("text")).alias("body")), "row")
    ahead = W.partitionBy("branch").orderBy("place").rowsBetween(W.unboundedPreceding, -1)

    def before(size) -> Column:
        return F.coalesce(F.sum(size("head") + size("body") + len(CLOSE)).over(ahead), F.lit(0)) + size("head")

    span = F.struct(
        before(F.length).alias("start"), F.length("body").cast("long").alias("length"),
        before(F.octet_length).alias("byte_start"), F.octet_length("body").cast("long").alias("byte_length"),
    )
    turn = F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("written"), F.when(F.col("role") == learn, span).alias("span"))
    gathered = pieces.select("branch", "tree", "rank", turn.alias("turn")).groupBy("branch").agg(
        F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.array_sort(F.collect_list("turn")).alias("turns")
    )
    return gathered.select(
        "tree", "branch", "rank", F.size("turns").cast("long").alias("n_turns"), F.array_join("turns.written", "").alias("formatted"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of `role, text`."""
    pieces = F.split(formatted, CLOSE, -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def read(piece: Column) -> Column:
        end = F.locate(">", piece)
        return F.struct(
            _read_role(F.substring(piece, F.lit(len(OPEN) + 1), end - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(piece, end + len(ROLE_END), F.length(piece))).alias("text"),
        )

    return F.transform(turns, read)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, one after the other."""
    raw = formatted.cast("binary")
    texts = F.transform(spans, lambda s: unescape(F.decode(F.substring(raw, (s.byte_start + 1).cast("int"), s.byte_length.cast("int")), "UTF-8")))
    return F.array_join(texts, "")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from `format_trees`: counts and digests per conversation."""
    said = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    read = formatted.select(
        "tree", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
