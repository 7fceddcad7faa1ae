"""Repair of the order of roles in conversations by weighted interval parsing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from evalloom.llm.common import fixed
from evalloom.llm.ordering import in_order
from evalloom.session import stage

# States of the text read so far: nothing kept, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FINAL = (NOTHING, ASSISTANT)
# A turn of the role follows these states: `(s?(ua)+)?`.
FOLLOWS = {"s": (SYSTEM, (NOTHING,)), "u": (USER, (NOTHING, SYSTEM, ASSISTANT)), "a": (ASSISTANT, (USER,))}
NAMES = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
FAULTS = "blank", "duplicate", "truncated"
WIDTH = 16  # rows of a chart, and charts of a chart of charts
BLANK = r"\A[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

Cell = dict[tuple[int, int], tuple[int, str]]


def _best(cell: Cell, rule: tuple[int, int], value: tuple[int, str]) -> None:
    if rule not in cell or value < cell[rule]:
        cell[rule] = value


def _binary(left: Cell, right: Cell, into: Cell) -> None:
    """N(p, q) -> N(p, r) N(r, q): costs add up and audits follow each other."""
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (found := right.get((r, q))) is not None:
                _best(into, (p, q), (cost + found[0], audit + found[1]))


@lru_cache(maxsize=1)
def _insertions() -> Cell:
    """The cheapest insertions that lead from one state to another, none included."""
    single: Cell = {(p, p): (0, "") for p in STATES}
    for initial in "ua":
        to, after = FOLLOWS[initial]
        for p in after:
            _best(single, (p, to), (INSERT, "I"))
    closed = single
    while True:
        more = dict(closed)
        _binary(closed, single, more)
        if more == closed:
            return closed
        closed = more


@lru_cache(maxsize=64)
def _terminal(initial: str, fault: str) -> Cell:
    """N(p, q) -> row, with any insertions before and after it."""
    row: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        for role, (to, after) in FOLLOWS.items():
            for p in after:
                if role == initial:
                    _best(row, (p, to), (more, "K"))
                if role != "s":
                    _best(row, (p, to), (more + REROLE, "R"))
    before: Cell = {}
    closed: Cell = {}
    _binary(_insertions(), row, before)
    _binary(before, _insertions(), closed)
    return closed


def _chart(items: list[Cell]) -> Cell:
    """The cell of the whole span, from the cells of all shorter spans by rising length."""
    n = len(items)
    cells = {(i, i + 1): item for i, item in enumerate(items)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = {}
            for k in range(i + 1, i + length):
                _binary(cells[i, k], cells[k, i + length], cell)
            cells[i, i + length] = cell
    return cells[0, n]


@lru_cache(maxsize=1 << 14)
def _rows_chart(rows: tuple[tuple[str, str], ...]) -> Cell:
    return _chart([_terminal(*row) for row in rows])


def _joined(cells: list[Cell]) -> Cell:
    """One cell for a sequence of spans: charts of at most WIDTH spans, then charts of those.

    Equal costs never compare an audit with its own beginning (the rest would cost something), so the least audit of
    a span stays the least in every longer one, and it does not matter where a sequence is cut.
    """
    while len(cells) > 1:
        cells = [_chart(cells[i : i + WIDTH]) for i in range(0, len(cells), WIDTH)]
    return cells[0]


def parse(rows: list[tuple[str, str]]) -> Cell:
    """The cheapest edits of (role initial, fault) rows for each pair of states before and after them."""
    return _joined([_rows_chart(tuple(rows[i : i + WIDTH])) for i in range(0, len(rows), WIDTH)])


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[NOTHING, q] for q in FINAL if (NOTHING, q) in cell)


def steps(audit: str, initials: str, state: int = NOTHING) -> Iterator[tuple[str, list[int]]]:
    """Per row its edits, from the insertions before it to itself, and the states of the turns they leave.

    Insertions after the last row belong to it.
    """
    edits, states, row = "", [], 0
    cut = len(audit.rstrip("I"))
    for at, edit in enumerate(audit):
        if edit == "K":
            state = FOLLOWS[initials[row]][0]
        elif edit != "D":
            state = ASSISTANT if state == USER else USER
        if edit != "D":
            states.append(state)
        edits += edit
        if edit != "I":
            row += 1
        if edit != "I" and at + 1 < cut or at + 1 == len(audit):
            yield edits, states
            edits, states = "", []


def damage(turns: DataFrame) -> DataFrame:
    """Turns damaged by the checksum of `conv_id:turn`: dropped, emptied, cut, repeated or given to the user.

    Returns `conv_id, turn, role, text`, nulls of role and text as one space.
    """
    space = F.lit(" ")
    code = F.crc32(F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space)
    ).cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    rows = turns.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), code.alias("code"),
    )
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("code <> 0").withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def _flagged(ordered: DataFrame) -> DataFrame:
    """`at, conv_id, turn, initial, fault` in order: the first fault of each row. Texts stay where they are."""
    rows = ordered.select(
        "at", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), F.col("text").rlike(BLANK).alias("blank"),
        (~F.col("text").rlike(ENDED)).alias("truncated"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256).alias("said"),
    )
    first = rows.groupBy("conv_id", "said").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times"))
    first = first.filter("times > 1").select(F.col("conv_id").alias("c"), F.col("said").alias("s"), "first")
    seen = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("at") > F.col("first"), "duplicate").when(F.col("truncated"), "truncated")
    return seen.select("at", "conv_id", "turn", "initial", F.coalesce(fault, F.lit("")).alias("fault"))


SPANS = (
    "conv_id {key}, at long, initials array<string>, cell array<struct<p: int, q: int, cost: long, audit: string>>, "
    "turns long, first_turn long, last_turn long, illegal long, blank long, duplicate long, truncated long"
)
SOLVED = (
    "conv_id {key}, at long, initials string, state int, audit string, opens boolean, cost long, whole string, gaps long, illegal long, "
    "blank long, duplicate long, truncated long"
)
LEGAL = ("su", "ua", "au")


def _spans(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """One row per conversation and stretch of consecutive rows, at most `most` rows in it."""
    out: list[tuple] = []
    held: list[tuple] = []

    def close() -> None:
        initials = [x[3] for x in held]
        faults = [x[4] for x in held]
        known = [x[2] for x in held if x[2] is not None]
        cell = parse([(i if i in FOLLOWS else "", f) for i, f in zip(initials, faults, strict=True)])
        out.append((
            held[0][1], held[0][0], initials, [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cell.items()],
            len(set(known)), known[0] if known else None, known[-1] if known else None,
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)), *(faults.count(f) for f in FAULTS),
        ))
        held.clear()

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        out.clear()
        return made

    for found in batches:
        for row in zip(*(found.column(x).to_pylist() for x in ("at", "conv_id", "turn", "initial", "fault")), strict=True):
            if held and (row[1] != held[0][1] or row[0] != held[-1][0] + 1 or len(held) == most):
                close()
                if len(out) >= 1024:
                    yield batch()
            held.append(row)
    if held:
        close()
    if out:
        yield batch()


def _solve(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The stretches of each conversation, in order, with their part of its cheapest audit."""
    names = (
        "conv_id", "at", "initials", "cell", "turns", "first_turn", "last_turn", "illegal", "blank", "duplicate", "truncated"
    )
    out: list[tuple] = []
    held: list[tuple] = []

    def close() -> None:
        cell = _joined([{(x["p"], x["q"]): (x["cost"], x["audit"]) for x in s[3]} for s in held])
        cost, audit = cheapest(cell)
        known = [s for s in held if s[4]]
        distinct = sum(s[4] for s in known) - sum(a[6] == b[5] for a, b in zip(known, known[1:], strict=False))
        gaps = known[-1][6] - known[0][5] + 1 - distinct if known else 0
        edges = sum(a[2][-1] + b[2][0] not in LEGAL for a, b in zip(held, held[1:], strict=False))
        sums = [gaps, sum(s[7] for s in held) + edges, *(sum(s[i] for s in held) for i in (8, 9, 10))]
        at, state = 0, NOTHING
        for k, s in enumerate(held):
            end, rows = at, 0
            while rows < len(s[2]):  # a stretch ends with its last row, the last one with the audit
                rows += audit[end] != "I"
                end += 1
            end = len(audit) if k == len(held) - 1 else end
            part, before = audit[at:end], state
            # What is neither one of the three nor a single letter is never kept.
            letters = "".join(x if len(x) == 1 else " " for x in s[2])
            for _, states in steps(part, letters, state):
                state = states[-1] if states else state
            out.append((s[0], s[1], letters, before, part, k == 0, cost, audit if k == 0 else None, *sums))
            at = end
        held.clear()

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        out.clear()
        return made

    for found in batches:
        for row in zip(*(found.column(x).to_pylist() for x in names), strict=True):
            if held and row[0] != held[0][0]:
                close()
                if len(out) >= 1024:
                    yield batch()
            held.append(row)
    if held:
        close()
    if out:
        yield batch()


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row what it leaves: the roles of inserted turns, null for itself kept as it is."""
    for found in batches:
        at, edits, roles = [], [], []
        for first, initials, state, audit in zip(*(found.column(x).to_pylist() for x in ("at", "initials", "state", "audit")), strict=True):
            for k, (done, states) in enumerate(steps(audit, initials, state)):
                left = iter(states)
                at.append(first + k)
                edits.append(done)
                roles.append([{"own": e != "I", "role": NAMES[s] if e != "K" else None} for e in done if e != "D" for s in [next(left)]])
        kind = pa.list_(pa.struct([("own", pa.bool_()), ("role", pa.string())]))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(edits, pa.string()), pa.array(roles, kind)], names=["at", "edits", "left"])


class Repair:
    """The cheapest repair of every conversation, so that its role initials are `(s?(ua)+)?`.

    Rows are taken by turn (nulls first, then by role and a digest of the text). A row is blank (no character beyond white space), a
    duplicate (role and text seen earlier in the conversation) or truncated (not ended by `.`, `!` or `?`), by its
    first fault. Keeping a row is free, a new role (user or assistant) costs 1, deleting 2, inserting an empty turn 5;
    blank rows and duplicates must go, and a truncated row that stays costs 5 more. Of equal costs the audit (the
    initials of the edits) that is least in ASCII order is taken.

    The grammar is in Chomsky normal form: N(p, q) stands for rows that lead from state p to state q of the order of
    roles; N(p, q) -> N(p, r) N(r, q), or a row between any insertions. A task fills the charts of the rows it has, by
    rising length of span; what a conversation has in several tasks meets as one cell per stretch of at most `most`
    rows. A sort deals the rows, so a very long conversation is cut over many tasks; only its cells and its audit come
    together in one, and the whole of its text nowhere but in `digests`, which streams it through one task (a digest
    of a text has an order).

    Nulls: a null conversation is one conversation; null turns count as no number; a null role or text is one space.
    Repeated rows are duplicates. Empty tables give no rows. Other columns are left out, so their names cannot clash.
    """

    def __init__(self, turns: DataFrame, most: int = 4096) -> None:
        space = F.lit(" ")
        rows = turns.select(
            "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
            F.coalesce(F.col("text").cast("string"), space).alias("text"),
        )
        # A digest in place of the text, so that the keys the sort samples are short.
        rows = in_order(rows.withColumn("digest", F.xxhash64("text")), "conv_id", "turn", "role", "digest")
        self.rows = rows.drop("digest")
        spans, solved = (x.format(key=rows.schema["conv_id"].dataType.simpleString()) for x in (SPANS, SOLVED))
        schemas = [_arrow(x) for x in (spans, solved)]
        found = _flagged(self.rows).repartitionByRange("at").sortWithinPartitions("at").mapInArrow(lambda b: _spans(b, schemas[0], most), spans)
        # Sorted by conversation, its stretches follow each other in one task, which reads them as a stream.
        dealt = found.repartition("conv_id").sortWithinPartitions("conv_id", "at")
        self.solved = stage(dealt.mapInArrow(lambda b: _solve(b, schemas[1]), solved), "solved")

    def audits(self) -> DataFrame:
        """`conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`, one row per conversation with rows."""
        return self.solved.filter("opens").select(
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.col("whole").alias("audit")
        )

    def repaired(self) -> DataFrame:
        """`conv_id, at, part, turn, role, text`: the turns that are left, in the order of `at` and `part`."""
        edits = self.solved.mapInArrow(_edits, "at long, edits string, left array<struct<own: boolean, role: string>>")
        return self.rows.join(edits, "at").select("*", F.posexplode("left").alias("part", "one")).select(
            "conv_id", "at", "part", F.when(F.col("one.own"), F.col("turn")).alias("turn"),
            F.coalesce("one.role", "role").alias("role"), F.when(F.col("one.own"), F.col("text")).otherwise("").alias("text"),
        )

    def digests(self) -> DataFrame:
        """`conv_id, repaired_sha256`: of the lines `role:text`, for conversations of which something is left."""
        left = self.repaired()
        kind = left.schema["conv_id"].dataType.simpleString()
        out = _arrow(f"conv_id {kind}, repaired_sha256 string")

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, state = None, None
            for batch in batches:
                done = []
                lines = zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text")), strict=True)
                for conversation, role, text in lines:
                    line = f"{role}:{text}".encode()
                    if state is None or conversation != key:
                        if state is not None:
                            done.append((key, state.hexdigest()))
                        key, state = conversation, hashlib.sha256(line)
                    else:
                        state.update(b"\n" + line)
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True), out, strict=True)], schema=out)
            if state is not None:
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((key, state.hexdigest()), out, strict=True)], schema=out)

        dealt = left.repartition("conv_id").sortWithinPartitions("conv_id", "at", "part").select("conv_id", "role", "text")
        return dealt.mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string")


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def damage_and_repair(turns: DataFrame) -> DataFrame:
    """Every conversation of `turns` with the faults and the repair of its damaged rows.

    Conversations of which the damage leaves no row have zeros, an empty audit and the digest of an empty text.
    """
    turns = fixed(turns.select("conv_id", "turn", "role", "text"))
    fix = Repair(damage(turns))
    everyone = turns.select(F.col("conv_id").alias("__conv")).distinct()
    counts = "gaps", "blank", "duplicate", "truncated", "illegal", "cost"
    return (
        everyone.join(fix.audits(), F.col("__conv").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
        .join(fix.digests(), F.col("__conv").eqNullSafe(F.col("conv_id")), "left")
        .select(
            F.col("__conv").alias("conv_id"), *(F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )

