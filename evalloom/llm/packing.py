"""Packing token sequences as a cutting-stock problem, solved by column generation over a histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.llm.common import numbered, settled
from evalloom.llm.tokens import Tokens, pieces, texts_of
from evalloom.session import stage

WIDTH = 1024
QUANTUM = 4
GAP = 1e-3
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, units int, chunk long, place long"
)


def best_pattern(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of lengths 1..capacity of most value that fits. value[l] is that of length l."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gain = best[room - 1 :: -1] + value[1 : room + 1]  # length l leaves room - l
        length = int(np.argmax(gain))
        if gain[length] > best[room - 1]:
            best[room], taken[room] = gain[length], length + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(capacity + 1, np.int64), capacity
    while room:
        if taken[room]:
            pattern[taken[room]] += 1
            room -= taken[room]
        else:
            room -= 1
    return float(best[capacity]), pattern


def relaxed(demand: np.ndarray, capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is cut, whole or not, so that the demand of each length is met with the fewest
    sequences: the linear program over all patterns, to within `gap` of its lower bound.

    Revised simplex (plain sums: threads of a matrix library do not help at this size). It starts from patterns of one or two lengths; the knapsack over the dual prices finds the column of
    least reduced cost. Its value bounds the optimum from below, and so do the tokens over the width.
    """
    lengths = np.flatnonzero(demand)
    m = len(lengths)
    if not m:
        return []
    # Of two lengths that fill a sequence together, the rarer one starts in pairs with the other.
    columns, need = [], demand[lengths].astype(float)
    at = {int(length): i for i, length in enumerate(lengths)}
    inverse = np.zeros((m, m))
    for i, length in enumerate(lengths.tolist()):
        column = np.zeros(capacity + 1, np.int64)
        rest = capacity - length
        if rest in at and (demand[length], length) < (demand[rest], rest):
            column[[length, rest]] = 1
            inverse[i, i], inverse[at[rest], i] = 1.0, -1.0 / (capacity // rest)
        else:
            column[length] = capacity // length
            inverse[i, i] = 1.0 / (capacity // length)
        columns.append(column)
    amount = (inverse * need).sum(axis=1)
    cost = np.ones(m)
    material = need @ lengths / capacity
    for _ in range(50 * m + 200):
        price = (cost[:, None] * inverse).sum(axis=0)
        worst = int(np.argmin(price))
        if price[worst] < -1e-9:  # more of this length than asked for does no harm
            entering, entering_cost = np.zeros(m), 0.0
            entering[worst] = -1.0
            column = np.zeros(capacity + 1, np.int64)
        else:
            value = np.zeros(capacity + 1)
            value[lengths] = np.maximum(price, 0.0)
            worth, column = best_pattern(value, capacity)
            bound = max(material, need @ price / worth)
            if worth <= 1.0 + 1e-9 or cost @ amount <= bound * (1.0 + gap):
                break
            entering, entering_cost = column[lengths].astype(float), 1.0
        used = np.flatnonzero(entering)
        step = (inverse[:, used] * entering[used]).sum(axis=1)
        rising = np.flatnonzero(step > 1e-9)
        if not len(rising):
            break
        ratio = amount[rising] / step[rising]
        out = int(rising[np.argmin(ratio)])
        by = amount[out] / step[out]
        amount -= by * step
        amount[out] = by
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        columns[out], cost[out] = column, entering_cost
    return [(c, float(x)) for c, x, price in zip(columns, amount, cost, strict=True) if price and x > 1e-9]


def whole(demand: np.ndarray, capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, int]]:
    """Patterns cut a whole number of times that meet the demand exactly.

    The relaxed numbers are rounded down; what is left, a few sequences per pattern, goes first-fit decreasing.
    """
    left = demand.copy()
    full = capacity
    found: list[tuple[np.ndarray, int]] = []
    if left[full]:
        column = np.zeros(capacity + 1, np.int64)
        column[full] = 1
        found.append((column, int(left[full])))
        left[full] = 0
    for column, times in sorted(relaxed(left, capacity, gap), key=lambda x: (-x[1], x[0].tolist())):
        used = np.flatnonzero(column)
        times = min(int(times + 1e-9), *(int(left[x] // column[x]) for x in used))
        if times:
            found.append((column, times))
            left = left - times * column
    while left.any():
        column, room = np.zeros(capacity + 1, np.int64), capacity
        for length in np.flatnonzero(left)[::-1]:
            n = int(min(left[length], room // length))
            column[length] = n
            room -= n * length
        used = np.flatnonzero(column)
        times = int((left[used] // column[used]).min())
        found.append((column, times))
        left = left - times * column
    return found


def slots(patterns: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """Where the ranks of a length go: from rank `first` on, `each` of them to a sequence from `sequence` on."""
    rows, taken, sequence = [], {}, 0
    for column, times in patterns:
        order = 0
        for units in np.flatnonzero(column)[::-1]:
            first = taken.get(int(units), 0)
            each = int(column[units])
            rows.append((int(units), first, each, sequence, order))
            taken[int(units)] = first + each * times
            order += each
        sequence += times
    rows.sort()
    names = ("units", "first", "each", "sequence", "order")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def cut(docs: DataFrame, *, text: str, key: str, width: int, quantum: int, tokenizer: str | None) -> DataFrame:
    """The pieces of all documents, each with its rank among pieces of as many units in its batch of rows."""
    rows = numbered(docs, F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer)
        names = [x.split()[0] for x in PIECES.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int64()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            seen: dict[int, int] = {}
            chunk = batch.column("row")[0].as_py() if batch.num_rows else 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                ids = tokens.ids(text)
                raw = memoryview(ids.tobytes())
                for start, length in pieces(len(ids), width):
                    units = -(-length // quantum)
                    place = seen.get(units, 0)
                    seen[units] = place + 1
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    for x, y in zip(out, (doc_id, start, length, crc, len(ids), units, chunk, place), strict=True):
                        x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    return rows.mapInArrow(settled(run), PIECES)


def pack(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", width: int = WIDTH, quantum: int = QUANTUM,
    gap: float = GAP, tokenizer: str | None = None,
) -> DataFrame:
    """Every document's tokens in sequences of at most `width`, one row per piece.

    Documents are cut into full pieces and a rest. The histogram of lengths, counted in units of `quantum` tokens,
    is all that the driver sees (`width / quantum` numbers); it yields patterns and how often to cut each. The n-th
    piece of a length, ranked over all documents, finds its sequence by arithmetic on a table of the patterns.
    Pieces in a sequence follow each other without gap.

    Nulls: a null or empty text is the end mark alone; a null key stays null. Repeated documents are packed each.
    An empty table gives no rows. Other columns are left out.
    """
    if width % quantum:
        raise ValueError("width must be a multiple of quantum")
    cuts = stage(cut(docs, text=text, key=key, width=width, quantum=quantum, tokenizer=tokenizer), "pieces")
    held = cuts.groupBy("units", "chunk").agg(F.count(F.lit(1)).alias("n"))
    demand = np.zeros(width // quantum + 1, np.int64)
    for row in held.groupBy("units").agg(F.sum("n").alias("n")).collect():
        demand[row.units] = row.n
    table = slots(whole(demand, width // quantum, gap))
    span = int(demand.max()) + 1
    starts = table["units"] * span + table["first"]
    earlier = W.partitionBy("units").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = held.select("units", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cuts.join(offsets, ["units", "chunk"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "units", (F.col("place") + F.col("before")).alias("rank")
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, rank = (batch.column(x).to_numpy().astype(np.int64) for x in ("units", "rank"))
            at = np.searchsorted(starts, units * span + rank, side="right") - 1
            inside = rank - table["first"][at]
            sequence = table["sequence"][at] + inside // table["each"][at]
            order = table["order"][at] + inside % table["each"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")),
                 pa.array(sequence), pa.array(order)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "order"],
            )

    placed = ranked.mapInArrow(
        assign, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, order long"
    )
    before = W.partitionBy("sequence_id").orderBy("order").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("order")
