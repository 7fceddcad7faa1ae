"""Packed matrices of token numbers: best-fit decreasing with a segment tree over free capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalloom.llm.common import numbered
from evalloom.llm.tokens import END, Tokens, pieces, texts_of

WIDTH = 1024
POOL = 2_000_000
SCHEMA = (
    "block long, sequence int, n_tokens int, ids binary, ids_crc32 long, cu_seqlens array<int>, "
    "position_resets array<int>, doc_ids array<long>, doc_rows array<long>, doc_starts array<long>"
)


class Capacities:
    """A segment tree over 0..top that counts open bins by their free capacity."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(top + 1)]

    def add(self, capacity: int, bin_: int) -> None:
        self.bins[capacity].append(bin_)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a bin of the smallest capacity that is at least `least`: its capacity and number."""
        node = self.size + least
        count = self.count
        if not count[node]:
            # Up to the first right sibling with a bin, then down its left side.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.bins[capacity].pop()


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """The bins, as numbers of items: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    free = Capacities(width)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = free.take(lengths[item])
        if found is None:
            found = width, len(bins)
            bins.append([])
        room, bin_ = found
        bins[bin_].append(item)
        if room > lengths[item]:
            free.add(room - lengths[item], bin_)
    return bins


def token_blocks(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", width: int = WIDTH, pool: int = POOL,
    tokenizer: str | None = None, kind: str = "<u2",
) -> DataFrame:
    """One row per packed sequence, in one pass without a shuffle.

    `ids` is a row of the matrix: `width` numbers of type `kind`, padded with the end mark beyond `n_tokens`.
    `cu_seqlens` holds 0 and the end of each segment, `position_resets` where positions start again from 0 (the
    start of each segment), `doc_ids`, `doc_rows` and `doc_starts` what each segment is: its document, the number
    of that row (repeated or null keys stay apart) and its first token there. A document longer than `width` is
    split into full segments and a rest; no token is lost. Documents are packed in pools of about `pool` tokens
    as they are read, so memory is bounded and `block`, the first row of the pool, repeats on a second run.

    Nulls: a null or empty text is the end mark alone. Repeated documents are packed each. An empty table gives
    no rows. Other columns are left out. A number too large for `kind` raises.
    """
    rows = numbered(docs, F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    most = np.iinfo(np.dtype(kind)).max

    def flush(held: list[tuple[int, int | None, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        bins = best_fit([len(x[3]) for x in held], width)
        for a in range(0, len(bins), 256):
            out: list[list] = [[] for _ in names]
            for number, members in enumerate(bins[a : a + 256], a):
                parts = [held[i] for i in members]
                ids = np.concatenate([x[3] for x in parts])
                ends = np.cumsum([0, *(len(x[3]) for x in parts)]).tolist()
                line = np.full(width, END, kind)
                line[: len(ids)] = ids
                row = (
                    held[0][0], number, len(ids), line.tobytes(), zlib.crc32(ids.astype("<u4").tobytes()), ends, ends[:-1],
                    [x[1] for x in parts], [x[0] for x in parts], [x[2] for x in parts],
                )
                for x, y in zip(out, row, strict=True):
                    x.append(y)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int32()),
                     pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, size = Tokens(tokenizer), [], 0
        for batch in batches:
            for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(),
                                         texts_of(batch.column("text")), strict=True):
                ids = tokens.ids(text)
                if ids.max() > most:
                    raise ValueError(f"token number {ids.max()} does not fit {kind}")
                small = ids.astype(kind)
                for start, length in pieces(len(ids), width):
                    held.append((row, doc_id, start, small[start : start + length]))
                    size += length
                if size >= pool:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return rows.mapInArrow(run, SCHEMA)


def write_blocks(docs: DataFrame, path: str, **options) -> None:
    """Store the matrices as Parquet files in a folder that all executors share."""
    token_blocks(docs, **options).write.mode("overwrite").parquet(path)
