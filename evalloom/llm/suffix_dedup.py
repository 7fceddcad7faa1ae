"""Removal of long byte strings that repeat across documents."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from evalloom.llm.anchors import GRAM, Anchors
from evalloom.llm.bwt import least_of_equal
from evalloom.llm.common import as_bytes, fixed, numbered, ranges, settle, settled

LENGTH = 50
ROWS = 16384  # of a chunk at most
# A chunk has a row for each bucket, so the rows are the square of the text over the product of these two.
CHUNK_BYTES = 8 << 20  # of a chunk of several rows at most
BUCKET_BYTES = 16 << 20  # of text for each bucket of anchors
LEAST_BUCKETS = 64  # where this leaves each at least a sixteenth of BUCKET_BYTES
SEEN_BYTES = 16 << 20  # of text whose anchors are reported in one row for each bucket
PORTION = 64 << 10  # of text whose anchors are worked out at once
ANCHOR_BYTES = 1 << 20  # of an anchor's pieces that are compared in one task
SORTED_BYTES = 128 << 10
SPREAD = 1  # buckets of single windows for each bucket of anchors
LAST = np.iinfo(np.int64).max
CHUNKS = "chunk long, texts binary"
SEEN = "bucket int, chunks binary, counts binary, anchors binary, several binary, sizes binary"
SHARED = "chunk long, bucket int, anchors binary, hot binary"
PIECES = "bucket int, chunk long, number int, size long, hot binary, bytes binary"
LEAST = "chunk long, bucket int, hot binary, number int, spans int, bytes binary"
RESULT = "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _squeeze(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _swell(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, codec="zstd", asbytes=True) if size else b""


def _planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, those of one weight together: they compress far better."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(data: bytes, start: int, count: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, count * width, start).reshape(width, count).T.copy().view(kind).ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    """How far each number is from the one before; `np.cumsum` undoes it. Numbers go around at 2^32."""
    return np.diff(values, prepend=values.dtype.type(0))


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Table]]:
    """The rows of a partition by chunk: neighbours, whatever the batches, up to ROWS rows and `most` bytes of text.
    A longer text is a chunk of its own. A chunk is known by its first row."""
    held: list[pa.RecordBatch] = []
    current, rows, size = 0, 0, 0
    for batch in batches:
        row = batch.column("row").to_pylist()
        start = 0
        for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
            if rows and (rows == ROWS or size + n > most):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield current, pa.Table.from_batches(held)
                held, start, rows, size = [], i, 0, 0
            if not rows:
                current = row[i]
            rows, size = rows + 1, size + n
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield current, pa.Table.from_batches(held)


def _packed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for chunk, table in _chunks(batches, most):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table.combine_chunks())
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "texts"]
        )


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _sections(texts: list[bytes], length: int, most: int = PORTION) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Portions of text with all windows: the texts they are of, their places there, and their bytes. Long texts are cut."""
    text, place, held, size = [], [], [], 0
    for i, data in enumerate(texts):
        for start in range(0, len(data) - length + 1, most):
            part = data if len(data) <= most else data[start : start + most + length - 1]
            text.append(i)
            place.append(start)
            held.append(part)
            size += len(part)
            if size >= most:
                yield np.array(text), np.array(place), held
                text, place, held, size = [], [], [], 0
    if held:
        yield np.array(text), np.array(place), held


class Runs:
    """The runs of windows of a chunk with their anchors, cut down to a bucket and 32 more bits."""

    def __init__(self, texts: list[bytes], length: int, gram: int, bits: int):
        find, parts = Anchors(length, gram), []
        for section, place, held in _sections(texts, length):
            text, start, count, anchor = find(held)
            parts.append((section[text].astype(np.int32), (place[text] + start).astype(np.int32), count.astype(np.int32), anchor >> np.uint64(32 - bits)))
        self.text, self.start, self.count, self.key = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (
            np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.uint64))

    def shared(self, keys: np.ndarray) -> None:
        """Keep the runs with one of the keys, which come in order; the runs then do as well."""
        # Most others already fail by some of their bits.
        low = np.uint64((1 << 22) - 1)
        marks = np.zeros(1 << 22, bool)
        marks[keys & low] = True
        kept = np.flatnonzero(marks[self.key & low])
        key = self.key[kept]
        kept = kept[np.append(keys, ~np.uint64(0))[np.searchsorted(keys, key)] == key]
        kept = kept[np.argsort(self.key[kept], kind="stable")]
        self.text, self.start, self.count, self.key = (x[kept] for x in (self.text, self.start, self.count, self.key))

    def pieces(self, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
        """The number of each run's piece of text, and the first run of each distinct piece. Equal pieces have one key."""
        first = np.arange(len(self.key))
        same = np.zeros(len(self.key) + 1, bool)
        same[1:-1] = self.key[1:] == self.key[:-1]
        again = np.flatnonzero(same[1:] | same[:-1])
        known: dict[bytes, int] = {}
        first[again] = [known.setdefault(x, i) for i, x in zip(again.tolist(), self.bytes(texts, length, again), strict=True)]
        new = first == np.arange(len(first))
        return (np.cumsum(new) - 1)[first], np.flatnonzero(new)

    def bytes(self, texts: list[bytes], length: int, some: np.ndarray) -> list[bytes]:
        """The pieces of text of some of the runs."""
        ends = (self.start[some] + self.count[some] + length - 1).tolist()
        return [texts[t][s:e] for t, s, e in zip(self.text[some].tolist(), self.start[some].tolist(), ends, strict=True)]


def _keys(table: pa.Table, name: str = "anchors") -> np.ndarray:
    found = table.column(name).to_pylist()
    low = np.frombuffer(b"".join(found), "<u4").astype(np.uint64)
    return _in_buckets(table.column("bucket").to_numpy(), [len(x) // 4 for x in found], low)


def _in_buckets(bucket: np.ndarray, counts: Sequence[int], low: np.ndarray) -> np.ndarray:
    return np.sort((np.repeat(bucket, counts).astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64))


def _binary(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Values of so many items each."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _single(pieces: list[bytes], length: int, buckets: int) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    """The distinct windows of some pieces in order of their buckets, these buckets, and the windows of each piece."""
    known: dict[bytes, int] = {}
    places = [
        np.array([known.setdefault(x[p : p + length], len(known)) for p in range(len(x) - length + 1)], np.int64) for x in pieces
    ]
    windows = list(known)
    bucket = np.fromiter((zlib.crc32(x) % (SPREAD * buckets) + buckets for x in windows), np.int64, len(windows))
    order = np.argsort(bucket, kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return [windows[i] for i in order.tolist()], bucket[order], [back[x] for x in places]


def _cuts(bucket: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal numbers that stand next to each other."""
    if not len(bucket):
        return []
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return list(zip(cuts.tolist(), np.append(cuts[1:], len(bucket)).tolist(), strict=True))


def repeats(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM,
    bucket_bytes: int = BUCKET_BYTES, anchor_bytes: int = ANCHOR_BYTES, chunk_bytes: int = CHUNK_BYTES,
    whole_characters: bool = False, carry: Sequence[str] = (),
) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs, and digest and bytes of what is left.

    A byte is removed if a string of `length` bytes over it also starts in a document with a smaller key. Strings
    are those of the input texts and never cross documents.

    1. Each window of `length` bytes is known by its anchor, the bytes around the least of its k-grams, so equal windows have
       equal anchors, and neighbours mostly the same one. Chunks of rows report their anchors once each, in buckets,
       many chunks in a row; those of several documents come back.
    2. Runs of windows with such an anchor are cut out, each distinct piece of a chunk once, with the smallest key
       that has it, and meet by anchor. Where an anchor has one distinct piece, its smallest key is that of all its
       windows; otherwise `bwt.least_of_equal` finds equal windows of different pieces.
    3. The chunks get the smallest key of each window of their pieces and remove those of larger keys.
    A bucket has the anchors of `bucket_bytes` of text, so tasks stay as large as they are however large the table.
    The pieces of an anchor with more than `anchor_bytes` of them, before equal ones are folded, do not meet by anchor:
    each distinct window of them goes once per chunk, as a piece of its own, to the bucket that its bytes name.

    With `whole_characters` the bytes that are left, but not their digest, are without those of cut characters.
    Columns to `carry` go with the texts and come back as c0, c1, ...; then `kept` also has the texts that lose nothing.

    Nulls: a null text is empty. A null key is larger than any other. Of equal keys neither is smaller; repeated rows
    are judged each. An empty table gives no rows. Other columns are left out.
    """
    docs = fixed(docs)
    rows = numbered(docs, F.coalesce(F.col(key).cast("long"), F.lit(int(LAST))).alias("doc_id"),
                    F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("text"),
                    *(F.col(f"`{x}`").alias(f"c{i}") for i, x in enumerate(carry)))
    carried = rows.schema.fields[3:]
    carried_kinds = [(x.name, to_arrow_type(x.dataType)) for x in carried]
    result = StructType(StructType.fromDDL(RESULT).fields + carried)
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    wanted = max(total / bucket_bytes, min(LEAST_BUCKETS, 16 * total / bucket_bytes))
    bits = min(28, max(0, int(np.ceil(np.log2(max(1, wanted))))))
    buckets = 1 << bits  # of anchors; those of single windows come after them

    def report(chunks: list[int], anchors: list[np.ndarray], several: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
        """A row for each bucket, in it the anchors of one chunk after the other."""
        owner = np.repeat(np.arange(len(chunks), dtype=np.int32), [len(x) for x in anchors])
        anchor, many, size = (np.concatenate(x) for x in (anchors, several, sizes))
        bucket = (anchor >> np.uint64(32)).astype(np.uint16 if bits <= 16 else np.int64)
        anchor = anchor.astype("<u4")
        order = np.argsort(bucket, kind="stable")
        anchor, many, size, bucket, owner = (x[order] for x in (anchor, many, size, bucket, owner))
        spans = _cuts(bucket)
        return pa.RecordBatch.from_arrays([
            pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
            pa.array([np.array(chunks, "<i8").tobytes()] * len(spans), pa.binary()),
            pa.array([np.bincount(owner[a:b], minlength=len(chunks)).astype("<u4").tobytes() for a, b in spans], pa.binary()),
            pa.array([_squeeze(_planes(_steps(anchor[a:b]))) for a, b in spans], pa.binary()),
            pa.array([np.packbits(many[a:b]).tobytes() for a, b in spans], pa.binary()),
            pa.array([size[a:b][many[a:b]].tobytes() for a, b in spans], pa.binary()),
        ], names=["bucket", "chunks", "counts", "anchors", "several", "sizes"])

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        seen = 0
        for chunk, table in _chunks(batches, chunk_bytes):
            texts = as_bytes(table.column("text").combine_chunks())
            runs = Runs(texts, length, gram, bits)
            if not len(runs.key):
                continue
            # Does the anchor have a second text here, or many bytes of one?
            order = np.argsort(runs.key)
            anchor, owner = runs.key[order], runs.text[order]
            first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            size = np.add.reduceat(runs.count[order].astype(np.int64) + length - 1, first)
            several = (np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)) | (size > 2 * length)
            held.append((chunk, anchor[first], several, np.minimum(size, (1 << 32) - 1).astype("<u4")))
            seen += sum(map(len, texts))
            del texts, runs, order, anchor, owner
            settle()
            if seen >= SEEN_BYTES:
                yield report(*map(list, zip(*held, strict=True)))
                held, seen = [], 0
        if held:
            yield report(*map(list, zip(*held, strict=True)))

    def meet(table: pa.Table) -> pa.Table:
        settle()
        bucket = table.column("bucket")[0].as_py()
        chunks, counts, wide = (
            np.frombuffer(b"".join(table.column(x).to_pylist()), kind) for x, kind in (("chunks", "<i8"), ("counts", "<u4"), ("sizes", "<u4"))
        )
        each = [int(np.frombuffer(x, "<u4").sum()) for x in table.column("counts").to_pylist()]
        every = np.concatenate([
            np.cumsum(_numbers(_swell(x, 4 * n), 0, n, "<u4"), dtype="<u4") for n, x in zip(each, table.column("anchors").to_pylist(), strict=True)
        ])
        # Anchors that several texts of a chunk have count twice.
        twice = np.concatenate([
            np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for n, x in zip(each, table.column("several").to_pylist(), strict=True)
        ])
        sizes = np.full(len(every), 2 * length)
        sizes[twice] = wide
        order = np.argsort(every)
        placed = every[order]
        first = np.flatnonzero(np.concatenate([[True], placed[1:] != placed[:-1]]))
        size = np.diff(np.append(first, len(order)))
        common = np.empty(len(every), bool)
        common[order] = np.repeat((size > 1) | np.logical_or.reduceat(twice[order], first), size)
        hot = np.empty(len(every), bool)
        hot[order] = np.repeat(np.add.reduceat(sizes[order], first) > anchor_bytes, size)
        cold = common & ~hot
        hot &= common
        ends = np.cumsum(counts, dtype=np.int64)
        back, many = (np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])]) for x in (cold, hot))
        kept = (back > 0) | (many > 0)
        return pa.table({
            "chunk": pa.array(chunks[kept], pa.int64()), "bucket": pa.array(np.full(int(kept.sum()), bucket), pa.int32()),
            "anchors": _binary(every[cold], back[kept]), "hot": _binary(every[hot], many[kept]),
        })

    def cut_out(texts: list[bytes], keys: np.ndarray, hot: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
        """The runs with one of the keys, in order of these, the number of each run's piece, the first run of each piece, and which are hot."""
        runs = Runs(texts, length, gram, bits)
        hot = np.sort(hot)
        runs.shared(np.sort(np.concatenate([keys, hot])) if len(hot) else keys)
        number, first = runs.pieces(texts, length)
        anchor = runs.key[first]
        return runs, number, first, np.append(hot, ~np.uint64(0))[np.searchsorted(hot, anchor)] == anchor

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        settle()
        names = [x.split()[0] for x in PIECES.split(", ")]
        out: list[list] = [[] for _ in names]
        if left.num_rows and right.num_rows:
            table = _unpacked(left.column("texts")[0].as_py())
            texts = as_bytes(table.column("text").combine_chunks())
            many = _keys(right, "hot")
            runs, number, first, hot = cut_out(texts, _keys(right), many)
            anchor = runs.key[first]
            least = np.full(len(first), LAST)
            np.minimum.at(least, number, table.column("doc_id").to_numpy()[runs.text])
            chunk = left.column("chunk")[0].as_py()

            def add(bucket: int, pieces: list[bytes], least: np.ndarray, anchors: np.ndarray, hot: bytes) -> None:
                sizes = np.fromiter(map(len, pieces), "<u4", len(pieces))
                data = b"".join([_planes(_steps(anchors.astype("<u4"))), _planes(sizes), _planes(least.astype("<i8")), *pieces])
                for x, y in zip(out, (bucket, chunk, len(pieces), len(data), hot, _squeeze(data)), strict=True):
                    x.append(y)

            cold = np.flatnonzero(~hot)
            bucket = (anchor[cold] >> np.uint64(32)).astype(np.int64)
            for a, b in _cuts(bucket):
                part = cold[a:b]
                add(int(bucket[a]), runs.bytes(texts, length, first[part]), least[part], anchor[part], b"")
            if hot.any():
                windows, bucket, places = _single(runs.bytes(texts, length, first[hot]), length, buckets)
                low = np.full(len(windows), LAST)
                for i, place in zip(np.flatnonzero(hot).tolist(), places, strict=True):
                    low[place] = np.minimum(low[place], least[i])
                for a, b in _cuts(bucket):
                    # The chunk's hot anchors come back with the first of its windows.
                    add(int(bucket[a]), windows[a:b], low[a:b], np.zeros(b - a, np.uint32), b"" if a else many.astype("<u8").tobytes())
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    def compare(table: pa.Table) -> pa.Table:
        settle()
        bucket = table.column("bucket")[0].as_py()
        known: dict[bytes, int] = {}
        anchors, number, least = [], [], []
        for n, whole, data in zip(*(table.column(x).to_pylist() for x in ("number", "size", "bytes")), strict=True):
            text = _swell(data, whole)
            ends = (np.cumsum(_numbers(text, 4 * n, n, "<u4").astype(np.int64)) + 16 * n).tolist()
            number.append(np.array([known.setdefault(text[a:b], len(known)) for a, b in zip([16 * n, *ends], ends, strict=False)], np.int64))
            least.append(_numbers(text, 8 * n, n, "<i8"))
            anchors.append(np.cumsum(_numbers(text, 0, n, "<u4"), dtype="<u4"))
        pieces = list(known)
        smallest = np.full(len(pieces), LAST)
        np.minimum.at(smallest, np.concatenate(number), np.concatenate(least))
        windows = np.fromiter(map(len, pieces), np.int64, len(pieces)) - length + 1
        # One span of windows with one smallest key, unless the anchor has other pieces too.
        group = np.empty(0, np.int64)
        parts: list[tuple[np.ndarray, ...]] = []
        # Single windows are equal or have nothing in common.
        if bucket < buckets:
            anchor = np.zeros(len(pieces), np.uint32)
            anchor[np.concatenate(number)] = np.concatenate(anchors)
            order = np.argsort(anchor)
            placed = anchor[order]
            first = np.flatnonzero(np.concatenate([[True], placed[1:] != placed[:-1]]))
            size = np.diff(np.append(first, len(order)))
            group = order[np.repeat(size > 1, size)]
            # Whole anchors, so many as hold SORTED_BYTES, or one.
            more = np.add.reduceat((windows + length)[order], first)[size > 1]
            start, held, at = 0, 0, 0
            for n, m in [*zip(size[size > 1].tolist(), more.tolist(), strict=True), (0, SORTED_BYTES + 1)]:
                if at > start and held + m > SORTED_BYTES:
                    mine = group[start:at]
                    values = np.concatenate(least_of_equal([pieces[i] for i in mine.tolist()], smallest[mine], length))
                    head = np.zeros(len(values), bool)
                    head[1:] = values[1:] != values[:-1]
                    ends = np.cumsum(windows[mine])
                    head[ends - windows[mine]] = True
                    head = np.flatnonzero(head)
                    parts.append((np.diff(np.searchsorted(head, np.append(ends - windows[mine], len(values)))),
                                  np.diff(np.append(head, len(values))), values[head]))
                    start, held = at, 0
                at, held = at + n, held + m
        alone = np.ones(len(pieces), bool)
        alone[group] = False
        # The spans of those that are alone come first.
        spans, low = (np.concatenate([x[alone], *(y[i] for y in parts)]) for i, x in ((1, windows), (2, smallest)))
        count = np.ones(len(pieces), np.int64)
        if parts:
            count[group] = np.concatenate([x for x, _, _ in parts])
        ranked = np.concatenate([np.flatnonzero(alone), group])
        begin = np.empty(len(pieces), np.int64)
        begin[ranked] = np.cumsum(count[ranked]) - count[ranked]
        names = [x.split()[0] for x in LEAST.split(", ")]
        out: list[list] = [[] for _ in names]
        for chunk, mine, anchor, many in zip(table.column("chunk").to_pylist(), number, anchors, table.column("hot").to_pylist(), strict=True):
            at = ranges(begin[mine], count[mine])
            data = [_planes(x) for x in (_steps(anchor), count[mine].astype("<u4"), spans[at].astype("<u4"), low[at].astype("<i8"))]
            for x, y in zip(out, (chunk, bucket, many, len(mine), len(at), _squeeze(b"".join(data))), strict=True):
                x.append(y)
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
        return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        settle()
        names = [x.split()[0] for x in RESULT.split(", ")] + [x for x, _ in carried_kinds]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), *(k for _, k in carried_kinds)]
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        table = _unpacked(left.column("texts")[0].as_py())
        texts = as_bytes(table.column("text").combine_chunks())
        keys = table.column("doc_id").to_numpy()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes) - sizes
        spans_of, lost_of = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        from_ = to = np.empty(0, np.int64)
        if right.num_rows:
            right = right.sort_by("bucket")
            many = np.frombuffer(b"".join(right.column("hot").to_pylist()), "<u8")
            pieces, wide, bucket = (right.column(x).to_numpy() for x in ("number", "spans", "bucket"))
            found = []
            for n, m, data in zip(pieces.tolist(), wide.tolist(), right.column("bytes").to_pylist(), strict=True):
                data = _swell(data, 8 * n + 12 * m)
                found.append((np.cumsum(_numbers(data, 0, n, "<u4"), dtype="<u4"), _numbers(data, 4 * n, n, "<u4"),
                              _numbers(data, 8 * n, m, "<u4"), _numbers(data, 8 * n + 4 * m, m, "<i8")))
            anchors, counts, spans, least = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
            # Single windows have no anchor.
            by_anchor = int(pieces[bucket < buckets].sum())
            runs, number, first, hot = cut_out(texts, _in_buckets(bucket[bucket < buckets], pieces[bucket < buckets], anchors[:by_anchor]), many)
            if hot.any():
                # What came back for single windows follows what came back for the other pieces.
                _, _, places = _single(runs.bytes(texts, length, first[hot]), length, buckets)
                cold = int((~hot).sum())
                whole = np.empty(len(first), np.int64)
                whole[~hot], whole[hot] = counts[:cold], list(map(len, places))
                ends = np.cumsum(counts[:cold])
                each = np.concatenate(places)
                begins = np.empty(len(first), np.int64)
                begins[~hot] = ends - counts[:cold]
                n = int(ends[-1]) if cold else 0
                begins[hot] = n + np.cumsum(whole[hot]) - whole[hot]
                spans = np.concatenate([spans[:n], np.ones(len(each), np.int64)])
                least = np.concatenate([least[:n], least[n:][each]])
                at = ranges(begins, whole)
                counts, spans, least = whole, spans[at], least[at]
            ahead = np.cumsum(counts) - counts
            before = np.cumsum(spans) - spans
            at = ranges(ahead[number], counts[number])
            run = np.repeat(np.arange(len(number)), counts[number])
            gone = least[at] < keys[runs.text[run]]
            at, run = at[gone], run[gone]
            start = begin[runs.text[run]] + runs.start[run] + before[at] - before[ahead[number[run]]]
            # Bytes that go next to each other in one text go as one.
            order = np.argsort(start)
            start, stop, text = start[order], np.maximum.accumulate((start + spans[at] + length - 1)[order]), runs.text[run][order]
            head = np.ones(len(start), bool)
            head[1:] = (start[1:] > stop[:-1]) | (text[1:] != text[:-1])
            head = np.flatnonzero(head)
            from_, to, text = start[head], stop[np.append(head[1:], len(stop)) - 1] if len(head) else stop, text[head]
            spans_of += np.bincount(text, minlength=len(texts))
            np.add.at(lost_of, text, to - from_)
        ends = np.cumsum(spans_of).tolist()
        out: list[list] = [[] for _ in range(5)]
        for i, (data, a, n, edges, lost) in enumerate(zip(texts, begin.tolist(), sizes.tolist(), spans_of.tolist(), lost_of.tolist(), strict=True)):
            kept = data
            if lost:
                cuts = slice(ends[i] - edges, ends[i])
                kept = b"".join(data[x:y] for x, y in zip([0, *(to[cuts] - a).tolist()], [*(from_[cuts] - a).tolist(), n], strict=True))
            digest = hashlib.sha256(kept).hexdigest()
            if whole_characters and lost:
                kept = kept.decode("utf-8", "ignore").encode()
            for x, y in zip(out, (n, lost, edges, digest, kept if lost or carried_kinds else None), strict=True):
                x.append(y)
        doc_id = pa.array(keys, mask=keys == LAST)
        more = [table.column(x).cast(k) for x, k in carried_kinds]
        return pa.table([table.column("row"), doc_id, *(pa.array(x, k) for x, k in zip(out, kinds[2:7], strict=True)), *more], names=names)

    texts = rows.mapInArrow(settled(partial(_packed, most=chunk_bytes)), CHUNKS)
    shared = rows.select("row", "text").mapInArrow(settled(see), SEEN).groupBy("bucket").applyInArrow(meet, SHARED)
    pieces = texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(cut, PIECES)
    least = pieces.groupBy("bucket").applyInArrow(compare, LEAST)
    return texts.groupBy("chunk").cogroup(least.groupBy("chunk")).applyInArrow(remove, result)


def without_repeats(docs: DataFrame, *, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The documents with all their columns, their text without what `repeats` removes.

    A character that loses some of its bytes loses all. Documents of which nothing is left stay, with an empty text. All
    columns travel with the texts, so no join brings them back: they must be of types that Arrow has.
    """
    name = text if text in docs.columns else next(x for x in docs.columns if x.lower() == text.lower())
    others = [x for x in docs.columns if x != name]
    none = "__none_of_repeats"
    while none in docs.columns:
        none += "_"
    found = repeats(
        docs.withColumn(none, F.col(name).isNull()), text=name, key=key, whole_characters=True, carry=[none, *others], **options
    )
    # Not decoded in Python: a second worker for each task would stay beside the first for the rest of the job.
    kept = F.when(~F.col("c0"), F.col("kept").cast("string")).alias(name)
    back = {x: F.col(f"c{i}").alias(x) for i, x in enumerate(others, 1)}
    return found.select(*(back.get(x, kept) for x in docs.columns))
