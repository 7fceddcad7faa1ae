"""Benchmark passages in documents, found by binary search of their suffixes in suffix arrays of the documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalloom.llm.common import as_bytes, fixed, numbered, plain_words, portions, ranges, settled

WINDOW = 10
BLOCK_BYTES = 16 << 20
PORTION = 2 << 20
HITS = "row long, doc_id long, n_words long, hit_from array<int>, hit_to array<int>, items array<string>"
LONGEST = "item string, start int, length int, doc_id long, at int"


class Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class Tests:
    """The suffixes of a block of test items, as numbers of words. 0 stands for any other word."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocabulary, self.ids, lengths, numbers = Vocabulary(), [], [], []
        for item, text in items:
            words = plain_words(text)
            if words:
                for word in words:
                    if word not in self.vocabulary:
                        self.vocabulary[word] = len(self.vocabulary) + 1
                self.ids.append(item)
                lengths.append(len(words))
                numbers.append([self.vocabulary[word] for word in words])
        self.words = np.array([*chain.from_iterable(x + [0] for x in numbers), 0], np.int64)
        length = np.array(lengths, np.int64)
        begin = np.cumsum(length + 1) - (length + 1)
        self.start = ranges(begin, length)
        self.item = np.repeat(np.arange(len(length)), length)
        self.left = np.repeat(begin + length, length) - self.start
        # A window starts where as many words are left; an item of fewer words is one window.
        self.width = np.minimum(window, np.repeat(length, length))
        self.is_window = self.left >= self.width
        self.offset = self.start - np.repeat(begin, length)
        self.least = int(self.width.min()) if len(length) else 0
        self.longest = int(length.max()) if len(length) else 0


class SuffixArray:
    """Suffixes of the word sequences of some documents, in order by their first `depth` words.

    Only positions that could start a match are kept: those in a run of at least `least` test words.
    """

    def __init__(self, documents: list[list[bytes]], tests: Tests, least: int):
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        words = np.zeros(int(sizes.sum()) + 1, np.int64)
        words[:-1] = list(map(tests.vocabulary.__getitem__, chain.from_iterable(documents)))
        document = np.repeat(np.arange(len(documents)), sizes)
        begins = np.cumsum(sizes) - sizes
        known = words[:-1] > 0
        # A run ends at an unknown word and at the end of its document.
        edge = np.ones(len(known), bool)
        edge[1:] = ~known[1:] | ~known[:-1] | (document[1:] != document[:-1])
        at = np.flatnonzero(edge)
        run = np.diff(np.append(at, len(known)))
        keep = known[at] & (run >= max(least, 1)) if len(at) else np.empty(0, bool)
        at, run = at[keep], run[keep]
        place = ranges(at, run)  # of each kept word among all
        gaps = np.repeat(np.arange(len(run)), run)
        self.words = np.zeros(len(place) + len(run) + 1, np.int64)
        spot = np.arange(len(place)) + gaps
        self.words[spot] = words[place]
        self.document = np.full(len(self.words), -1)
        self.offset = np.zeros(len(self.words), np.int64)
        self.document[spot] = document[place]
        self.offset[spot] = place - begins[document[place]] if len(place) else 0
        self.order = spot[np.argsort(self._ranks(spot, tests.longest), kind="stable")]

    def _ranks(self, spot: np.ndarray, depth: int) -> np.ndarray:
        """Ranks by ever longer prefixes: of twice as many words each time."""
        rank, width = self.words, 1
        while width < depth and len(spot):
            ahead = np.zeros(len(rank), np.int64)
            ahead[:-width] = rank[width:] if width < len(rank) else 0
            key = rank[spot] * (int(rank.max()) + 1) + ahead[spot]
            distinct, inverse = np.unique(key, return_inverse=True)
            rank = np.zeros(len(rank), np.int64)
            rank[spot] = inverse + 1
            width *= 2
            if len(distinct) == len(spot):
                break
        return rank[spot]

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            here = self.words[self.order[middle] + depth]
            below = here <= word[open_] if right else here < word[open_]
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
        return low

    def search(self, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each test suffix: the length of its longest match and one place of it; the interval of its window."""
        n = len(tests.start)
        low, high = np.zeros(n, np.int64), np.full(n, len(self.order))
        length, some = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alive, depth = np.arange(n), 0
        while len(alive) and len(self.order):
            alive = alive[tests.left[alive] > depth]
            word = tests.words[tests.start[alive] + depth]
            begin = self._bound(low[alive], high[alive], depth, word, False)
            end = self._bound(begin, high[alive], depth, word, True)
            found = begin < end
            alive, begin, end, depth = alive[found], begin[found], end[found], depth + 1
            low[alive], high[alive], length[alive], some[alive] = begin, end, depth, self.order[begin]
            full = tests.is_window[alive] & (tests.width[alive] == depth)
            first[alive[full]], last[alive[full]] = begin[full], end[full]
        return length, some, first, last

    def hits(self, tests: Tests, count: int) -> tuple[list[list[int]], list[list[int]], list[set]]:
        """Per document the maximal runs of hit words, and the items with occurring windows."""
        _, _, first, last = self.search(tests)
        begins: list[list[int]] = [[] for _ in range(count)]
        ends: list[list[int]] = [[] for _ in range(count)]
        items: list[set] = [set() for _ in range(count)]
        found = np.flatnonzero(last > first)
        if not len(found):
            return begins, ends, items
        many = last[found] - first[found]
        spots = self.order[ranges(first[found], many)]
        covered = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(covered, spots, 1)
        np.add.at(covered, spots + np.repeat(tests.width[found], many), -1)
        hit = np.append(np.cumsum(covered) > 0, False)
        turn = np.flatnonzero(np.diff(np.concatenate([[False], hit]).astype(np.int8)))
        for a, b in zip(turn[::2], turn[1::2], strict=True):
            d = self.document[a]
            begins[d].append(int(self.offset[a]))
            ends[d].append(int(self.offset[a]) + int(b - a))
        pairs = np.unique(np.stack([self.document[spots], np.repeat(tests.item[found], many)]), axis=1)
        for d, i in pairs.T.tolist():
            items[d].add(tests.ids[i])
        return begins, ends, items


def blocks(benchmark: DataFrame, text: str, item: str, window: int, most: int) -> Iterator[Tests]:
    """The benchmark in blocks of `most` bytes or one item: the driver and the tasks hold one block at a time."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.encode(text, "UTF-8").alias("text"))
    held: list[tuple[str | None, bytes]] = []
    size = 0
    for row in rows.filter(F.col("text").isNotNull()).toLocalIterator():
        if held and size + len(row.text) > most:
            yield Tests(held, window)
            held, size = [], 0
        held.append((row.item, bytes(row.text)))
        size += len(row.text)
    # An empty benchmark is one block without tests.
    yield Tests(held, window)


def _arrays(texts: list[bytes | None], tests: Tests, least: int) -> Iterator[tuple[int, list, SuffixArray]]:
    for a, b in portions(texts, PORTION):
        words = [plain_words(x) if x else [] for x in texts[a:b]]
        yield a, words, SuffixArray(words, tests, least)


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", key: str = "doc_id", item: str = "item_id",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: `n_words`, `n_hit`, `n_items`, `items_sha256`, `contaminated`, and the runs of hit words.

    A word is hit if it lies in an occurrence of `window` consecutive words of an item; an item of fewer words is
    one window. Texts do not move: each task sorts the suffixes of its documents and looks up a block of the
    benchmark, which is broadcast; a benchmark of more than `block_bytes` takes one pass per block.

    Nulls: a null text has no words; a null item text is no item; an item without id hits words but is not
    listed. Repeated documents are judged each; repeated items count once. Empty tables give no rows or no hits.
    """
    rows = numbered(fixed(docs), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    passes = []
    for tests in blocks(benchmark, text, item, window, block_bytes):

        def search(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns: list[list] = [[], [], [], []]
                for _, words, array in _arrays(as_bytes(batch.column("text")), tests, tests.least):
                    begins, ends, items = array.hits(tests, len(words))
                    columns[0] += map(len, words)
                    columns[1] += begins
                    columns[2] += ends
                    columns[3] += [sorted(x for x in found if x is not None) for found in items]
                types = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("doc_id"), *map(pa.array, columns, types)],
                    names=["row", "doc_id", "n_words", "hit_from", "hit_to", "items"],
                )

        passes.append(rows.mapInArrow(settled(search), HITS))
    found = passes[0]
    if len(passes) > 1:
        for more in passes[1:]:
            found = found.unionByName(more)
        gathered = found.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list(F.arrays_zip("hit_from", "hit_to")))).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        # Runs in order of their start: one that begins beyond the last end opens a new run.
        merged = F.expr("""aggregate(runs, cast(array() as array<struct<hit_from:int,hit_to:int>>), (done, x) ->
            if(size(done) > 0 and x.hit_from <= element_at(done, -1).hit_to,
               concat(slice(done, 1, size(done) - 1), array(named_struct('hit_from', element_at(done, -1).hit_from,
                      'hit_to', greatest(element_at(done, -1).hit_to, x.hit_to)))),
               concat(done, array(named_struct('hit_from', x.hit_from, 'hit_to', x.hit_to)))))""")
        found = gathered.withColumn("runs", merged).select(
            "row", "doc_id", "n_words", F.col("runs.hit_from").alias("hit_from"), F.col("runs.hit_to").alias("hit_to"),
            "items",
        )
    hit = F.expr("aggregate(zip_with(hit_from, hit_to, (a, b) -> bigint(b - a)), 0L, (s, x) -> s + x)")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_from") > 0).alias("contaminated"), "hit_from", "hit_to",
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents without a hit word, with all their columns. Rows stay where they are. Nulls as above."""
    kept = docs
    for tests in blocks(benchmark, text, item, window, block_bytes):

        def clean(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep: list[bool] = []
                for _, words, array in _arrays(as_bytes(batch.column(text)), tests, tests.least):
                    keep += [not x for x in array.hits(tests, len(words))[0]]
                yield batch.filter(pa.array(keep, pa.bool_()))

        kept = kept.mapInArrow(settled(clean), docs.schema)
    return kept


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", key: str = "doc_id", item: str = "item_id",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each test suffix that occurs: its longest verbatim match in words, and the first place of one that long."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = []
    for tests in blocks(benchmark, text, item, WINDOW, block_bytes):

        def search(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for a, _, array in _arrays(as_bytes(batch.column("text")), tests, 1):
                    length, some, _, _ = array.search(tests)
                    t = np.flatnonzero(length)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([tests.ids[i] for i in tests.item[t]], pa.string()),
                        pa.array(tests.offset[t], pa.int32()), pa.array(length[t], pa.int32()),
                        pa.array([ids[a + d] for d in array.document[some[t]]], pa.int64()),
                        pa.array(array.offset[some[t]], pa.int32()),
                    ], names=["item", "start", "length", "doc_id", "at"])

        parts.append(rows.mapInArrow(search, LONGEST))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = F.struct(F.col("length"), -F.col("doc_id"), -F.col("at"))
    return every.groupBy("item", "start").agg(
        F.max("length").alias("length"), F.max_by("doc_id", best).alias("doc_id"), F.max_by("at", best).alias("at")
    )
