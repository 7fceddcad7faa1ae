"""Language of a text by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.llm.common import portions, ranges, settled

UNKNOWN = "und"
PAGE = 256  # code points of a page of the alphabet
SEGMENT = 256
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, phrase_symbols double"


def fold(key: Column, n: int) -> Column:
    """The checksum of the key's text modulo n. A null key is in no fold."""
    return F.crc32(key.cast("string").cast("binary")) % n


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Alphabet:
    """A symbol for each letter of some texts, frequent ones first, and 1 for all other letters; 0 stands for
    whatever lies between words. Pages of code points with the same symbols are kept once."""

    def __init__(self, texts: list[str]):
        seen = Counter(c for text in texts for c in text if c.isalpha())
        self.size = len(seen) + 2
        table = _letters().astype(np.min_scalar_type(self.size))
        for symbol, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])), 2):
            table[ord(c)] = symbol
        self.pages, page = np.unique(table.reshape(-1, PAGE), axis=0, return_inverse=True)
        self.page = page.ravel().astype(np.uint16)

    def __getitem__(self, points: np.ndarray) -> np.ndarray:
        return self.pages[self.page[points // PAGE], points % PAGE]


def symbols(lowered: list[str], table: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of some lower-case texts, one after the other, and how many each has."""
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    found = table[points]
    owner = np.repeat(np.arange(len(lowered)), lengths)
    kept = found > 0
    # Of what lies between two words one symbol is kept.
    kept[1:] |= (found[:-1] > 0) & (owner[1:] == owner[:-1])
    return found[kept], np.bincount(owner[kept], minlength=len(lowered))


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings, built letter by letter."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return edges


def shared_out(found: np.ndarray, sizes: np.ndarray, most: int, least: int = SEGMENT) -> np.ndarray:
    """The beginnings of some rows of symbols, `most` symbols together: rows longer than an equal share are cut to it,
    and it is larger by what the shorter ones leave. A cut row ends with a 0. Shares are not below `least`: where
    there is no room for that many, the last rows are left out."""
    if len(found) <= most:
        return found
    order = np.sort(sizes)
    left = most - np.concatenate([[0], np.cumsum(order)[:-1]])
    share = left // np.arange(len(order), 0, -1)
    kept = np.minimum(sizes, max(int(share[np.flatnonzero(share < order)[0]]), least))
    kept = np.minimum(kept, np.maximum(most - (np.cumsum(kept) - kept), 0))
    out = found[ranges(np.cumsum(sizes) - sizes, kept)]
    out[(np.cumsum(kept) - 1)[(kept < sizes) & (kept > 0)]] = 0
    return out


def interlaced(rows: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """One array of all rows' entries, and the place of each row in it: that of its entry c is the row's place + c.

    No two rows have the same place, so an entry names its row by it: (place of the row, value), -1 where none is.
    Rows of several entries go where they fit; those of one entry fill the gaps.
    """
    width = 1 + max((c for row in rows for c in row), default=0)
    taken, used = bytearray(4 * width + 2 * sum(map(len, rows)) + len(rows)), set()
    places = np.zeros(len(rows), np.int64)
    low, filling = width, False
    for i in sorted(range(len(rows)), key=lambda i: -len(rows[i])):
        row = sorted(rows[i]) or [0]
        if len(row) == 1 and not filling:
            low, filling = width, True
        at = taken.find(0, low)
        for tried in count(1):
            if at < 0 or at + width >= len(taken):
                at = len(taken) if at < 0 else at
                taken.extend(bytes(len(taken) + width))
            place = at - row[0]
            if place not in used and not any(taken[place + c] for c in row):
                break
            at = taken.find(0, at + 1)
            if tried % 16 == 0:
                low = max(at, low)
        used.add(place)
        places[i] = place
        for c in rows[i]:
            taken[place + c] = 1
        if filling:
            low = at
    entries = np.full((int(places.max(initial=0)) + width, 2), -1, np.int32)
    for place, row in zip(places.tolist(), rows, strict=True):
        for c, value in row.items():
            entries[place + c] = place, value
    return entries, places


class CrossParser:
    """One automaton per language, their transitions interlaced in one array.

    A state is known by its place there. Where no substring of the language's text goes on with a symbol a phrase
    ends, and the next one begins with it: `begin` has the state after each symbol of each language.
    """

    def __init__(self, samples: dict[str, list[str]], total: int):
        self.languages = sorted(samples)
        self.table = Alphabet([x for texts in samples.values() for x in texts])
        most = total // max(len(samples), 1)
        rows, roots, bits = [], [], []
        begin = np.empty((len(self.languages), self.table.size), np.int64)
        for i, language in enumerate(self.languages):
            text = shared_out(*symbols([x + "\n" for x in samples[language]], self.table), most).tolist()
            edges = suffix_automaton(text)
            base = len(rows)
            roots.append(base)
            rows += [{c: to + base for c, to in out.items()} for out in edges]
            # One state more: after a symbol that the text lacks, which is a phrase of its own.
            begin[i] = len(rows)
            begin[i, list(rows[base])] = list(rows[base].values())
            rows.append({})
            bits.append(np.log2(max(len(text), 2)))
        entries, places = interlaced(rows)
        if rows:
            entries[:, 1] = np.where(entries[:, 0] < 0, -1, places[entries[:, 1]])
        # The row of an entry in the upper half, the next state in the lower.
        self.steps = (entries[:, 0].astype(np.int64) << 32) | entries[:, 1].astype(np.uint32)
        self.roots = places[roots].astype(np.int32)
        self.begin = (places[begin] if rows else begin).astype(np.int32)
        self.bits = np.array(bits)

    def costs(self, text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Per text and language: the phrases needed, times the bits that name a place of the language's text.

        Texts are parsed whole, in segments of SEGMENT symbols side by side; a phrase ends with its segment.
        """
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        part = ranges(np.zeros(len(sizes), np.int64), pieces)
        start = np.repeat(np.cumsum(sizes) - sizes, pieces) + part * SEGMENT
        length = np.minimum(np.repeat(sizes, pieces) - part * SEGMENT, SEGMENT)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        state = np.repeat(self.roots[:, None], len(start), axis=1)
        phrases = np.ones(state.shape, np.int32)
        active = np.searchsorted(-length, -np.arange(SEGMENT), side="left")
        for t in range(SEGMENT):
            n = active[t]  # segments longer than t
            if not n:
                break
            symbol = text[start[:n] + t]
            entry = self.steps[state[:, :n] + symbol.astype(np.int32)]
            ends = (entry >> 32) != state[:, :n]
            if t:  # nothing ends at the beginning
                phrases[:, :n] += ends
            state[:, :n] = np.where(ends, self.begin[:, symbol], entry.astype(np.int32))
        total = np.stack([np.bincount(owner, p, len(sizes)) for p in phrases], axis=1)
        return total * self.bits


def fit(
    docs: DataFrame, training: Column, *, text: str = "text", label: str = "lang", rows: int = 64, chars: int = 2048,
    total: int = 65536, languages: int = 256,
) -> CrossParser:
    """Automata of a bounded sample: of each of the `languages` most frequent labels `rows` rows, chosen by a digest
    of their first `chars` characters; rows that begin with the same ones count once. Over all languages the sample
    has `total` symbols in equal shares, and so have the rows of a label in its share, as many as get a SEGMENT.
    A label beyond the `languages` most frequent is never predicted.
    """
    known = docs.filter(training & F.col(label).isNotNull() & (F.length(text) > 0)).select(
        F.col(label).cast("string").alias("label"), F.col(text).alias("text")
    )
    counts = known.groupBy("label").count().orderBy(F.desc("count"), "label").limit(languages)
    names = [row.label for row in counts.collect()]
    chosen = W.partitionBy("label").orderBy("digest")
    begin = F.substring("text", 1, chars)
    sample = known.filter(F.col("label").isin(names)).select("label", F.xxhash64(begin).alias("digest"), begin.alias("text"))
    distinct = sample.select("label", "digest").distinct()
    places = distinct.withColumn("place", F.row_number().over(chosen)).filter(F.col("place") <= rows)
    picked = sample.join(F.broadcast(places), ["label", "digest"]).groupBy("label", "place").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for row in sorted(picked.collect(), key=lambda x: (x.label, x.place)):
        texts.setdefault(row.label, []).append(row.text.lower())
    return CrossParser(texts, total)


def _predict(parser: CrossParser, column: pa.Array) -> tuple[list[str], list[float], list[float]]:
    """Label, score and mean phrase length of each text; some texts at a time are taken out of the batch."""
    labels, scores, lengths = [], [], []
    for start in range(0, len(column), 256):
        texts = column.slice(start, 256).to_pylist()
        for a, b in portions(texts):
            lowered = [(x or "").lower() for x in texts[a:b]]
            found, sizes = symbols(lowered, parser.table)
            costs = parser.costs(found, sizes) if parser.languages else np.zeros((b - a, 0))
            for i, text in enumerate(lowered):
                if costs.shape[1] == 0 or sizes[i] == 0 or not any(map(str.isalpha, text)):
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                    lengths.append(0.0)
                    continue
                best = int(np.argmin(costs[i]))
                rest = np.delete(costs[i], best)
                labels.append(parser.languages[best])
                scores.append(float(1.0 - costs[i, best] / rest.min()) if len(rest) else 1.0)
                lengths.append(float(sizes[i] * parser.bits[best] / costs[i, best]))
    return labels, scores, lengths


def identify(docs: DataFrame, parser: CrossParser, *, text: str = "text", key: str = "doc_id", held_out: Column) -> DataFrame:
    """Per document the language whose text needs the fewest phrases, each weighed with the bits of its address.

    `score` is 1 - best / second; `phrase_symbols` is the mean length of a phrase. A tie goes to the first label
    by name. A null text, and one without a letter, is `und` with score 0; without labelled rows all are. A null
    key stays null and is not held out. Repeated rows are judged each.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores, lengths = _predict(parser, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(labels, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(lengths, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score", "phrase_symbols"],
            )

    return rows.mapInArrow(settled(run), SCHEMA)


def keep_languages(docs: DataFrame, parser: CrossParser, *, text: str = "text", least: float = 1.2) -> DataFrame:
    """The documents in a learned language, with all their columns: what is `und` goes, and what even the best
    language only parses into phrases of less than `least` symbols (scripts that no labelled row has)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, lengths = _predict(parser, batch.column(text))
            yield batch.filter(pa.array([x >= least for x in lengths], pa.bool_()))

    return docs.mapInArrow(settled(run), docs.schema)
