"""A log-bilinear language model trained by noise-contrastive estimation, and a smoothed unigram base."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalloom.llm.common import as_bytes, numbered, portions, ranges, settled, spaced_words
from evalloom.session import stage

END = 0  # the class of the end mark, and of what stands before a text
REMEMBERED = 1 << 17  # words whose class a task looks up but does not work out again
LONGEST_HEAD = 64
LEVELS = 64  # of counts, from one power of two to the next
COUNTS = "word binary, bucket int, n long"
PARTS = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, tail array<binary>"
)


@dataclass
class Shape:
    """Bounds of the model: all of them parameters, none of them grows with the corpus."""

    words: int = 159  # most frequent words with a class of their own
    buckets: int = 96  # classes of all other words, by their last bytes
    size: int = 16  # of a representation
    noise: int = 64  # noise samples of a step
    batch: int = 256  # contexts of a step
    epochs: int = 2
    block: int = 4_000_000  # tokens counted before a task learns from them
    rate: float = 0.05
    rounds: int = 2
    head: int = 100_000  # words whose counts are sent to every task; the others are joined

    @property
    def classes(self) -> int:
        return 1 + self.words + self.buckets


class Classes(dict):
    """Word to class. A word without a class of its own goes by its last bytes, which mark language and form."""

    def __init__(self, own: list[bytes], shape: Shape):
        super().__init__({word: i for i, word in enumerate(own, 1)})
        self.first, self.buckets = 1 + shape.words, shape.buckets

    def __missing__(self, word: bytes) -> int:
        found = self.first + zlib.crc32(word[-3:]) % self.buckets
        if len(self) < REMEMBERED and len(word) <= LONGEST_HEAD:
            self[word] = found
        return found


class LogBilinear:
    """score(w | u, v) = (R1[v] + R2[u]) . Q[w] + b[w] over classes; v comes right before w, u before v."""

    names = ("r1", "r2", "q", "b")

    def __init__(self, shape: Shape, frequency: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        n, d = shape.classes, shape.size
        self.shape = shape
        self.r1, self.r2, self.q = (rng.normal(0.0, 0.3 / np.sqrt(d), (n, d)) for _ in range(3))
        self.noise = (frequency + 1.0) / (frequency + 1.0).sum()
        self.b = np.log(self.noise)
        self.sums = {x: np.full(getattr(self, x).shape, 1e-8) for x in self.names}

    def _step(self, name: str, gradient: np.ndarray) -> None:
        self.sums[name] += gradient**2
        getattr(self, name)[...] -= self.shape.rate * gradient / np.sqrt(self.sums[name])

    def learn(self, words: np.ndarray, counts: np.ndarray, context: np.ndarray, contexts: np.ndarray,
              rng: np.random.Generator) -> None:
        """One step over some contexts and all words seen after them: tell the words from noise that the contexts
        share. `context` is the place of each word's context in `contexts`; counts weigh both sides."""
        n, d = self.q.shape
        k = self.shape.noise
        before, second = contexts % n, contexts // n
        weight = counts / counts.sum()
        share = np.bincount(context, weight, len(contexts))
        noise = rng.choice(n, k, p=self.noise)
        log_noise = np.log(k * self.noise)
        hidden = self.r1[before] + self.r2[second]
        target = np.einsum("ij,ij->i", hidden[context], self.q[words]) + self.b[words] - log_noise[words]
        other = hidden @ self.q[noise].T + self.b[noise] - log_noise[noise]
        missed = -weight / (1.0 + np.exp(np.clip(target, -30, 30)))
        taken = share[:, None] / (1.0 + np.exp(-np.clip(other, -30, 30)))

        def gather(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
            flat = (index[:, None] * d + np.arange(d)).ravel()
            return np.bincount(flat, values.ravel(), rows * d).reshape(rows, d)

        to_hidden = taken @ self.q[noise] + gather(context, missed[:, None] * self.q[words], len(contexts))
        to_q = gather(words, missed[:, None] * hidden[context], n) + gather(noise, taken.T @ hidden, n)
        to_b = np.bincount(words, missed, n) + np.bincount(noise, taken.sum(axis=0), n)
        self._step("r1", gather(before, to_hidden, n))
        self._step("r2", gather(second, to_hidden, n))
        self._step("q", to_q)
        self._step("b", to_b)

    def learn_all(self, keys: np.ndarray, counts: np.ndarray, rng: np.random.Generator) -> None:
        """`epochs` passes over counted triples (second * n + before) * n + word, some contexts at a time."""
        n = len(self.q)
        contexts, first, sizes = np.unique(keys // n, return_index=True, return_counts=True)
        for _ in range(self.shape.epochs):
            order = rng.permutation(len(contexts))
            for a in range(0, len(order), self.shape.batch):
                part = order[a : a + self.shape.batch]
                at = ranges(first[part], sizes[part])
                self.learn(keys[at] % n, counts[at], np.repeat(np.arange(len(part)), sizes[part]), contexts[part], rng)

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, x).ravel() for x in self.names])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for name in self.names:
            part = getattr(self, name)
            part[...] = vector[at : at + part.size].reshape(part.shape)
            at += part.size

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by the word before and by the second before, and the log of the sum over all classes for each
        context: matrix products over blocks of contexts, so that each context's probabilities add up to 1."""
        one, two = self.r1 @ self.q.T + self.b, self.r2 @ self.q.T
        total = np.empty((len(one), len(two)))
        for v in range(len(one)):
            scores = one[v] + two
            top = scores.max(axis=1)
            total[v] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return one, two, total


def contexts(documents: list[list[bytes]], classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class, class before and second before of every token; the document of each. A text ends with END."""
    sizes = np.fromiter(map(len, documents), np.int64, len(documents)) + 1
    flat = np.fromiter(map(classes.__getitem__, chain.from_iterable(documents)), np.int64, int(sizes.sum()) - len(sizes))
    ends = np.cumsum(sizes) - 1
    token = np.zeros(int(sizes.sum()), np.int64)
    word = np.ones(len(token), bool)
    word[ends] = False
    token[word] = flat
    before, second = np.zeros(len(token), np.int64), np.zeros(len(token), np.int64)
    before[1:] = token[:-1]
    starts = ends - sizes + 1
    before[starts] = END
    second[1:] = before[:-1]
    second[starts] = END
    return token, before, second, np.repeat(np.arange(len(sizes)), sizes)


def word_counts(texts: DataFrame, shape: Shape) -> DataFrame:
    """How often each word occurs, over all texts; `bucket` is the class it has if it gets none of its own."""
    plain = Classes([], shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(map(plain.__getitem__, held), pa.int32()),
                 pa.array(held.values(), pa.int64())], names=["word", "bucket", "n"],
            )

        held: Counter = Counter()
        for batch in batches:
            for text in as_bytes(batch.column("text")):
                held.update(spaced_words(text or b""))
                if len(held) > 400_000:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    return texts.mapInArrow(settled(run), COUNTS).groupBy("word", "bucket").agg(F.sum("n").alias("n"))


def train(texts: DataFrame, model: LogBilinear, classes: Classes) -> LogBilinear:
    """Every round each task goes through its texts from the shared parameters; then they are averaged by tokens.

    Averages are summed in the shuffle, one row per parameter, so the driver gets one vector however many tasks.
    """
    shape, frequency = model.shape, model.noise

    for turn in range(shape.rounds):
        start = model.vector()

        def run(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            own = LogBilinear(shape, frequency)
            own.noise = frequency
            own.load(start)
            n, seen, held, size = shape.classes, 0, [], 0

            def learn() -> None:
                keys, place = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([x for _, x in held]))
                own.learn_all(keys, counts, np.random.default_rng([turn, seen]))

            for batch in batches:
                texts = as_bytes(batch.column("text"))
                for a, b in portions(texts):
                    token, before, second, _ = contexts([spaced_words(x or b"") for x in texts[a:b]], classes)
                    held.append(np.unique((second * n + before) * n + token, return_counts=True))
                    seen, size = seen + len(token), size + len(token)
                    if size >= shape.block:
                        learn()
                        held, size = [], 0
            if held:
                learn()
            if seen:
                values = own.vector() * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values) + 1), pa.int32()), pa.array(np.append(values, float(seen)))],
                    names=["i", "x"],
                )

        summed = texts.mapInArrow(settled(run), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
        if not summed:
            break
        vector = np.zeros(len(start) + 1)
        for row in summed:
            vector[row.i] = row.x
        model.load(vector[:-1] / vector[-1])
    return model


def frequent(counts: DataFrame, most: int) -> list:
    """The most frequent words, `most` at most, in order. Counts fall into a few thousand levels; the levels that fit
    are taken whole, so no task sends more to the driver than what is kept."""
    short = counts.filter(F.octet_length("word") <= LONGEST_HEAD).withColumn("level", F.floor(F.log2("n") * LEVELS))
    left, lowest = most, None
    for row in short.groupBy("level").count().orderBy(F.desc("level")).collect():
        left -= row["count"]
        if left < 0:
            break
        lowest = row.level
    kept = [] if lowest is None else short.filter(F.col("level") >= lowest).select("word", "bucket", "n").collect()
    return sorted(kept, key=lambda r: (-r.n, bytes(r.word)))


def score(docs: DataFrame, training: Column, held_out: Column, *, text: str = "text", key: str = "doc_id",
          shape: Shape | None = None) -> DataFrame:
    """Base and model log10 probabilities of every whole text, learnt from the rows where `training` holds.

    Words are counted over all training texts. The base gives a token (c + 1) / (N + V + 1). The model predicts the
    token's class from the two classes before it, with probabilities that add up to 1 over the classes; a word in a
    class of many has the smoothed share (c + 1) / (N_k + V_k + 1) of it, and the unknown words of a class one more
    share. Counts of the most frequent words go to every task (`shape.head`, short words only); the others are joined.

    Nulls: a null text is empty, and an empty text is its end mark; a null key stays null. Rows where `training` is
    null are not learnt from. Repeated rows are scored each, and learnt from each. Without training rows every word
    is unknown. An empty table gives no rows. Other columns are left out.
    """
    shape = shape or Shape()
    texts = docs.filter(training).select(F.col(text).alias("text"))
    counts = stage(word_counts(texts, shape), "words")
    ends = texts.count()
    buckets = {r.bucket: (r.n, r.v) for r in counts.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    total = sum(n for n, _ in buckets.values()) + ends
    distinct = sum(v for _, v in buckets.values()) + (ends > 0)
    head = frequent(counts, shape.head)
    own = [bytes(r.word) for r in head[: shape.words]]
    classes = Classes(own, shape)
    size, kinds = np.zeros(shape.classes), np.zeros(shape.classes)
    for bucket, (n, v) in buckets.items():
        size[bucket], kinds[bucket] = n, v
    for r in head[: shape.words]:
        size[r.bucket] -= r.n
        kinds[r.bucket] -= 1
        size[classes[bytes(r.word)]] = r.n
    size[END] = ends
    within = -np.log10(size + kinds + 1)  # of a class of many; counts are added per word
    alone = np.arange(shape.classes) <= shape.words
    within[alone] = 0.0
    model = train(texts, LogBilinear(shape, size), classes)
    one, two, partition = model.tables()
    logs = {bytes(r.word): float(np.log10(r.n + 1)) for r in head}
    end_log = float(np.log10(ends + 1))
    least = -float(np.log10(total + distinct + 1))
    known_end = int(ends > 0)
    rows = numbered(
        docs, F.col(key).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )
    names = [x.split()[0] for x in PARTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = logs.get
        for batch in batches:
            held = as_bytes(batch.column("text"))
            ids = [batch.column(x).to_pylist() for x in names[:3]]
            for a, b in portions(held):
                documents = [spaced_words(x or b"") for x in held[a:b]]
                token, before, second, owner = contexts(documents, classes)
                found = one[before, token] + two[second, token] - partition[before, second]
                found = found / np.log(10.0) + within[token]
                sums = np.bincount(owner, found, len(documents))
                out: list[list] = [[] for _ in names]
                # The logs of all words at once, unknown ones as NaN; those of a class of many count for the model too.
                flat = list(chain.from_iterable(documents))
                log = np.array(list(map(known, flat)), np.float64)
                sizes = np.fromiter(map(len, documents), np.int64, len(documents))
                word = np.ones(len(token), bool)
                word[np.cumsum(sizes + 1) - 1] = False
                in_many, of = token[word] > shape.words, owner[word]
                seen = ~np.isnan(log)
                n_known = np.bincount(of[seen], minlength=len(documents)).tolist()
                base = np.bincount(of[seen], log[seen], len(documents)).tolist()
                many = np.bincount(of[seen & in_many], log[seen & in_many], len(documents)).tolist()
                tails: list[list[bytes]] = [[] for _ in documents]
                for at in np.flatnonzero(~seen).tolist():
                    tails[of[at]].append(flat[at])
                for i, (words, tail) in enumerate(zip(documents, tails, strict=True)):
                    row = [
                        *(x[a + i] for x in ids), len(words) + 1, n_known[i] + known_end,
                        base[i] + end_log + (len(words) + 1) * least, float(sums[i]) + many[i], tail[:50_000],
                    ]
                    for x, y in zip(out, row, strict=True):
                        x.append(y)
                    # The rest of a very long list of words goes to rows of its own.
                    for c in range(50_000, len(tail), 50_000):
                        for x, y in zip(out, [*row[:3], 0, 0, 0.0, 0.0, tail[c : c + 50_000]], strict=True):
                            x.append(y)
                kinds_ = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                          pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds_, strict=True)], names=names)

    parts = stage(rows.mapInArrow(settled(run), PARTS), "scores")
    tail = parts.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")
    extra = F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0))
    tail = tail.groupBy("row").agg(F.count("n").alias("n_known"), extra.alias("extra"))
    both = parts.drop("tail").unionByName(
        tail.select("row", "n_known", F.lit(0).cast("long").alias("n_tokens"), F.col("extra").alias("base"),
                    F.col("extra").alias("model")), allowMissingColumns=True,
    )
    return both.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"), F.sum("model").alias("score"),
    ).drop("row")
