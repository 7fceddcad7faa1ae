"""Packing, sharding, scoring, language and vectors."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evalloom.llm import language, near_vectors, packing, scoring, sharding, token_blocks
from evalloom.llm.tokens import Tokens

SMALL = Path("/root/testdata/sf0.001")
small = pytest.mark.skipif(not SMALL.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    found = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def tokens():
    return Tokens()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text("ab \n\t'.<|endoftext|>1é", max_size=60))
def test_tokens_are_those_of_the_vocabularys_library(library, tokens, text):
    assert tokens.ids(text).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]


def check_pieces(rows, docs, library, width=1024):
    """Each id in exactly one piece, checksums right, sequences gapless and not too long."""
    by_sequence = defaultdict(list)
    pieces = Counter()
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens, r.start, r.length, r.ids_crc32] += 1
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= width
    expected = Counter()
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), width):
            part = ids[start : start + width]
            expected[doc_id, len(ids), start, len(part), zlib.crc32(part.tobytes())] += 1
    assert pieces == expected
    return len(by_sequence), sum(r.length for r in rows)


def test_packing(messy, messy_rows, library):
    rows = packing.pack(messy).collect()
    sequences, total = check_pieces(rows, [x[:2] for x in messy_rows], library)
    assert sequences <= math.ceil(total / 1024) * 1.1 + 1


@small
def test_packing_leaves_little_padding(spark, library):
    docs = spark.read.parquet(str(SMALL / "documents.parquet"))
    sequences, total = check_pieces(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], library)
    assert 1 - total / (1024 * sequences) < 0.02


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=300))
def test_patterns_meet_the_demand(lengths):
    demand = np.bincount(np.array(lengths, np.int64), minlength=33)
    found = packing.whole(demand, 32)
    assert (sum((n * p for p, n in found), np.zeros(33, np.int64)) == demand).all()
    assert all((p * np.arange(33)).sum() <= 32 for p, _ in found)


def test_relaxed_program_is_near_its_bound():
    rng = np.random.default_rng(2)
    demand = np.bincount(rng.integers(1, 64, 20_000), minlength=65)
    total = sum(x for _, x in packing.relaxed(demand, 64))
    assert total <= (demand * np.arange(65)).sum() / 64 * 1.02


def test_knapsack():
    value = np.zeros(11)
    value[[3, 4, 5]] = 4.0, 5.0, 7.0
    worth, pattern = packing.best_pattern(value, 10)
    assert worth == 14.0 and pattern[5] == 2


def test_blocks_round_trip(messy, messy_rows, library):
    rows = token_blocks.token_blocks(messy, pool=5000).collect()
    texts = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 1024 and not ids[r.n_tokens :].any() and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1]
        assert r.ids_crc32 == zlib.crc32(ids[: r.n_tokens].astype("<u4").tobytes())
        for a, b, doc, row, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_rows, r.doc_starts, strict=False):
            texts[doc, row][start] = ids[a:b]
    found = Counter((doc, tuple(np.concatenate([x[k] for k in sorted(x)]).tolist())) for (doc, _), x in texts.items())
    expected = Counter((i, (*library.encode(t or "", add_special_tokens=False).ids, 0)) for i, t, *_ in messy_rows)
    assert found == expected


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80))
def test_best_fit(lengths):
    bins = token_blocks.best_fit(lengths, 20)
    free, expected = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = [x for x in range(len(free)) if free[x] >= lengths[i]]
        if room:
            x = min(room, key=lambda x: free[x])
            free[x] -= lengths[i]
        else:
            free.append(20 - lengths[i])
    assert sorted(20 - sum(lengths[i] for i in b) for b in bins) == sorted(free)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))


@pytest.mark.parametrize("shards", [1, 4, 24, 200])
def test_shards_are_even_and_hold_the_mixture(messy, messy_rows, shards):
    rows = sharding.interleave(messy, shards, rows_per_bucket=7).collect()
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in rows) == Counter(
        (i, brute.crc(t), len((t or "").encode()) + 8) for i, t, *_ in messy_rows)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    for source, n in Counter(x[3] for x in messy_rows).items():
        for members in by.values():
            assert abs(sum(r.stratum == source for r in members) - n * len(members) / len(rows)) <= 3


def test_shards_against_a_sort(messy, messy_rows):
    strata = defaultdict(list)
    for doc_id, text, _, source in messy_rows:
        key = "null" if doc_id is None else str(doc_id)
        digest = hashlib.md5(f"42/{key}/{brute.crc(text)}".encode()).hexdigest()
        strata["n" if source is None else f"v{source}"].append((digest, doc_id, len((text or "").encode()) + 8, brute.crc(text)))
    order = []
    for name, members in strata.items():
        for rank, (_, *row) in enumerate(sorted(members, key=lambda x: x[0])):
            order.append(((2 * rank + 1) / (2 * len(members)), name, row))
    order.sort(key=lambda x: x[:2])
    expected, used = Counter(), Counter()
    for at, (_, _, row) in enumerate(order):
        shard = at * 24 // len(order)
        expected[(*row, "rows", shard, used[shard], None)] += 1
        used[shard] += 1
    found = sharding.interleave(messy, 24, rows_per_bucket=9).drop("stratum").collect()
    assert Counter(tuple(r) for r in found) == expected


def test_sharding_stays_in_the_engine(messy, capsys):
    sharding.interleave(messy, 24).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_base_scores(messy, messy_rows):
    third = F.col("doc_id") % 3
    found = scoring.score(messy, third != 2, third == 2, shape=scoring.Shape(words=5, buckets=4, head=20)).collect()
    counts = Counter()
    for i, t, *_ in messy_rows:
        if i is not None and math.fmod(i, 3) != 2:
            counts.update([*brute.spaced_words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    expected = []
    for i, t, *_ in messy_rows:
        words = [*brute.spaced_words(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        expected.append((i, i is not None and math.fmod(i, 3) == 2, len(words), sum(counts[w] > 0 for w in words), total, round(base, 5)))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == Counter(expected)
    assert all(r.score < 0 for r in found)


def test_model_probabilities_add_up():
    shape = scoring.Shape(words=6, buckets=3, size=4)
    model = scoring.LogBilinear(shape, np.arange(10.0))
    one, two, total = model.tables()
    for v in range(10):
        for u in range(10):
            assert np.exp(one[v] + two[u] - total[v, u]).sum() == pytest.approx(1.0)


def test_model_learns_what_follows_what(spark):
    rng = random.Random(1)
    words = {"a": "bc", "b": "ca", "c": "ab"}

    def text():
        out = [rng.choice("abc")]
        for _ in range(60):
            out.append(words[out[-1]][rng.random() < 0.1])
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id long, text string").repartition(2)
    shape = scoring.Shape(words=3, buckets=2, epochs=30, batch=4, noise=16)
    held = F.col("doc_id") % 4 == 0
    sums = scoring.score(docs, ~held, held, shape=shape).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > 0.6 * sums[1]


def test_scoring_without_training_rows(messy, empty):
    rows = scoring.score(messy, F.lit(False), F.lit(True), shape=scoring.Shape(words=2, buckets=2)).collect()
    assert len(rows) == messy.count() and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)
    assert scoring.score(empty, F.lit(True), F.lit(False)).count() == 0


def phrases(text, reference):
    """Phrases of a text, each the longest that the reference has, or one symbol."""
    n = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in reference:
            end += 1
        n, at = n + 1, end
    return n


def test_cross_parsing_against_search():
    samples = {"x": ["banana bandana"], "y": ["indigo diamond"]}
    parser = language.CrossParser(samples, 1000)
    for text in ("bananadana", "diamond band", "qqq", "dig a banana"):
        found, sizes = language.symbols([text], parser.table)
        costs = parser.costs(found, sizes)[0]
        for k, name in enumerate(parser.languages):
            reference, _ = language.symbols([samples[name][0] + "\n"], parser.table)
            assert costs[k] == pytest.approx(phrases(found.tobytes(), reference.tobytes()) * parser.bits[k])


@small
def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(str(SMALL.parent / "sf0.01" / "documents.parquet"))
    third = language.fold(F.col("doc_id"), 4)
    found = language.identify(docs, language.fit(docs, third != 2), held_out=third == 2).filter("held_out")
    joined = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(joined) > 150 and sum(r.lang == r.lang_pred for r in joined) / len(joined) > 0.95
    assert all(0 <= r.score <= 1 for r in joined)


def test_language_of_messy_rows(messy, empty):
    parser = language.fit(messy, F.col("lang").isNotNull())
    found = {r.doc_id: r for r in language.identify(messy, parser, held_out=F.col("doc_id") == 5).collect()}
    assert found[2].lang_pred == found[3].lang_pred == found[4].lang_pred == found[12].lang_pred == "und"
    assert found[7].lang_pred == "en" and found[5].held_out and not found[None].held_out
    assert language.keep_languages(messy, parser).columns == messy.columns
    nothing = language.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language.identify(messy, nothing, held_out=F.lit(False)).collect()} == {"und"}
    assert language.identify(empty, parser, held_out=F.lit(False)).count() == 0


def test_languages_of_many_scripts(spark):
    """Every letter of a labelled script counts, within the basic plane and beyond; a script without a label goes."""
    import random

    rng = random.Random(4)
    scripts = {
        "de": range(97, 123), "el": range(0x3B1, 0x3CA), "ru": range(0x430, 0x450), "ar": range(0x628, 0x63B), "got": range(0x10330, 0x10341),
        "ja": [*range(0x3042, 0x3094), *range(0x4E00, 0x4EC8)], "zh": range(0x4E00, 0x5000), "ko": range(0xAC00, 0xAD90),
        "hy": range(0x561, 0x587), "ka": range(0x10D0, 0x10F1),
    }
    words = {k: ["".join(chr(rng.choice(x)) for _ in range(rng.randrange(2, 6))) for _ in range(150)] for k, x in scripts.items()}
    joint = {"ja": "", "zh": ""}

    def text(k, n):
        return joint.get(k, " ").join(rng.choice(words[k]) for _ in range(n))

    rows = [(100 * i + j, k if j < 12 and k != "ka" else None, text(k, rng.randrange(60, 90))) for i, k in enumerate(scripts) for j in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    parser = language.fit(docs, F.lit(True))
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, parser, held_out=F.lit(False)).collect()}
    names = list(scripts)
    wrong = {i: (names[i // 100], x) for i, x in found.items() if names[i // 100] not in (x, "ka")}
    assert not wrong
    kept = {r.doc_id for r in language.keep_languages(docs, parser).collect()}
    assert kept == {i for i, _, _ in rows if names[i // 100] != "ka"}


def test_copies_do_not_fill_the_sample(spark):
    """The text copied most has the lowest digest of its label, and is one row of the sample."""
    texts = [" ".join(f"{chr(97 + i)}{chr(97 + j)}{chr(97 + k)}" for k in range(20)) for i in range(6) for j in range(5)]
    first = spark.createDataFrame([(x,) for x in texts], "text string").orderBy(F.xxhash64("text")).first().text
    rows = [(i, "l", x) for i, x in enumerate(texts)] + [(100 + i, "l", first) for i in range(200)] + [(900, "m", "zz yy")]
    parser = language.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"), F.lit(True))
    found, sizes = language.symbols([x.split(" ")[0] for x in texts], parser.table)
    phrases = parser.costs(found, sizes)[:, 0] / parser.bits[0]
    assert phrases.round().tolist() == [1] * len(texts)


def test_shares_of_a_sample():
    found = np.arange(1, 31, dtype=np.uint8)
    sizes = np.array([3, 20, 7])
    assert language.shared_out(found, sizes, 30).tolist() == found.tolist()
    assert language.shared_out(found, sizes, 13, 1).tolist() == [1, 2, 3, 4, 5, 6, 7, 0, 24, 25, 26, 27, 0]
    assert language.shared_out(found, sizes, 13, 8).tolist() == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 0, 24, 0]
    assert language.shared_out(found, sizes, 2, 8).tolist() == [1, 0]


def test_rows_of_transitions_are_interlaced():
    rng = np.random.default_rng(2)
    for width in (3, 40, 5000):
        rows = [dict.fromkeys(rng.integers(0, width, rng.choice([0, 1, 1, 1, 2, 3, 30])).tolist(), i) for i in range(600)]
        rows[0] = dict.fromkeys(range(width), 0)
        entries, places = language.interlaced(rows)
        assert len({*places.tolist()}) == len(rows) and len(entries) < 6 * width + 3 * sum(map(len, rows)) + len(rows)
        for i, (row, place) in enumerate(zip(rows, places.tolist(), strict=True)):
            mine = {int(c) for c in np.flatnonzero(entries[place : place + width, 0] == place)}
            assert mine == {*row} and all(entries[place + c, 1] == i for c in row)


def vectors_expected(rows, cosine):
    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    groups, links = brute.Groups(len(rows)), [0] * len(rows)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if label is not None and good(v) else None for _, v, label in rows]
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                groups.join(i, j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (key, *_) in enumerate(rows):
        if key is not None:
            least[groups.top(i)] = min(least.get(groups.top(i), key), key)
    return Counter((key, links[i], least.get(groups.top(i)), key is not None and least.get(groups.top(i)) == key) for i, (key, *_) in enumerate(rows))


@pytest.mark.parametrize("cell", [5, 4096])
def test_near_vectors(spark, cell):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(150):
        v = centres[i % 6] + rng.normal(scale=0.12, size=8)
        rows.append((i, v.astype(np.float32).tolist(), int(i % 2)))
    v = rows[10][1]
    rows += [(200, v, 0), (200, v, 0), (201, [2 * x for x in v], 0), (None, v, 0), (202, v, None), (203, None, 0), (204, [0.0] * 8, 0),
             (205, [float("nan")] + v[1:], 0), (206, [None] + v[1:], 0), (207, [float("inf")] + v[1:], 0), (208, [], 0), (209, v[:4], 0)]
    schema = "vec_id long, embedding array<float>, label int"
    table = spark.createDataFrame(rows, schema).withColumn("point", F.lit(1)).withColumn("cell", F.lit(1)).repartition(2)
    found = near_vectors.near_vectors(table, cosine=0.95, cell=cell).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == vectors_expected(rows, 0.95)
    assert near_vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_empty_tables(empty):
    assert packing.pack(empty).count() == 0
    assert token_blocks.token_blocks(empty).count() == 0
    assert sharding.interleave(empty, 24).count() == 0
