"""Operators on texts against their plain restatements, over nulls, ties, copies, long texts and clashing names."""

import hashlib
from collections import Counter

import brute
import pytest

from evalloom.llm import decontamination, licences, near_text, suffix_dedup
from evalloom.llm.bwt import least_of_equal

import numpy as np


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(found, expected):
    assert Counter(tuple(r) for r in found) == Counter(expected)


@pytest.mark.parametrize("crowd", [2, 8])
def test_jaccard_join(messy, crowd):
    found = near_text.near_text(messy, crowd=crowd, entries=500).select("doc_id", "n_shingles", "component_id")
    same(found.collect(), brute.near_text(pairs(messy)))


def test_jaccard_join_in_families_of_distant_copies(spark):
    """Many copies of one text, each far from most others: crowded signatures and chains of links."""
    import random

    rng = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = near_text.near_text(docs, crowd=2).select("doc_id", "n_shingles", "component_id")
    same(found.collect(), brute.near_text(rows))


def test_jaccard_join_looks_at_few_pairs_of_a_family(spark, monkeypatch):
    """Members that stray from their family are held against its cleanest one, not against each other."""
    import random

    rng = random.Random(4)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.sample(range(200), rng.choice([1, 2, 3, 9, 10, 11])):
            words[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    looked = []
    for name in ("_cell_pairs", "_group_pairs"):
        def counted(*args, f=getattr(near_text, name)):
            found = f(*args)
            looked.append(found.count())
            return found

        monkeypatch.setattr(near_text, name, counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = near_text.near_text(docs, crowd=2).select("doc_id", "n_shingles", "component_id").collect()
    same(found, brute.near_text(rows))
    assert len({r.component_id for r in found}) > 20
    assert looked and sum(looked) < 2 * len(rows)


def test_jaccard_join_at_the_lowest_threshold(spark):
    """Two of three shingles are similar by 66.7: that threshold and lower ones are refused, the next one is exact."""
    words = [f"w{i}" for i in range(20)]
    rows = [(n * 20 + k, " ".join(words[k : k + n])) for n in range(1, 17) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (0, 33, 66, 101):
        with pytest.raises(ValueError):
            near_text.near_text(docs, percent=percent)
    same(near_text.near_text(docs, percent=67).select("doc_id", "n_shingles", "component_id").collect(), brute.near_text(rows, 67))


def test_jaccard_join_keeps_one_row_of_each(messy):
    kept = near_text.one_of_each(messy)
    assert kept.columns == messy.columns
    components = brute.near_text(pairs(messy))
    alone = sum(1 for _, n, c in components if n == 0)
    groups = {c for _, n, c in components if n}
    assert kept.count() == alone + len(groups)


def test_repeated_strings(messy):
    found = suffix_dedup.repeats(messy, bucket_bytes=20_000).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    same(found.collect(), brute.repeats(pairs(messy)))


def test_repeated_strings_of_other_lengths(messy):
    found = suffix_dedup.repeats(messy, length=12, gram=5).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    same(found.collect(), brute.repeats(pairs(messy), 12))


def test_repeated_strings_of_an_anchor_with_many_pieces(spark, monkeypatch):
    """A passage that all documents share, with different surroundings: no task sorts more than the bound at once."""
    import random

    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(30))
    rows = []
    for i in range(1500):
        own = [" ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 8))) for _ in range(2)]
        rows.append((i, f"{own[0]} {passage} {own[1]}" + (f" {passage[:90]}" if i % 7 == 0 else "")))
    rows += [(5000 + i, rows[3 * i][1]) for i in range(40)] + [(None, rows[0][1]), (6000, "ab " * 4000), (6001, "ab " * 3000 + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    real, limit = suffix_dedup.least_of_equal, 40_000

    def bounded(strings, values, length):
        if sum(map(len, strings)) > limit:
            raise ValueError("one task sorts too much")
        return real(strings, values, length)

    monkeypatch.setattr(suffix_dedup, "least_of_equal", bounded)
    monkeypatch.setattr(suffix_dedup, "SORTED_BYTES", 20_000)
    if hasattr(suffix_dedup, "ANCHOR_BYTES"):
        found = suffix_dedup.repeats(docs, bucket_bytes=20_000, anchor_bytes=20_000, chunk_bytes=30_000)
    else:
        found = suffix_dedup.repeats(docs, bucket_bytes=20_000)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    same(found.select(*columns).collect(), brute.repeats(rows))
    for options in ({"anchor_bytes": 0}, {"anchor_bytes": 0, "bucket_bytes": 20_000}):
        same(suffix_dedup.repeats(docs, **options).select(*columns).collect(), brute.repeats(rows))


def test_repeated_strings_in_chunks_cut_by_bytes(messy):
    found = suffix_dedup.repeats(messy, chunk_bytes=500).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    same(found.collect(), brute.repeats(pairs(messy)))


def test_texts_without_repeats(messy):
    kept = suffix_dedup.without_repeats(messy)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    found = {r.doc_id: r for r in kept.filter("doc_id >= 60").collect()}
    for doc_id, _, removed, _, digest in brute.repeats(pairs(messy)):
        if removed and doc_id in found:
            assert hashlib.sha256(found[doc_id].text.encode()).hexdigest() == digest


def test_texts_without_repeats_meet_no_second_time(spark, messy):
    """All columns come back with the texts: nothing is staged and no join deals the documents once more."""
    from pathlib import Path
    from urllib.parse import urlparse

    from evalloom.session import shared_folder

    folder = Path(urlparse(shared_folder(spark)).path)
    before = {x.name for x in folder.glob("*-*")}
    kept = suffix_dedup.without_repeats(messy)
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.dtypes == messy.dtypes
    assert {x.name for x in folder.glob("*-*")} == before
    others = [x for x in messy.columns if x != "text"]
    same(kept.select(*others).collect(), [tuple(r) for r in messy.select(*others).collect()])
    assert kept.filter("text is null").count() == messy.filter("text is null").count() > 0
    assert near_text.one_of_each(messy).columns == messy.columns
    assert {x.name.split("-")[0] for x in folder.glob("*-*") if x.name not in before} == {"gone"}


def test_windows_of_one_anchor(monkeypatch):
    """Equal windows have one anchor, also where grams repeat and where long texts are cut."""
    import random

    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(150))) for _ in range(60)] + [b"ab" * 300, b"a" * 700, b"abc" * 90 + b"ab" * 90]
    texts += [texts[3 * i][5:] + texts[i] for i in range(20)]
    monkeypatch.setattr(suffix_dedup._sections, "__defaults__", (200,))
    for length, gram in ((50, 20), (12, 5), (7, 9), (3, 2)):
        runs = suffix_dedup.Runs(texts, length, gram, 3)
        known, seen = {}, []
        for t, start, count, key in zip(*(x.tolist() for x in (runs.text, runs.start, runs.count, runs.key)), strict=True):
            for place in range(start, start + count):
                seen.append((t, place))
                assert known.setdefault(texts[t][place : place + length], key) == key
        assert sorted(seen) == [(t, place) for t, x in enumerate(texts) for place in range(len(x) - length + 1)]


def test_a_shared_gram_is_no_shared_anchor():
    """30 bytes in common are no window in common: nothing of such texts meets."""
    import random

    rng = random.Random(6)
    own = [[bytes(rng.choices(range(97, 123), k=60)) for _ in range(200)] for _ in range(5)]
    left, right = (suffix_dedup.Runs([x + common[:30] + y for x, common, y in zip(own[i], own[4], own[i + 1], strict=True)], 50, 20, 3) for i in (0, 2))
    assert not set(left.key.tolist()) & set(right.key.tolist())


def test_rows_of_a_chunk():
    """Tasks exchange a row for each chunk and bucket, so neither a chunk nor a bucket may be small."""
    import pyarrow as pa

    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(1000 * i, 1000 * i + 1000), pa.int64()), pa.array([b"x" * 2000] * 1000, pa.binary())], names=["row", "text"])
        for i in range(20)
    ]
    sizes = [table.num_rows for _, table in suffix_dedup._chunks(iter(batches), suffix_dedup.CHUNK_BYTES)]
    assert sum(sizes) == 20_000 and len(sizes) <= 5
    text = 10 << 30
    assert text / suffix_dedup.CHUNK_BYTES * 2 * text / suffix_dedup.BUCKET_BYTES * (1 + suffix_dedup.SPREAD) < 5e6


def test_least_of_equal_windows():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(97, 100, rng.integers(6, 60)).astype(np.uint8)) for _ in range(80)]
    values = rng.permutation(80)
    for length in (1, 3, 6):
        least = {}
        for s, v in zip(strings, values, strict=True):
            for p in range(len(s) - length + 1):
                least[s[p : p + length]] = min(least.get(s[p : p + length], 99), v)
        found = least_of_equal(strings, values, length)
        for s, x in zip(strings, found, strict=True):
            assert x.tolist() == [least[s[p : p + length]] for p in range(len(s) - length + 1)]


@pytest.fixture
def items(messy_rows, spark):
    passage = " ".join(messy_rows[70][1].split(" ")[42:60])
    rows = [(1, passage), (1, passage), (2, passage[:40]), (3, "one"), (4, ""), (5, None), (None, "a b c"), (12, "été NAÏVE"), (7, "long words long")]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1, 10_000])
def test_benchmark_hits(messy, items, block):
    found = decontamination.benchmark_hits(messy, items[1], block_bytes=block)
    same(found.drop("hit_from", "hit_to").collect(), brute.benchmark_hits(pairs(messy), items[0]))
    clean = decontamination.decontaminate(messy, items[1], block_bytes=block)
    assert clean.columns == messy.columns
    assert clean.count() == sum(1 for x in brute.benchmark_hits(pairs(messy), items[0]) if not x[-1])


def test_longest_matches(messy, items):
    found = {(r.item, r.start): r.length for r in decontamination.longest_matches(messy, items[1]).collect()}
    texts = [brute.plain_words(t) for _, t in pairs(messy)]
    have = set()
    for words in texts:
        if len(words) < 5000:
            have |= {tuple(words[p:q]) for p in range(len(words)) for q in range(p + 1, min(p + 19, len(words)) + 1)}
    for item, text in items[0]:
        words = brute.plain_words(text)
        for p in range(len(words)):
            best = max((n for n in range(1, len(words) - p + 1) if tuple(words[p : p + n]) in have), default=0)
            if best and item not in (7, None):
                assert found[str(item), p] >= best


def test_no_benchmark(spark, messy):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.benchmark_hits(messy, none).filter("contaminated").count() == 0
    assert decontamination.decontaminate(messy, none).count() == messy.count()


@pytest.mark.parametrize(("expression", "postfix", "names", "level"), [
    ("MIT", ["MIT"], {"mit"}, 0), ("MIT OR GPL-2.0-only", ["MIT", "GPL-2.0-only", "or"], {"mit", "gpl-2.0-only"}, 0),
    ("MIT AND GPL-2.0-only", ["MIT", "GPL-2.0-only", "and"], {"mit", "gpl-2.0-only"}, 2),
    ("MIT or Apache-2.0 and GPL-3.0", ["MIT", "Apache-2.0", "GPL-3.0", "and", "or"], {"mit", "apache-2.0", "gpl-3.0"}, 0),
    ("(MIT or Apache-2.0) and GPL-3.0", ["MIT", "Apache-2.0", "or", "GPL-3.0", "and"], {"mit", "apache-2.0", "gpl-3.0"}, 2),
    ("GPL-2.0 WITH Classpath-exception-2.0", ["GPL-2.0", "Classpath-exception-2.0", "with"], {"gpl-2.0"}, 1),
])
def test_licence_expressions(expression, postfix, names, level):
    assert licences.parse(expression) == postfix
    assert licences.evaluate(postfix) == (names, level)


@pytest.mark.parametrize("expression", ["", "MIT OR", "OR MIT", "(MIT", "MIT)", "MIT GPL-2.0", "()", "MIT (GPL-2.0)"])
def test_malformed_licence_expressions(expression):
    assert licences.parse(expression) is None


@pytest.mark.parametrize(("written", "postfix"), [
    ("MIT This file is part of", ["MIT"]), ("MIT. Other text", ["MIT"]), ("MIT and all rights", ["MIT"]), ("Foo-1.0 is ours", ["Foo-1.0"]),
    ("MIT OR Apache-2.0 see the notice", ["MIT", "Apache-2.0", "or"]), ("(MIT OR GPL-2.0) AND BSD-3-Clause or not this", ["MIT", "GPL-2.0", "or", "BSD-3-Clause", "and"]),
    ("GPL-2.0 WITH Classpath-exception-2.0 The end", ["GPL-2.0", "Classpath-exception-2.0", "with"]), ("(MIT", None), ("and MIT", None),
    ("", None), (") MIT", None), ("MIT ) more", ["MIT"]), ("(MIT OR GPL-2.0 text", None), ("MIT OR (Apache-2.0 more", ["MIT"]),
])
def test_prose_behind_a_tag(written, postfix):
    assert licences.parse_start(written) == postfix


def test_licence_scan(spark, messy):
    texts = [
        (1, "Released under the MIT License. the mit-license mit license"), (2, None), (3, ""), (4, "mitlicense mit licenses"),
        (5, "GNU Lesser General Public License"), (6, "// SPDX-License-Identifier: MIT OR Apache-2.0\ncode"),
        (7, "apache license general public license " * 2000), (None, "Apache\nLicense"), (8, "SPDX-License-Identifier: (MIT"),
    ]
    rows = licences.licence_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_base, by[1].first_word, by[1].last_word, by[1].base_labels) == (3, 3, 8, "mit")
    assert (by[2].n_words, by[2].n_base, by[2].first_word, by[2].labels, by[2].score) == (0, 0, None, "", 0.0)
    assert by[4].n_base == 0 and by[5].base_labels == "gpl" and by[5].labels == "gpl,lgpl"
    assert by[6].labels == "apache-2.0,mit" and by[6].strictness == 0 and by[6].expressions == ["MIT Apache-2.0 or"]
    assert by[7].n_base == 4000 and by[7].last_word == 5 * 2000 - 3 and by[7].base_labels == "apache,gpl"
    assert by[None].base_labels == "apache" and by[8].labels == "" and all(0 <= r.score <= 1 for r in rows)
    assert licences.licence_scan(messy).count() == messy.count()


def test_empty_tables(empty, spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert near_text.near_text(empty).count() == 0
    assert near_text.one_of_each(empty).count() == 0
    assert suffix_dedup.repeats(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0
    assert decontamination.benchmark_hits(empty, items).count() == 0
    assert licences.licence_scan(empty).count() == 0
