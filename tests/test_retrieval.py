"""Retrieval against a sequential restatement: score every document, sort, spend the budget."""

import random

import pytest

from evalloom import constants as K
from evalloom.operators import retrieval as R
from evalloom.operators.postings import build_index
from evalloom.session import kept_path, scratch_path

SCHEMA_DOCS = "corpus_pos bigint, content string"
SCHEMA_QUERIES = "query_id bigint, keywords array<string>"


def scores(keywords, docs):
    return [(pos, sum(k.lower() in text.lower() for k in keywords), text) for pos, text in docs]


def sequential(keywords, docs, budget, min_score=0):
    if not keywords:
        return []
    ranked = sorted(scores(keywords, docs), key=lambda d: (-d[1], d[0]))
    left, kept = budget, []
    for rank, (pos, score, text) in enumerate((d for d in ranked if d[1] >= min_score), 1):
        kept.append((rank, pos, score, min(len(text), left)))
        if len(text) > left:
            break
        left -= len(text)
    return kept


def retrieve(spark, queries, docs, **options):
    table = spark.createDataFrame(docs, SCHEMA_DOCS)
    if options.get("scan_limit") == "index":
        options |= {"scan_limit": 64, "index": build_index(table, scratch_path(spark, "index"), buckets=5)}
    found = R.retrieve_context(spark.createDataFrame(queries, SCHEMA_QUERIES), table, **options)
    out = {query: [] for query, _ in queries}
    for row in sorted(found.collect()):
        out[row.query_id].append((row["rank"], row.corpus_pos, row.score, row.kept_chars))
    return out


DOCS = [(10, "alpha beta"), (20, ""), (30, "BETA gamma"), (40, "delta"), (50, "gamma delta beta"), (60, "")]
QUERIES = [
    (1, ["beta"]), (2, ["beta", "beta", "gamma"]), (3, []), (4, ["zzz"]), (5, ["elt"]), (6, ["", "gamma"]),
    (7, ["a b"]), (8, [" "]),
]


@pytest.mark.parametrize("scan_limit", [64, 0, "index"])
@pytest.mark.parametrize("budget", [0, 5, 20, 21, 1000])
def test_hand_cases(spark, budget, scan_limit):
    found = retrieve(spark, QUERIES, DOCS, budget=budget, scan_limit=scan_limit)
    for query, keywords in QUERIES:
        assert found[query] == sequential(keywords, DOCS, budget), (query, budget)


@pytest.mark.parametrize("seed", range(4))
def test_random_corpora(spark, seed):
    rng = random.Random(seed)
    words = ["spark", "Sparkle", "ark", "delta", "DELTA lake", "x", "", "é", "tab\tle", "  "]
    docs = [
        (pos * 7 % 101, " ".join(rng.choices(words, k=rng.randint(0, 6))) if rng.random() > 0.15 else "")
        for pos in range(40)
    ]
    pool = ["spark", "ark", "k d", "lake", "x", "", "É", "none", "b\tl", " ", "  ", "delta lake"]
    queries = [(q, rng.choices(pool, k=rng.randint(0, 4))) for q in range(8)]
    budget = rng.choice([0, 15, 60, 200, 5000])
    for scan_limit in (64, 0, "index"):
        found = retrieve(spark, queries, docs, budget=budget, scan_limit=scan_limit)
        for query, keywords in queries:
            assert found[query] == sequential(keywords, docs, budget), (query, keywords, scan_limit)


def test_matches_only(spark):
    positive = [(q, k) for q, k in QUERIES if "" not in k]
    found = retrieve(spark, positive, DOCS, budget=12, min_score=1)
    for query, keywords in positive:
        assert found[query] == sequential(keywords, DOCS, 12, min_score=1)


def test_kept_characters_fit_and_only_the_last_is_cut(spark):
    lengths = {pos: len(text) for pos, text in DOCS}
    for kept in retrieve(spark, QUERIES, DOCS, budget=17).values():
        assert sum(chars for *_, chars in kept) <= 17
        assert all(chars == lengths[pos] for _, pos, _, chars in kept[:-1])


@pytest.mark.parametrize("scan_limit", [64, 0])
def test_rank_keeps_unmatched_documents(spark, scan_limit):
    queries = spark.createDataFrame(QUERIES, SCHEMA_QUERIES)
    docs = spark.createDataFrame(DOCS, SCHEMA_DOCS)
    for k in (1, 3, 50):
        ranked = R.keyword_rank(queries, docs, k, scan_limit=scan_limit).collect()
        for query, keywords in QUERIES:
            best = sorted(scores(keywords, DOCS), key=lambda d: (-d[1], d[0]))[:k] if keywords else []
            found = sorted((r["rank"], r.corpus_pos, r.score) for r in ranked if r.query_id == query)
            assert found == [(n, pos, score) for n, (pos, score, _) in enumerate(best, 1)], (query, k)


def test_both_ways_of_matching_agree_on_many_keywords(spark):
    rng = random.Random(9)
    letters = "abcde "
    docs = [(n, "".join(rng.choices(letters, k=rng.randint(0, 60)))) for n in range(60)]
    queries = [(q, ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(3)]) for q in range(40)]
    q, d = spark.createDataFrame(queries, SCHEMA_QUERIES), spark.createDataFrame(docs, SCHEMA_DOCS)
    scan = sorted(R.keyword_matches(q, d, scan_limit=1000).select("query_id", "corpus_pos", "score").collect())
    vocabulary = sorted(R.keyword_matches(q, d, scan_limit=0).select("query_id", "corpus_pos", "score").collect())
    plain = sorted((query, pos, score) for query, ks in queries for pos, score, _ in scores(ks, docs) if score)
    assert [tuple(r) for r in scan] == [tuple(r) for r in vocabulary] == plain


def test_lengths_may_come_with_the_corpus(spark):
    docs = spark.createDataFrame([(pos, text, len(text)) for pos, text in DOCS], SCHEMA_DOCS + ", n_chars bigint")
    queries = spark.createDataFrame(QUERIES, SCHEMA_QUERIES)
    with_lengths = sorted(R.retrieve_context(queries, docs, budget=15).collect())
    assert with_lengths == sorted(R.retrieve_context(queries, docs.drop("n_chars"), budget=15).collect())


def test_salient_keywords(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, "the dog"), (3, "the cat")], SCHEMA_DOCS)
    queries = spark.createDataFrame([(1, "The cat or the dog, the DOG?"), (2, "nothing known")], "query_id int, text string")
    found = {r.query_id: r.keywords for r in R.salient_keywords(queries, docs, 2).collect()}
    assert found == {1: ["dog", "cat"], 2: []}
    stopped = R.salient_keywords(queries, docs, 2, stop_words=("dog",)).collect()
    assert {r.query_id: r.keywords for r in stopped} == {1: ["cat", "the"], 2: []}


def test_prompts(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA_DOCS)
    queries = spark.createDataFrame([(1, ["gamma"], "What?"), (2, [], "Why?")], SCHEMA_QUERIES + ", text string")
    kept = R.retrieve_context(queries.drop("text"), docs, budget=14)
    prompts = {r.query_id: r.prompt for r in R.build_prompts(queries, kept, docs).collect()}
    assert prompts[1] == K.PROMPT.format(context="BETA gamma\n\ngamm", user_query="What?")
    assert prompts[2] == K.PROMPT.format(context="", user_query="Why?")


def test_fused_ranks(spark):
    left = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "query_id int, doc int, rank int")
    right = spark.createDataFrame([(1, 6, 1), (1, 7, 2)], "query_id int, doc int, rank int")
    fused = {r.doc: (r["rank"], r.score) for r in R.fuse_ranks(left, right, 3, "doc").collect()}
    assert fused[6] == (1, round(1 / 62 + 1 / 61, 9))
    assert fused[5] == (2, round(1 / 61, 9)) and fused[7][0] == 3


def test_no_text_in_a_shuffle(spark, capsys):
    """Through the index a query set reads postings: no exchange, and no scan, has a text or its tokens."""
    docs = spark.createDataFrame(DOCS * 1, SCHEMA_DOCS)
    index = build_index(docs, scratch_path(spark, "index"), buckets=3)
    queries = spark.createDataFrame([(1, ["beta"]), (2, ["elt", "gam"])], SCHEMA_QUERIES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        R.retrieve_context(queries, docs, budget=20, index=index).explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" in plan and "content" not in plan and "tokens" not in plan
    assert "PartitionFilters" in plan and "bucket" in plan


def test_an_index_is_built_once_per_table(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame(DOCS, SCHEMA_DOCS).write.parquet(path)
    built = []
    first = kept_path(spark.read.parquet(path), "some-index", built.append)
    assert kept_path(spark.read.parquet(path), "some-index", built.append) == first and built == [first]
    spark.createDataFrame(DOCS[:2], SCHEMA_DOCS).write.mode("append").parquet(path)
    assert kept_path(spark.read.parquet(path), "some-index", built.append) != first
