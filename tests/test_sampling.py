import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from evalloom.operators import ranks
from evalloom.operators import sampling as S


def test_hash_sample_is_the_md5_rule(spark):
    ids = spark.range(2000)
    kept = {r.id for r in S.hash_sample(ids, 0.3, "id", 7).collect()}
    rule = {i for i in range(2000) if int(hashlib.md5(f"7:{i}".encode()).hexdigest()[:8], 16) < 0.3 * 2**32}
    assert kept == rule
    assert S.hash_sample(ids, 0.0, "id").count() == 0
    assert S.hash_sample(ids, 1.0, "id").count() == 2000
    assert 400 < S.bernoulli_sample(ids, 0.3, 1).count() < 800


@pytest.mark.parametrize("salts", [1, 7])
def test_cap_per_hour(spark, salts):
    start = dt.datetime(2024, 1, 1)
    # One hour holds most of the requests, one holds fewer than the cap.
    rows = [(f"hot-{i}", start + dt.timedelta(seconds=i)) for i in range(500)]
    rows += [(f"cold-{i}", start + dt.timedelta(hours=2, seconds=i)) for i in range(3)]
    log = spark.createDataFrame(rows, "request_id string, timestamp timestamp")
    kept = {r.request_id for r in S.cap_per_hour(log, 10, salts=salts).collect()}
    hot = sorted((hashlib.md5(f"0:hot-{i}".encode()).hexdigest(), f"hot-{i}") for i in range(500))[:10]
    assert kept == {name for _, name in hot} | {f"cold-{i}" for i in range(3)}


def test_prefixes(spark):
    rows = spark.createDataFrame([(i * 3 % 10,) for i in range(10)], "corpus_pos int")
    assert [r.corpus_pos for r in S.first_n(rows, 3).collect()] == [0, 1, 2]
    assert S.first_n(rows, 50).count() == 10
    some = [r.corpus_pos for r in S.random_n(rows, 4, "corpus_pos", 1).collect()]
    assert some == [r.corpus_pos for r in S.random_n(rows.repartition(3), 4, "corpus_pos", 1).collect()]


@pytest.mark.parametrize("counters", [65_536, 1])
def test_position_at_rank_over_gaps(spark, counters, monkeypatch):
    monkeypatch.setattr(ranks, "COUNTERS", counters)
    positions = [0, 3, 4, 17, 18, 19, 400]
    table = spark.createDataFrame([(p,) for p in positions], "corpus_pos bigint")
    asked = [0, 1, 3, 4, 7, 8]
    found = spark.range(1).select(
        *[S.position_at_rank(table, lambda total, r=r: F.lit(r)).alias(f"r{r}") for r in asked],
        S.position_at_rank(table, lambda total: total - 1).alias("last"),
    ).first()
    assert tuple(found) == (None, 0, 4, 17, 400, None, 19)


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_segmented_lag_equals_lag(spark, width):
    rows = [("hot", n, f"v{n}" if n % 4 else None) for n in (0, 1, 2, 5, 6, 11, 12, 30, 31)] + [("x", 4, "only")]
    table = spark.createDataFrame(rows, "k string, n int, v string")
    found = {(r.k, r.n): (r.prev_v, r.prev_n) for r in S.segmented_lag(table, "k", "n", ["v", "n"], width=width).collect()}
    previous = {}
    for k, n, v in rows:
        assert found[(k, n)] == previous.get(k, (None, None))
        previous[k] = (v, n)


def test_top_per_group_is_exact_for_a_hot_group(spark):
    table = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("g"), "id", F.pmod(F.hash("id"), F.lit(50)).alias("s")
    )
    best = S.top_per_group(table, ["g"], [F.desc("s"), F.col("id")], 5, F.col("id"), 8)
    rows = table.collect()
    for group in ("rare", "hot"):
        wanted = sorted(((-r.s, r.id) for r in rows if r.g == group))[:5]
        assert sorted((-r.s, r.id) for r in best.collect() if r.g == group) == wanted


def test_one_outlier_leaves_the_rest_apart(spark):
    """200,000 dense positions and one far away: the second level tells them apart again."""
    table = spark.range(200_000).select(F.when(F.col("id") == 7, 9 * 10**18).otherwise(F.col("id")).alias("corpus_pos"))
    found = [spark.range(1).select(S.position_at_rank(table, lambda total, n=n: F.lit(n)).alias("p")).first().p for n in (7, 8, 199_999, 200_000)]
    assert found == [6, 8, 199_999, 9 * 10**18]


def test_rank_among_sparse_positions(spark):
    import random

    rng = random.Random(9)
    ids = sorted({rng.randrange(-(2**63), 2**63) for _ in range(500)} | {2**63 - 1, -(2**63)})
    table = spark.createDataFrame([(i,) for i in ids], "corpus_pos bigint")
    for n in (1, 2, 250, len(ids)):
        found = spark.range(1).select(S.position_at_rank(table, lambda total: F.lit(n)).alias("p")).first().p
        assert found == ids[n - 1]
