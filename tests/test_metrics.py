import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalloom.operators import metrics as M
from evalloom.operators import ranks


def test_pass_rate_ignores_missing_ratings_and_old_dates(spark):
    log = spark.createDataFrame(
        [("2024-01-30", "yes"), ("2024-01-31", "yes"), ("2024-01-31", "no"), ("2024-01-31", None), ("2024-01-31", "maybe")],
        "d string, rating string",
    ).select(F.to_date("d").alias("date"), "rating")
    as_of = F.lit(dt.datetime(2024, 1, 31, 12))
    # Midnight of the 30th is more than a day before noon of the 31st.
    assert [(str(r.date), r.avg_pass_rate) for r in M.pass_rate(log, as_of).collect()] == [("2024-01-31", 0.5)]
    assert M.pass_rate_alerts(M.pass_rate(log, as_of), 0.6).count() == 1
    assert M.pass_rate_alerts(M.pass_rate(log, as_of), 0.5).count() == 0


def test_dedup_keeps_the_first_by_order(spark):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "id string, n int, v string")
    once = M.dedup_first(rows, "id", F.col("n"))
    assert sorted(tuple(r) for r in once.collect()) == [("a", 1, "x"), ("b", 1, "z")]
    assert sorted(tuple(r) for r in M.dedup_first(once, "id", F.col("n")).collect()) == [("a", 1, "x"), ("b", 1, "z")]


@pytest.mark.parametrize("counters", [65_536, 1])
def test_exact_percentiles_equal_numpy(spark, counters, monkeypatch):
    monkeypatch.setattr(ranks, "COUNTERS", counters)  # 1: every level is gone through
    rng = random.Random(3)
    groups = {
        "skewed": [round(rng.expovariate(0.1), 2) for _ in range(400)],
        "ties": [5.0] * 50 + [-7.5] * 3,
        "single": [1.25],
        "pair": [-2.0, 9.0],
        "outlier": [float(i) / 1e6 for i in range(300)] + [1e300],
        "spread": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-320, 308) for _ in range(200)] + [0.0, -0.0, 5e-324, -5e-324],
        None: [float(i) for i in range(9)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("ties", None), ("empty", None)]
    table = spark.createDataFrame(rows, "g string, v double")
    wanted = {"lo": 0.0, "p37": 0.37, "p50": 0.5, "p95": 0.95, "hi": 1.0}
    found = {r.g: r for r in M.exact_percentiles(table, ["g"], "v", wanted).collect()}
    assert set(found) == set(groups)
    for group, values in groups.items():
        for name, p in wanted.items():
            assert found[group][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_keys_keep_the_order(spark):
    rng = random.Random(1)
    values = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-323, 308) for _ in range(3000)]
    values += [s * 2.0**e * f for s in (-1, 1) for e in range(-1074, 1024, 7) for f in (1.0, 1 - 2**-53, 1 + 2**-52)]
    values += [0.0, float("inf"), float("-inf"), 1.7976931348623157e308]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    rows = sorted(table.select("v", ranks.ordered_key(table, "v").alias("k")).collect(), key=lambda r: (r.v, r.k))
    assert all(a.k <= b.k for a, b in zip(rows, rows[1:], strict=False))
    assert len({r.k for r in rows}) > 0.8 * len({r.v for r in rows})


def test_no_window_sees_more_than_the_counters_of_a_cell(spark):
    """Random 64-bit ids, more than one level can tell apart, and one scan of the rows."""
    table = spark.range(200_000).select(F.xxhash64("id").alias("v"))
    ids = sorted(r.v for r in table.collect())
    row = M.exact_percentiles(table, [], "v", {"p50": 0.5}).first()
    assert row.p50 == pytest.approx((ids[99_999] + ids[100_000]) / 2, rel=1e-9)


def test_exact_percentiles_without_groups(spark):
    table = spark.range(101).select(F.col("id").cast("double").alias("v"))
    row = M.exact_percentiles(table, [], "v", {"p50": 0.5, "p90": 0.9}).first()
    assert (row.p50, row.p90) == (50.0, 90.0)


def test_scorecard_sketches_are_close_to_exact(spark):
    runs = spark.range(2000).select(
        F.lit("r").alias("run_id"), F.lit("yes").alias("rating"), F.lit(1).alias("tokens"),
        (F.col("id") % 997).cast("double").alias("latency_ms"),
    )
    exact = M.run_scorecard(runs, exact=True).first()
    sketch = M.run_scorecard(runs).first()
    assert exact.tokens == sketch.tokens == 2000
    assert sketch.p50_latency_ms == pytest.approx(exact.p50_latency_ms, abs=2)
    assert sketch.p95_latency_ms == pytest.approx(exact.p95_latency_ms, abs=2)


def test_rolling_rate_reaches_back_whole_hours(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=h, minutes=5), "yes" if h else "no") for h in (0, 23, 24)]
    rows.append((start + dt.timedelta(hours=24, minutes=6), None))
    log = spark.createDataFrame(rows, "ts timestamp, rating string")
    found = {r.hour: (r.judged, r.pass_rate) for r in M.rolling_pass_rate(log, 1).collect()}
    assert found[start + dt.timedelta(hours=23)] == (2, 0.5)
    assert found[start + dt.timedelta(hours=24)] == (2, 1.0)


def test_root_causes_blame_the_first_failure(spark):
    judged = spark.createDataFrame([("no", "no"), ("yes", "no"), ("yes", "no"), ("yes", "yes"), (None, "no")], "a string, b string")
    found = [(r.root_cause, r.failures, r.place) for r in M.root_causes(judged, ["a", "b"]).orderBy("place").collect()]
    assert found == [("b", 3, 1), ("a", 1, 2)]


def test_top_counts_breaks_ties_by_value(spark):
    words = spark.createDataFrame([("b a",), ("B c",)], "t string")
    assert [tuple(r) for r in M.word_counts(words, "t", 2).collect()] == [("b", 2), ("a", 1)]


def test_review_progress_keeps_null(spark):
    evals = spark.createDataFrame([("DRAFT",), (None,), (None,)], "review_status string")
    assert {r.review_status: r.evals for r in M.review_progress(evals).collect()} == {"DRAFT": 1, None: 2}


def test_profile_sketch(spark):
    log = spark.range(100).select(F.lit("g").alias("g"), (F.col("id") % 10).alias("u"), "id")
    row = M.profile(log, ["g"], "u", "id").first()
    assert (row.rows, row.users) == (100, 10)
