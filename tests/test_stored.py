"""Stored tables: evolving appends, merges that touch few partitions, batches merged once."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from evalloom import sources as S
from evalloom import streaming as ST
from evalloom.operators.joins import merge_matched, merge_set

D = [datetime.date(2024, 1, d) for d in range(1, 5)]


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(i, D[i % 4], "old") for i in range(40)] + [(100, None, "old")]
    spark.createDataFrame(rows, "id long, date date, state string").write.partitionBy("date").parquet(path)
    return path


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def set_all(rows, new):
    return merge_matched(rows, new, "id")


@pytest.mark.parametrize("named", [True, False])
def test_untouched_files_stay(spark, log, named):
    before = files(log)
    updates = spark.createDataFrame([(1, D[1], "new", 7), (5, D[1], None, 8), (999, D[2], "none", 9)], "id long, date date, state string, score int")
    touched = S.merge_stored(log, updates if named else updates.drop("date"), "id", set_all)
    assert touched == [D[1]]
    after = files(log)
    kept = {k: v for k, v in before.items() if "2024-01-02" not in k}
    assert kept.items() <= after.items() and not {k for k in before if "2024-01-02" in k} & set(after)
    found = {r.id: (r.date, r.state, r.score) for r in S.read_stored(spark, log).collect()}
    expected = {i: (D[i % 4], "old", None) for i in range(40)} | {100: (None, "old", None), 1: (D[1], "new", 7), 5: (D[1], None, 8)}
    assert found == expected


def test_nothing_matches_and_null_partitions(spark, log):
    before = files(log)
    assert S.merge_stored(log, spark.createDataFrame([(999, "x")], "id long, state string"), "id", set_all) == []
    assert files(log) == before
    assert S.merge_stored(log, spark.createDataFrame([(100, "x")], "id long, state string"), "id", set_all) == [None]
    assert S.read_stored(spark, log).filter("id = 100").first().state == "x"
    # Updates that name another partition than their row lies in match nothing.
    assert S.merge_stored(log, spark.createDataFrame([(1, D[2], "y")], "id long, date date, state string"), "id", set_all) == []


def test_append_evolves_and_keeps_types(spark, tmp_path):
    path = str(tmp_path / "t")
    S.append_stored(spark.createDataFrame([(1, "a")], "id long, a string"), path, partition_by="a")
    S.append_stored(spark.createDataFrame([(2, "b", 0.5)], "id long, a string, b double"), path, partition_by="a")
    S.append_stored(spark.createDataFrame([(3.5,)], "b double"), path + "2")
    assert {(r.id, r.a, r.b) for r in S.read_stored(spark, path).collect()} == {(1, "a", None), (2, "b", 0.5)}
    before = files(path)
    with pytest.raises(ValueError, match="another type.*: id"):
        S.append_stored(spark.createDataFrame([("x", "a")], "id string, a string"), path, partition_by="a")
    assert files(path) == before


def test_a_batch_is_merged_once(spark, log, tmp_path):
    ledger = str(tmp_path / "ledger")
    batch = spark.createDataFrame([(1,), (2,), (3,)], "id long")

    def evaluate(rows):
        return rows.withColumn("state", F.lit("judged"))

    def count(rows, new):
        rows = rows if "times" in rows.columns else rows.withColumn("times", F.lit(0))
        return merge_set(rows, new, "id", "times", F.coalesce("times", F.lit(0)) + 1)

    def run(rows, number):
        return ST.merge_batch(rows, number, evaluate, log, ledger, "id", merge=count)

    # The job was lost after it had merged some rows and before it was noted.
    run(batch.filter("id < 3"), 4)
    noted = Path(ledger, "batch_id=4", "_SUCCESS")
    noted.unlink()
    assert run(batch, 4) == [D[3]]
    assert run(batch, 4) == [] and [r.batch_id for r in S.Ledger(spark, ledger).read().collect()] == [4]
    assert run(batch.filter("id = 1"), 5) == [D[1]]
    found = {r.id: (r.state, r.times, r.merged_batch) for r in S.read_stored(spark, log).filter("id < 4").collect()}
    assert found == {0: ("old", None, None), 1: ("judged", 2, 5), 2: ("judged", 1, 4), 3: ("judged", 1, 4)}
