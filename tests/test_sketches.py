"""Stored sketches against exact values, the judged cycle, table search and the places of a prompt."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from evalloom.operators import monitoring as MO
from evalloom.operators import sketches as SK
from evalloom.operators import traces as T
from evalloom.operators import udfs as U
from evalloom.sources import read_stored


def test_levels_from_stored_sketches_only(spark, tmp_path):
    """A thousand hours of rows: users within 5 %, percentiles within 2 % of the ranks; the total equals its parts."""
    log = spark.range(40_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 90).alias("ts"), (F.hash("id") % 3000).alias("user_id"),
        F.concat(F.lit("v"), F.col("id") % 2).alias("version"), F.pow(F.abs(F.hash(F.col("id") + 1)) % 1000, F.lit(2)).alias("latency_ms"),
    ).union(spark.createDataFrame([(dt.datetime(2024, 1, 1), None, "v9", None)], "ts timestamp, user_id int, version string, latency_ms double"))
    path = str(tmp_path / "sketches")
    SK.sketch_hours(log, ["version"]).write.parquet(path)
    stored = spark.read.parquet(path)
    for levels in (["version"], [F.to_date("hour").alias("day")], []):
        exact = log.withColumn("hour", F.date_trunc("hour", "ts")).groupBy(*levels).agg(
            F.count(F.lit(1)).alias("requests"), F.count_distinct("user_id").alias("users"), F.array_sort(F.collect_list("latency_ms")).alias("v"))
        found = {r[:-4]: r for r in SK.from_sketches(stored, levels, {"p50": 0.5, "p90": 0.9}).collect()}
        for row in exact.collect():
            near = found.pop(row[:-3])
            assert near.requests == row.requests and abs(near.users - row.users) <= 0.05 * row.users
            for value, p in ((near.p50, 0.5), (near.p90, 0.9)):
                if row.v:
                    assert sum(x < value for x in row.v) / len(row.v) - 0.02 <= p <= sum(x <= value for x in row.v) / len(row.v) + 0.02
                else:
                    assert value is None
        assert not found


def test_stored_cycle_equals_the_cycle_in_memory(spark, tmp_path):
    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i % 50), rng.choice([None, None, "to_process", "skipped", "run-1"]), f"q{i}") for i in range(300)]
    kind = "request_id int, ts timestamp, run_id string, request string"
    log = spark.createDataFrame(rows, kind).withColumn("date", F.to_date("ts"))
    heard = spark.createDataFrame([(i, start + dt.timedelta(hours=49)) for i in range(0, 300, 9)], "request_id int, ts timestamp")
    path = str(tmp_path / "log")
    log.write.partitionBy("date").parquet(path)
    as_of = F.lit(start + dt.timedelta(hours=50))

    def judge(df):
        return df.select("request_id", F.when(F.col("request_id") % 2 == 0, "yes").otherwise("no").alias("rating"))

    options = {"rate": 0.4, "days": 1, "cap": 2, "ts": "ts", "seed": 3}
    expected = MO.run_cycle(log, heard, as_of, judge, "run-2", **options)
    touched = MO.run_stored_cycle(path, heard, as_of, judge, "run-2", **options)
    assert len(touched) == 3
    columns = "request_id", "ts", "run_id", "request", "rating"
    found = read_stored(spark, path)
    assert sorted(map(repr, found.select(*columns).collect())) == sorted(map(repr, expected.select(*columns).collect()))
    # Nothing is left to do but what the cap held back, and a log without open rows is not touched.
    MO.run_stored_cycle(path, heard, as_of, judge, "run-3", **(options | {"cap": 10**6}))
    assert read_stored(spark, path).filter("run_id is null or run_id = 'to_process'").isEmpty()
    assert MO.run_stored_cycle(path, heard, as_of, judge, "run-4", **options) == []


def test_table_search_takes_any_table(spark):
    U.register_table_search(spark, "find_in")
    rows = [(1, "red Bolt", "x"), (2, "BOLT", "x"), (3, "red red bolt nut", "x"), (4, None, "x"), (None, "bolt", "x"), (5, "nut", "y"), (6, "red", None)]
    spark.createDataFrame(rows, "id int, words string, kind string").createOrReplaceTempView("things")
    found = spark.sql(
        "SELECT * FROM find_in(TABLE(things) PARTITION BY (kind), 'Bolt, red', 3, 'words', 'id')")
    assert sorted((r.kind or "", r.search_rank, r.id, r.search_score) for r in found.collect()) == [
        ("", 1, 6, 1), ("x", 1, 1, 2), ("x", 2, 3, 2), ("x", 3, 2, 1)]
    with pytest.raises(Exception, match="no column other"):
        spark.sql("SELECT * FROM find_in(TABLE(things) PARTITION BY (kind), 'red', 3, 'other', 'id')").collect()


def test_places_of_a_prompt(spark):
    turns = spark.createDataFrame(
        [("a", 0, "system", "s"), ("a", 1, "user", "q"), ("b", 3, "user", "q1"), ("b", 4, "user", "q2"), ("c", 0, "user", "only")],
        "conv_id string, turn int, role string, text string")
    prompts = spark.createDataFrame([("a", "P"), ("b", "P")], "conv_id string, prompt string")
    placed = {place: sorted(map(tuple, T.with_prompt(turns, prompts, place).collect())) for place in ("user", "system")}
    assert placed["user"] == [("a", 0, "system", "s"), ("a", 1, "user", "P"), ("b", 3, "user", "q1"), ("b", 4, "user", "P"), ("c", 0, "user", "only")]
    assert placed["system"] == [("a", 0, "system", "P"), ("a", 1, "user", "q"), ("b", 2, "system", "P"), ("b", 3, "user", "q1"),
                                ("b", 4, "user", "q2"), ("c", 0, "user", "only")]
    with pytest.raises(ValueError):
        T.with_prompt(turns, prompts, "assistant")
