import datetime as dt

import pytest
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom import streaming as ST

SCHEMA = "request_id string, ts timestamp, version string, rating string"
START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


@pytest.fixture
def drop(spark, tmp_path):
    """Put rows into the log folder as a new file."""
    folder = tmp_path / "log"

    def write(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        return str(folder)

    return write


def schema_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


def run(spark, tmp_path, stream):
    out = str(tmp_path / "out")
    ST.append_stream(stream, out, str(tmp_path / "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def test_ingest_takes_each_row_once(spark, tmp_path, drop):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def ingest(folder):
        ST.ingest(spark, folder, schema_of(spark), out, checkpoint)
        return spark.read.parquet(out).count()

    folder = drop([("a", at(0), "v1", "yes"), ("b", at(1), "v1", "no")])
    assert ingest(folder) == 2
    assert ingest(folder) == 2
    drop([("c", at(2), "v1", "no")])
    assert ingest(folder) == 3
    assert dict(spark.read.parquet(out).dtypes)[K.PRECISION_COLUMN] == "double"
    assert spark.read.parquet(out).filter("run_id IS NOT NULL").count() == 0


def test_partitioned_ingest_prunes_days(spark, tmp_path, drop, capsys):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder = drop([("a", at(0), "v1", "yes"), ("b", at(30), "v2", "no")])
    ST.ingest(spark, folder, schema_of(spark), out, checkpoint, ("version",))
    found = spark.read.parquet(out).filter("version = 'v2'")
    assert [r.request_id for r in found.collect()] == ["b"]
    capsys.readouterr()
    found.explain()
    assert "PartitionFilters: [isnotnull(version" in capsys.readouterr().out


def test_batches_own_their_output(spark, tmp_path, drop):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder = drop([("a", at(0), "v1", "yes")])

    def evaluate(batch):
        return batch.select("request_id", F.lit(1).alias("judged"))

    def go():
        ST.evaluate_batches(ST.request_stream(spark, folder, schema_of(spark)), evaluate, out, checkpoint)
        return sorted(r.request_id for r in spark.read.parquet(out).collect())

    assert go() == ["a"]
    drop([("b", at(1), "v1", "no")])
    assert go() == ["a", "b"]
    assert go() == ["a", "b"]


def test_dedup_across_drops(spark, tmp_path, drop):
    folder = drop([("a", at(0), "v1", "yes"), ("a", at(0.1), "v1", "yes")])

    def stream():
        return ST.stream_dedup(ST.request_stream(spark, folder, schema_of(spark)), delay="2 hours")

    assert run(spark, tmp_path, stream()).count() == 1
    drop([("a", at(0.5), "v1", "no"), ("b", at(1), "v1", "no")])
    assert sorted(r.request_id for r in run(spark, tmp_path, stream()).collect()) == ["a", "b"]


def test_hours_close_with_the_watermark(spark, tmp_path, drop):
    folder = drop([("a", at(0.1), "v1", "yes"), ("b", at(0.2), "v2", "no"), ("c", at(1.5), "v1", "no")])

    def counts():
        stream = ST.hourly_counts(ST.request_stream(spark, folder, schema_of(spark)), delay="1 hour")
        return {r.hour: r.requests for r in run(spark, tmp_path, stream).collect()}

    # The watermark is at 0:30: no hour is closed, so the row of 0:45 still counts.
    assert counts() == {}
    drop([("d", at(0.75), "v1", "no"), ("sentinel", at(10), "v1", None)])
    assert counts() == {at(0): 3, at(1): 1}
    # The watermark is at 9:00: a row of the first hour comes too late.
    drop([("late", at(0.8), "v1", "yes"), ("sentinel", at(20), "v1", None)])
    assert counts() == {at(0): 3, at(1): 1, at(10): 1}


def test_sliding_rate(spark, tmp_path, drop):
    folder = drop([("a", at(0.5), "v1", "yes"), ("b", at(1.5), "v1", "no"), ("c", at(1.6), "v1", None), ("s", at(48), "v1", None)])
    stream = ST.sliding_pass_rate(ST.request_stream(spark, folder, schema_of(spark)), width="2 hours")
    found = {r.until: (r.judged, r.pass_rate) for r in run(spark, tmp_path, stream).collect()}
    assert found == {at(1): (1, 1.0), at(2): (2, 0.5), at(3): (1, 0.0)}
