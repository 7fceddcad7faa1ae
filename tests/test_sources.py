import pytest
from pyspark.sql import functions as F

from evalloom import session, sources


def test_records_and_json_lines(spark, tmp_path):
    made = sources.from_records(spark, [{"a": 1, "b": "x"}, {"a": 2}], "a int, b string")
    path = str(tmp_path / "rows")
    sources.save_jsonl(made, path)
    assert sorted(map(tuple, sources.load_jsonl(spark, path, "a int, b string").collect())) == [(1, "x"), (2, None)]


def test_save_overwrites(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1,)], "a int")
    sources.save(first, "saved_rows", path=path)
    again = sources.save(spark.createDataFrame([(2, "p"), (3, "q")], "a int, day string"), "saved_rows", path=path, partition_by=["day"])
    assert sorted(r.a for r in again.collect()) == [2, 3]
    assert sorted(r.a for r in sources.load(spark, "saved_rows").collect()) == [2, 3]


def test_append_evolving(spark):
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("t", 2)], "b string, a int")
    assert sorted(map(tuple, sources.append_evolving(old, new).collect()), key=repr) == [(1, None), (2, "t")]


def test_metadata_map(spark):
    pairs = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("a", "0", 3)], "key string, value string, n int")
    assert sources.kv_to_map(pairs, "n").first().metadata == {"a": "0", "b": "2"}
    assert sources.kv_to_map(pairs.select("key", "value")).first().metadata == {"a": "1", "b": "2"}
    assert sorted(map(tuple, sources.fold_kv(pairs, "n").collect())) == [("a", "0"), ("b", "2")]
    assert sources.kv_to_map(pairs.limit(0)).first().metadata == {}


def test_legacy_layout():
    assert sources.legacy_layout(["value", "key"]) == "metadata"
    assert sources.legacy_layout(["key", "value", "request"]) == "view"


def test_small_tables_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "few.parquet"))
    assert sources.load(spark, "few", str(tmp_path)).rdd.getNumPartitions() == 1
    spread = sources.load(spark, "few", str(tmp_path), spread_by="id")
    assert spread.rdd.getNumPartitions() == 4 and spread.count() == 100


def test_stage_uses_the_shared_folder(spark):
    shared = session.shared_folder(spark)
    staged = session.stage(spark.range(5).withColumn("b", F.lit(None).cast("string")), "five")
    assert staged.count() == 5 and staged.columns == ["id", "b"]
    assert shared in staged.inputFiles()[0]
    assert session.stage(spark.range(0), "none").count() == 0


class _Cluster:
    """Just enough of a session on a cluster."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getConf = staticmethod(dict)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_Cluster)


def test_scratch_paths_do_not_repeat(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
