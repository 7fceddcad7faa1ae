"""Work and memory that must not grow faster than the input."""

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evalloom.operators import retrieval as R
from evalloom.operators import udfs as U
from evalloom.plans import QUERIES
from evalloom.session import shared_folder
from evalloom.sources import append_stored, merge_stored, read_stored

SMOKE = "/root/testdata/sf0.001"
DOCS = [(10, "alpha beta"), (20, ""), (30, "BETA gamma"), (40, "delta"), (50, "gamma delta beta"), (60, "")]


@pytest.mark.parametrize(
    "name", ["salient_keywords", "context_budget", "build_prompt", "hybrid_topk", "retrieval_recall", "judge_panel", "overall_rating"],
)
def test_one_query_set_builds_no_index(spark, name):
    folder = Path(shared_folder(spark).removeprefix("file:"))

    def indexes():
        return {path.name for path in folder.glob("keyword-index-*")}

    before = indexes()
    QUERIES[name](spark, SMOKE).count()
    assert indexes() == before == set()


@pytest.mark.parametrize("scan_limit", [64, 0])
def test_one_look_serves_several_query_sets(spark, scan_limit):
    docs = spark.createDataFrame(DOCS, "corpus_pos bigint, content string")
    sets = [
        spark.createDataFrame(rows, "query_id int, keywords array<string>")
        for rows in ([(1, ["beta", "beta"]), (2, ["elt", "", "zzz"]), (3, [])], [(1, ["gamma delta", " "]), (2, ["beta"])])
    ]
    hits = R.keyword_hits(sets, docs, scan_limit=scan_limit)
    for asked in sets:
        for made in (R.keyword_matches, lambda *a, **o: R.keyword_rank(*a, 3, **o)):
            assert sorted(made(asked, docs, hits=hits).collect()) == sorted(made(asked, docs, scan_limit=scan_limit).collect())
    assert hits.count() == 9


def test_no_percentile_digest_per_user(spark, capsys):
    QUERIES["sketch_levels"](spark, SMOKE).explain()
    lines = capsys.readouterr().out.splitlines()
    digests = [line for line in lines if "percentile_approx" in line]
    assert digests and not any("user_id" in line for line in digests)


def test_a_stored_partition_gets_few_files(spark, tmp_path):
    path = tmp_path / "log"
    rows = spark.range(0, 400, 1, 8).withColumn("date", F.col("id") % 20)
    append_stored(rows, str(path), partition_by="date")
    assert len(list(path.glob("date=*/*.parquet"))) == 20

    def merge(old, new):
        return old.join(new, "id", "left")

    updates = spark.range(0, 400, 3, 8).withColumn("seen", F.lit(True))
    assert len(merge_stored(str(path), updates, "id", merge)) == 20
    assert len(list(path.glob("date=*/*.parquet"))) == 20
    assert read_stored(spark, str(path)).filter("seen").count() == 134


def test_only_a_portion_of_a_batch_is_python_objects():
    texts = ["a" * 300_000, None, "", "b" * 3_000_000, *["c"] * 5_000, "d" * 900_000] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    parts = list(U._portions(batch, "text"))
    assert [x for part in parts for x in part.column("text").to_pylist()] == texts
    assert all(sum(map(len, filter(None, part.column("text").to_pylist()[:-1]))) <= U.PORTION for part in parts)
    assert [part.num_rows for part in U._portions(batch, "id")][:2] == [1049, 1049]
    assert list(U._portions(batch.slice(0, 0), "text")) == []


def test_a_judge_takes_only_the_columns_it_needs(spark):
    table = spark.createDataFrame([(1, "x", 2.5), (2, None, None)], "id int, text string, other double")
    judged = U.prompt_judge(table, "echo", "<{response}>", lambda: str, response="text", attempts=1, keep=["id"])
    assert [tuple(r) for r in judged.orderBy("id").collect()] == [(1, "<x>", None), (2, "None", None)]
