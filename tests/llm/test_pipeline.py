"""The pipeline, stage by stage, against plain restatements."""

from pathlib import Path

import brute
import pytest

import corpus_pipeline
from evalloom.llm import queries

BASE = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not BASE.exists(), reason="test tables are not there")


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(str(BASE / "documents.parquet"))
    seen = {}
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        seen[name] = docs
        function(spark, docs, str(BASE)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns or name == "packed"
    seen["end"] = docs
    before = rows(seen["near_duplicates"])
    assert len(before) == len(rows(seen["known_language"]))  # all of these have letters
    least = {c for _, _, c in brute.near_text(before)}
    assert {i for i, _ in rows(seen["repeated_strings"])} == least
    before, after = rows(seen["repeated_strings"]), dict(rows(seen["benchmark_passages"]))
    for doc_id, n, removed, _, _ in brute.repeats(before):
        assert n - removed - len(after[doc_id].encode()) in range(0, 1 + 8 * removed)
    items = [(r.item_id, r.text) for r in spark.read.parquet(str(BASE / "benchmark.parquet")).collect()]
    clean = {x[0] for x in brute.benchmark_hits(list(after.items()), items) if not x[-1]}
    assert {i for i, _ in rows(seen["packed"])} == clean
    assert {r.doc_id for r in docs.collect()} == clean


def test_every_operator_is_registered():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert list(corpus_pipeline.QUERIES) == ["pipeline"]
