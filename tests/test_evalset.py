import pytest
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.operators import evalset as E


def docs(spark, n):
    return spark.createDataFrame([(10 * i, f"First {i}. Second {i}. Third {i}!", f"u{i}") for i in range(n)],
                                 "corpus_pos bigint, content string, doc_uri string")


@pytest.mark.parametrize(("n", "quotas"), [(0, [0] * 4), (2, [1, 1, 0, 0]), (4, [1] * 4), (7, [2, 2, 2, 1]), (8, [2] * 4)])
def test_quota(spark, n, quotas):
    planned = E.plan_evals(docs(spark, 4), n).collect()
    assert [sum(r.corpus_pos == 10 * i for r in planned) for i in range(4)] == quotas
    assert all(1 <= r.question_no <= r.quota for r in planned)


def test_per_document_is_the_default(spark):
    assert E.plan_evals(docs(spark, 4)).count() == 4 * K.QUESTIONS_PER_DOC


def test_generated_rows(spark):
    made = E.generate_evals(E.plan_evals(docs(spark, 1), 2), facts_per_question=2).orderBy("request").collect()
    assert [r.expected_facts for r in made] == [["First 0", "Second 0"], ["Third 0"]]
    assert made[0].source_id == "u0" and made[0].expected_retrieved_context[0].doc_uri == "u0"
    assert len({r.request_id for r in made}) == 2


def test_custom_generator(spark):
    def generator(batches):
        for batch in batches:
            yield batch.assign(request="Q " + batch.doc_uri, expected_facts=[[c[:5]] for c in batch.content])[
                ["doc_uri", "question_no", "request", "expected_facts"]
            ]

    made = E.generate_evals(E.plan_evals(docs(spark, 2), 2), generator=generator).orderBy("request").collect()
    assert [(r.request, r.expected_facts) for r in made] == [("Q u0", ["First"]), ("Q u1", ["First"])]


LEGACY = (
    "request_id string, request string, expected_facts array<string>, expected_response string, ground_truth string, "
    "grading_notes string, source_type string, request_source string, source_id string, "
    "synthetic_source_doc_id string, created_by string, tags array<struct<tag_name:string>>, review_status string, status string"
)


def test_migration(spark):
    notes = f"{K.NOTES_HEADER}\n- n1\n- n2"
    old = spark.createDataFrame(
        [
            ("notes", "q", ["f"], "ignored answer", None, notes, "human", None, "s", "d", "me", [("t",)], "DRAFT", "X"),
            ("answer", "q", ["f"], "", "One. Two. One.", "", "", "Synthetic", "", "d", "me", None, "", "ACCEPTED"),
            ("facts", "q", ["f"], None, None, None, None, None, None, "d", "me", [], None, None),
            ("none", "q", None, None, None, None, "crawl", "human", "s", "d", "me", [], None, ""),
        ],
        LEGACY,
    )
    new = {r.request_id: r for r in E.migrate_evals(old).collect()}
    assert new["notes"].expected_facts == ["f", "n1", "n2"]
    assert (new["notes"].source_type, new["notes"].source_id, new["notes"].tags) == (K.HUMAN_SOURCE, "s", ["t"])
    assert new["answer"].expected_facts == ["One", "Two"]
    assert (new["answer"].source_type, new["answer"].source_id) == (K.SYNTHETIC_SOURCE, "d")
    assert (new["answer"].tags, new["answer"].review_status) == ([], "ACCEPTED")
    assert (new["facts"].expected_facts, new["facts"].source_type, new["facts"].source_id) == (["f"], None, "me")
    assert (new["none"].expected_facts, new["none"].source_type, new["none"].review_status) == ([], None, None)
    assert all(r.expected_response is None for r in new.values())


def test_migration_of_a_narrow_table(spark):
    old = spark.createDataFrame([("a", "q", ["x"])], "request_id string, request string, tags array<string>")
    row = E.migrate_evals(old).first()
    assert (row.expected_facts, row.tags, row.source_id) == ([], ["x"], None)


def test_adding_twice_changes_nothing(spark):
    have = spark.createDataFrame([("a", "q1", "s")], "request_id string, request string, source_id string")
    more = spark.createDataFrame([("a", "q9", "s"), (None, "q2", "s"), ("", "q2", "s"), ("b", "q3", "s")],
                                 "request_id string, request string, source_id string")
    once = E.add_evals(have, more)
    assert sorted(r.request for r in once.collect()) == ["q1", "q2", "q3"]
    assert sorted(once.collect()) == sorted(E.add_evals(once, more).collect())


def test_revisions(spark):
    history = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("a", 5, None), ("a", 9, None), ("b", 3, "y")],
        "request_id string, revision int, note string",
    )
    assert sorted((r.request_id, r.revision) for r in E.latest_revision(history).collect()) == [("a", 9), ("b", 3)]
    changes = sorted(tuple(r) for r in E.revision_diff(history, "note").collect())
    assert changes == [("a", 1, None, "x"), ("a", 5, "x", None), ("b", 3, None, "y")]


@pytest.mark.parametrize("layout", ["metadata", "view"])
def test_a_dataset_moves_with_its_metadata_and_tags(spark, tmp_path, layout):
    name, path = f"old_{layout}", str(tmp_path / "new")
    rows = spark.createDataFrame([("a", "q1", ["f"]), ("b", "q2", None)], "request_id string, request string, expected_facts array<string>")
    metadata = spark.createDataFrame([("k", "1"), ("k", "2"), ("m", None)], "key string, value string")
    rows.createOrReplaceTempView(f"{name}_view" if layout == "metadata" else name)
    metadata.createOrReplaceTempView(name if layout == "metadata" else f"{name}_metadata")
    for _ in range(2):
        found = E.migrate_dataset(spark, name, path)
        assert {r.key: r.value for r in found.collect()} == {"k": "2", "m": None}
        assert {r.request_id: r.expected_facts for r in spark.read.parquet(f"{path}/evals").collect()} == {"a": ["f"], "b": []}
    spark.createDataFrame([("x",), ("x",), (None,)], "tag_name string").createOrReplaceTempView(f"{name}_tags")
    for _ in range(2):
        E.migrate_dataset(spark, name, path)
        assert [r.tag_name for r in spark.read.parquet(f"{path}/tags").collect()] == ["x"]
    assert spark.read.parquet(f"{path}/evals").count() == 2
