import pytest
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions import judging as JF
from evalloom.operators import judges as J


@pytest.mark.parametrize(
    ("facts", "share"), [(["spark", "FAST"], 1.0), (["spark", "slow"], 0.5), (["slow"], 0.0), ([], None), (None, None)]
)
def test_fact_coverage(one, facts, share):
    assert one(JF.fact_coverage(F.lit("Spark is fast"), "f"), "f array<string>", (facts,)) == share
    passed = None if share is None else share == 1.0
    assert one(JF.correctness(F.lit("Spark is fast"), "f"), "f array<string>", (facts,)) == passed


@pytest.mark.parametrize(
    ("found", "wanted", "recall"), [(["a", "b"], ["a"], 1.0), (["a"], ["a", "b", "a"], 0.5), ([], ["a"], 0.0), (["a"], [], None)]
)
def test_retrieval_recall(one, found, wanted, recall):
    assert one(JF.retrieval_recall("f", "w"), "f array<string>, w array<string>", (found, wanted)) == recall


def test_token_overlap(one):
    assert one(JF.groundedness(F.lit("The cat, the DOG"), F.lit("dog and the bird"))) == pytest.approx(2 / 3)
    assert one(JF.query_relevance(F.lit("?!"), F.lit("x"))) is None


@pytest.mark.parametrize(
    ("text", "score"),
    [
        ("write to jo.doe@example.org now", 1),
        ("call +1 (212) 555-0100", 1),
        ("card 4111 1111 1111 1111", 1),
        ("host 10.0.0.1 is down", 1),
        ("api_key = abcdEFGH1234", 1),
        ("nothing to see, version 1.2.3", 5),
        ("", 5),
        (None, None),
    ],
)
def test_pii(one, text, score):
    assert one(JF.pii_score("a"), row=(text,)) == score


def test_pii_counts(one):
    counts = JF.pii_counts("a")
    assert one(counts["email"], row=("a@b.co, c@d.org",)) == 2
    assert one(counts["ip"], row=("a@b.co",)) == 0


@pytest.mark.parametrize(
    ("verdicts", "rating"),
    [(["yes", "yes"], "yes"), (["yes", "no"], "no"), (["yes", None], "yes"), ([None, "no"], "no"), ([None, None], None)],
)
def test_overall(one, verdicts, rating):
    assert one(JF.overall([F.lit(v).cast("string") for v in verdicts])) == rating


@pytest.mark.parametrize(
    ("text", "topic"), [("billing and refund", "money"), ("refund the parcel", "money"), ("parcel", "post"), ("hello", "other")]
)
def test_topic(one, text, topic):
    topics = {"money": ["billing", "refund"], "post": ["parcel"]}
    assert one(JF.topic_keyword("a", topics), row=(text,)) == topic


@pytest.mark.parametrize("topics", [{}, {" ": ["x"]}, {"other": ["x"]}])
def test_no_topics(one, topics):
    assert one(JF.topic_keyword("a", topics), row=("x",)) == "other"


def panel(spark):
    return spark.createDataFrame(
        [("what is spark", "spark is fast", "spark is a fast engine", ["fast"], ["d1"], ["d1"])],
        "request string, response string, context string, expected_facts array<string>, retrieved array<string>, expected array<string>",
    )


def test_panel(spark):
    judged = J.run_judges(panel(spark), K.JUDGES)
    assert J.judge_columns(judged) == [
        "retrieval/chunk_relevance", "retrieval/context_sufficiency", "response/correctness", "response/groundedness",
        "response/relevance_to_query", "response/safety",
    ]
    row = J.with_overall(judged).first()
    assert all(row[c] == "yes" for c in J.judge_columns(judged)) and row.overall == "yes"
    chosen = J.run_judges(panel(spark), ["correctness", "short"], {"short": ("response", lambda: F.length("response") < 5)})
    assert J.with_overall(chosen).first()["overall"] == "no"
    with pytest.raises(ValueError, match="unknown"):
        J.run_judges(panel(spark), ["charm"])


def test_chunk_precision(spark):
    rows = spark.createDataFrame([(1, "big cat", "a cat"), (1, "big cat", "dogs"), (2, "?", "x")], "query_id int, request string, page_content string")
    found = {r.query_id: (r.precision, r.chunks) for r in J.chunk_precision(rows).collect()}
    assert found == {1: (0.5, 2), 2: (0.0, 1)}


def test_recall_of(spark):
    wanted = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "query_id int, doc int")
    found = spark.createDataFrame([(1, 6), (1, 9), (3, 7)], "query_id int, doc int")
    assert {r.query_id: r.recall for r in J.recall_of(found, wanted, "doc").collect()} == {1: 0.5, 2: 0.0}
    asked = spark.createDataFrame([(1,), (2,), (4,)], "query_id int")
    every = J.recall_of(found, wanted, "doc", requests=asked)
    assert {r.query_id: (r.expected, r.found, r.recall) for r in every.collect()} == {1: (2, 1, 0.5), 2: (1, 0, 0.0), 4: (0, 0, None)}


def test_safety(spark):
    rows = spark.createDataFrame([(1, "ok"), (2, "ok"), (3, "BAD word")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id int, toxic int")
    assert {r.doc_id: r.safe for r in J.safety(rows, labels, "text", ["bad"]).collect()} == {1: True, 2: False, 3: False}


def test_agreement(spark):
    pairs = [("yes", "yes")] * 20 + [("yes", "no")] * 5 + [("no", "yes")] * 10 + [("no", "no")] * 15 + [(None, "yes")]
    row = J.judge_agreement(spark.createDataFrame(pairs, "j string, h string"), "j", "h").first()
    assert (row.both_yes, row.judge_yes, row.human_yes, row.both_no) == (20, 5, 10, 15)
    assert row.accuracy == pytest.approx(0.7) and row.kappa == pytest.approx(0.4)
    unanimous = spark.createDataFrame([("yes", "yes")], "j string, h string")
    assert J.judge_agreement(unanimous, "j", "h").first().kappa is None
