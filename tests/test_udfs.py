import pytest
from pyspark.sql import functions as F

from evalloom.operators import udfs as U


def test_registered_scalars(spark):
    def shout(text: str) -> str:
        """Upper case."""
        return text.upper()

    def add(a: int, b: int) -> int:
        """Sum."""
        return a + b

    U.register_scalar(spark, shout)
    U.register_scalar(spark, add, "plus")
    row = spark.sql("SELECT shout('abc') AS s, shout(CAST(NULL AS STRING)) AS n, plus(2, 3) AS p").first()
    assert (row.s, row.n, row.p) == ("ABC", None, 5)


def test_scalars_need_a_type_and_a_doc_string(spark):
    def untyped(x):
        """Doc."""

    def undocumented(x: str) -> str:
        return x

    for function in (untyped, undocumented):
        with pytest.raises(TypeError):
            U.register_scalar(spark, function)


def test_table_function_takes_its_own_parameter(spark):
    spark.createDataFrame([("u1", 5), ("u2", 7)], "user_id string, amount int").createOrReplaceTempView("fn_orders")
    U.register_table_fn(
        spark, "orders_of", "user_id STRING", "amount INT",
        "SELECT amount FROM fn_orders o WHERE o.user_id = orders_of.user_id",
    )
    assert [r.amount for r in spark.sql("SELECT * FROM orders_of('u2')").collect()] == [7]
    joined = spark.sql("SELECT t.u, amount FROM VALUES ('u1'), ('u2'), ('u3') AS t(u), LATERAL orders_of(t.u)")
    assert sorted(tuple(r) for r in joined.collect()) == [("u1", 5), ("u2", 7)]


def test_retry_backs_off_and_gives_up():
    waits, calls = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 4:
            raise OSError("busy")
        return "ok"

    assert U.with_retry(flaky, 6, sleep=waits.append)("q") == "ok"
    assert len(waits) == 3 and all(1 <= w <= 60 for w in waits)
    with pytest.raises(ZeroDivisionError):
        U.with_retry(lambda x: 1 / 0, 3, sleep=waits.append)("q")
    assert len(waits) == 5


def test_batch_predict_keeps_failed_rows(spark):
    def make_client():
        def agent(question):
            if question == "bad":
                raise ValueError("no answer")
            return f"re: {question}"

        return agent

    table = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "id int, question string")
    found = {r.id: (r.response, r.error) for r in U.batch_predict(table, make_client, "question", attempts=1).collect()}
    assert found == {1: ("re: a", None), 2: (None, "ValueError: no answer"), 3: ("re: None", None)}


def test_prompt_judge_fills_the_template(spark):
    table = spark.createDataFrame([("x{y}",)], "response string")
    judged = U.prompt_judge(table, "echo", "<{response}>", lambda: lambda prompt: prompt, attempts=1)
    assert tuple(judged.first()) == ("x{y}", "<x{y}>", None)
    with pytest.raises(ValueError):
        U.prompt_judge(table, "echo", "no slot", lambda: str)


@pytest.mark.parametrize(("size", "overlap"), [(4, 0), (4, 1), (5, 4), (100, 0)])
def test_chunkers_agree(spark, size, overlap):
    texts = ["", "abc", "abcd", "abcde", "abcdefghij" * 3, "äöü€" * 5, None]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    U.register_chunker(spark)
    table.createOrReplaceTempView("to_chunk")
    by_function = spark.sql(f"SELECT id, c.chunk_no, c.chunk FROM to_chunk, LATERAL chunk_text(text, {size}, {overlap}) c")
    built_in = U.chunk_docs(table, "text", size, overlap)
    rows = sorted(tuple(r) for r in built_in.collect())
    assert rows == sorted(tuple(r) for r in by_function.collect())
    for n, text in enumerate(texts[:-1]):
        pieces = [c for i, _, c in rows if i == n]
        assert pieces[0] + "".join(p[overlap:] for p in pieces[1:]) == text


def test_chunk_sizes_are_checked(spark):
    with pytest.raises(ValueError):
        U.chunk_docs(spark.createDataFrame([("x",)], "t string"), "t", 3, 3)
