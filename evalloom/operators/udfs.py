"""User functions: registered scalars and table functions, callables run over rows, prompt judges."""

from __future__ import annotations

import functools
import inspect
import random
import time
import typing
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalloom import constants as K
from evalloom.functions.text import fill_template

PORTION = 1 << 20  # bytes of a column that are Python objects at once, about

_SQL_TYPES: dict[Any, T.DataType] = {
    str: T.StringType(), int: T.LongType(), float: T.DoubleType(), bool: T.BooleanType(),
}


def register_scalar(spark: SparkSession, function: Callable[..., Any], name: str | None = None) -> Callable[..., Column]:
    """Register a Python function for SQL under its name, typed by its return annotation.

    It runs on Arrow batches. A null argument gives null, since annotated functions do not expect one.
    """
    result = typing.get_type_hints(function).get("return")
    if result not in _SQL_TYPES:
        raise TypeError(f"{function.__name__} needs a return annotation of str, int, float or bool")
    if not inspect.getdoc(function):
        raise TypeError(f"{function.__name__} needs a doc string for its callers")

    @functools.wraps(function)
    def null_safe(*arguments: Any) -> Any:
        return None if any(a is None for a in arguments) else function(*arguments)

    made = F.udf(null_safe, _SQL_TYPES[result], useArrow=True)
    return spark.udf.register(name or function.__name__, made)


def register_table_fn(spark: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    """Register a SQL table function, which Spark inlines into the calling query.

    The body must qualify its parameters with the function name: a bare name that is also a column of
    the table means the column.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({returns}) RETURN {body}"
    )


def with_retry(
    function: Callable[[Any], Any], attempts: int = K.RETRY_ATTEMPTS, *,
    min_seconds: float = K.RETRY_MIN_SECONDS, max_seconds: float = K.RETRY_MAX_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> Callable[[Any], Any]:
    """Call again after an exception, waiting a random time whose bound doubles; the last one is raised."""
    def call(argument: Any) -> Any:
        for attempt in range(attempts):
            try:
                return function(argument)
            except Exception:
                if attempt + 1 == attempts:
                    raise
                bound = min(max_seconds, min_seconds * 2**attempt)
                sleep(random.uniform(min(min_seconds, bound), bound))

    return call


def batch_predict(
    df: DataFrame, make_client: Callable[[], Callable[[Any], Any]], column: str, *,
    output: str = "response", attempts: int = K.RETRY_ATTEMPTS, min_seconds: float = K.RETRY_MIN_SECONDS,
    concurrency: int = 1,
) -> DataFrame:
    """Run a user callable over one column, adding its text `output` and an `error`.

    The client is made once per task, and called by `concurrency` threads at a time, for clients that wait for
    an answer; rows keep their order. A value the callable still fails on after its retries gives a null output
    and the error text; it does not fail the job.
    """
    fields = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = with_retry(make_client(), attempts, min_seconds=min_seconds)

        def ask(value: Any) -> tuple[str | None, str | None]:
            try:
                found = call(value)
                return None if found is None else str(found), None
            except Exception as error:
                return None, f"{type(error).__name__}: {error}"

        with ThreadPoolExecutor(concurrency) as threads:
            for batch in batches:
                for part in _portions(batch, column):
                    found = list(threads.map(ask, part.column(column).to_pandas()))
                    texts = [pa.array([row[i] for row in found], pa.string()) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *texts], names=[*part.schema.names, output, "error"])

    return df.mapInArrow(run, f"{fields}, `{output}` string, error string")


def _portions(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about PORTION bytes of the column, which count 1,000 a row if it is no text."""
    values = batch.column(column)
    sizes = np.full(len(values), 1000)
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(sizes) - sizes) // PORTION
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(values)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def prompt_judge(
    df: DataFrame, name: str, template: str, make_client: Callable[[], Callable[[str], Any]], *,
    response: str = "response", attempts: int = K.RETRY_ATTEMPTS, keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add a judge defined by a prompt template holding `{response}`, answered by a user callable.

    Of the table only the columns of `keep`, by default all, go through the task that asks: name those that are needed.
    """
    if "{response}" not in template:
        raise ValueError("the template must hold {response}")
    prompt = fill_template(template, response=response)
    judged = batch_predict(
        df.select(*("*" if keep is None else keep), prompt.alias("__prompt")), make_client, "__prompt", output=name, attempts=attempts
    )
    return judged.drop("__prompt").withColumnRenamed("error", f"{name}_error")


class _Chunker:
    def eval(self, text: str, size: int, overlap: int):
        if text is None:
            return
        step = size - overlap
        for number, start in enumerate(range(0, max(len(text) - overlap, 1), step)):
            yield number, text[start : start + size]


def register_chunker(spark: SparkSession, name: str = "chunk_text") -> None:
    """Register a Python table function `(text, size, overlap)` that yields `chunk_no, chunk`."""
    spark.udtf.register(name, F.udtf(_Chunker, returnType="chunk_no int, chunk string"))


def chunk_docs(docs: DataFrame, text: str, size: int, overlap: int = 0) -> DataFrame:
    """The same chunks with built-in functions: one row per chunk, in place of the text."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    last = F.greatest(F.length(text) - overlap, F.lit(1)) - 1
    starts = F.sequence(F.lit(0), last, F.lit(step))
    spread = docs.filter(F.col(text).isNotNull()).withColumn("chunk_no", F.explode(starts))
    chunk = F.substring(F.col(text), F.col("chunk_no") + 1, F.lit(size))
    return spread.withColumn("chunk", chunk).withColumn(
        "chunk_no", (F.col("chunk_no") / step).cast("int")
    ).drop(text)


class _TableSearch:
    """The best rows of each partition of a table by how many of the topic's words their text holds."""

    @staticmethod
    def analyze(rows, topic, k, text, key):
        from pyspark.sql.types import IntegerType, StructType
        from pyspark.sql.udtf import AnalyzeResult

        if not rows.isTable:
            raise ValueError("the first argument must be a TABLE")
        missing = [name.value for name in (text, key) if name.value not in rows.dataType.fieldNames()]
        if missing:
            raise ValueError(f"the table has no column {', '.join(missing)}")
        return AnalyzeResult(StructType([*rows.dataType.fields]).add("search_score", IntegerType()).add("search_rank", IntegerType()))

    def __init__(self):
        self.best = []

    def eval(self, row, topic, k, text, key):
        import re

        self.k = k
        words = {w for w in re.split(r"[\W_]+", (topic or "").lower()) if w}
        held = {w for w in re.split(r"[\W_]+", (row[text] or "").lower()) if w}
        if (score := len(words & held)) > 0:
            self.best.append(((-score, row[key] is None, row[key]), tuple(row)))
            if len(self.best) > 2 * k + 100:
                self._cut()

    def _cut(self):
        self.best.sort(key=lambda x: x[0])
        del self.best[self.k :]

    def terminate(self):
        if self.best:
            self._cut()
        for rank, (order, row) in enumerate(self.best, 1):
            yield (*row, -order[0], rank)


def register_table_search(spark: SparkSession, name: str = "search_table") -> None:
    """Register `(TABLE rows PARTITION BY ..., topic, k, text, key)`: the k best rows of each partition for a topic.

    The result has the columns of whatever table it is given, and `search_score`, the number of words of the topic that
    the column `text` holds (rows with none are left out), and `search_rank`; ties go to the lower `key`. A partition is
    streamed through one task that keeps a few times k rows of it.
    """
    spark.udtf.register(name, F.udtf(_TableSearch))
