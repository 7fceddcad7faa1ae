"""Judges that need more than one row, and panels of judges."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalloom.functions import judging as J
from evalloom.functions.text import words
from evalloom.operators.sampling import top_per_group


def chunk_precision(
    retrieved: DataFrame, *, query: str = "request", chunk: str = "page_content", key: str = "query_id",
    threshold: float = 0.2,
) -> DataFrame:
    """Share of each request's retrieved chunks that are relevant.

    `retrieved` has one row per chunk. A chunk is relevant if it holds at least `threshold` of the
    distinct words of the request.
    """
    relevant = F.coalesce(J.token_overlap(query, chunk) >= threshold, F.lit(False))
    return retrieved.groupBy(key).agg(
        F.avg(relevant.cast("int")).alias("precision"), F.count(F.lit(1)).alias("chunks")
    )


def safety(df: DataFrame, labels: DataFrame, text: str, terms: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Add `safe`: no listed term in the text, and not labelled toxic. Unlabelled rows go by the terms."""
    known = labels.select(key, F.col("toxic"))
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    return df.join(known, key, "left").withColumn("safe", ~(toxic | J.names_any(text, terms))).drop("toxic")


# Each judge takes the row's columns: request, response, context, expected_facts, retrieved, expected.
BUILDERS: dict[str, tuple[str, Callable[[], Column]]] = {
    "chunk_relevance": ("retrieval", lambda: J.token_overlap("request", "context") >= 0.2),
    "context_sufficiency": ("retrieval", lambda: J.retrieval_recall("retrieved", "expected") == 1.0),
    "correctness": ("response", lambda: J.correctness("response", "expected_facts")),
    "groundedness": ("response", lambda: J.groundedness("response", "context") >= 0.5),
    "relevance_to_query": ("response", lambda: J.query_relevance("request", "response") >= 0.2),
    "safety": ("response", lambda: J.pii_score("response") == 5),
}


def run_judges(
    df: DataFrame, metrics: Sequence[str], extra: Mapping[str, tuple[str, Callable[[], Column]]] | None = None
) -> DataFrame:
    """Add one yes/no column per judge, named `response/<judge>` or `retrieval/<judge>`, in one projection."""
    builders = {**BUILDERS, **(extra or {})}
    unknown = [m for m in metrics if m not in builders]
    if unknown:
        raise ValueError(f"unknown judges: {', '.join(unknown)}")
    verdicts = {}
    for metric in metrics:
        family, build = builders[metric]
        verdicts[f"{family}/{metric}"] = J.yes_no(build())
    return df.withColumns(verdicts)


def judge_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(("response/", "retrieval/"))]


def with_overall(df: DataFrame, column: str = "overall") -> DataFrame:
    """Add the overall rating over all judge columns."""
    return df.withColumn(column, J.overall([F.col(f"`{c}`") for c in judge_columns(df)]))


def judge_agreement(df: DataFrame, judge: str, human: str) -> DataFrame:
    """Confusion counts, accuracy and Cohen's kappa of a yes/no judge against human yes/no labels."""
    both = df.filter(F.col(judge).isNotNull() & F.col(human).isNotNull())

    def cell(j: str, h: str) -> Column:
        return F.count_if((F.col(judge) == j) & (F.col(human) == h))

    table = both.agg(
        cell("yes", "yes").alias("both_yes"),
        cell("yes", "no").alias("judge_yes"),
        cell("no", "yes").alias("human_yes"),
        cell("no", "no").alias("both_no"),
    )
    n = F.col("both_yes") + F.col("judge_yes") + F.col("human_yes") + F.col("both_no")
    seen = (F.col("both_yes") + F.col("both_no")) / F.nullif(n, F.lit(0))
    yes = (F.col("both_yes") + F.col("judge_yes")) * (F.col("both_yes") + F.col("human_yes"))
    no = (F.col("both_no") + F.col("human_yes")) * (F.col("both_no") + F.col("judge_yes"))
    chance = (yes + no) / F.nullif(n * n, F.lit(0))
    kappa = (seen - chance) / F.nullif(1 - chance, F.lit(0.0))
    return table.select("*", seen.alias("accuracy"), kappa.alias("kappa"))


def term_frequency_topics(df: DataFrame, text: str, label: str, k: int, *, min_letters: int = 1) -> DataFrame:
    """The k most frequent words of each label, as `label, keywords`: a topic list made from data.

    Words of fewer than `min_letters` letters, which are mostly not about a topic, are no candidates.
    """
    spread = df.select(label, F.explode(words(text)).alias("word")).filter(F.length("word") >= min_letters)
    counted = spread.groupBy(label, "word").agg(F.count(F.lit(1)).alias("n"))
    best = top_per_group(counted, [label], [F.desc("n"), F.col("word")], k, F.col("word"), 16)
    ranked = best.groupBy(label).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("w"))
    return ranked.select(label, F.col("w.word").alias("keywords"))


def recall_of(
    retrieved: DataFrame, expected: DataFrame, item: str, key: str = "query_id", requests: DataFrame | None = None
) -> DataFrame:
    """Retrieval recall per request from one row per (request, document) on each side.

    Nothing is gathered per request, so a request that expects very many documents is no problem. With `requests`
    (one row per key) every request is returned; one that expects no document has a null recall.
    """
    hits = retrieved.select(key, item).distinct().withColumn("__hit", F.lit(1))
    wanted = expected.select(key, item).distinct()
    counted = wanted.join(hits, [key, item], "left").groupBy(key).agg(
        F.count(F.lit(1)).alias("expected"), F.count("__hit").alias("found")
    )
    if requests is not None:
        counted = requests.select(key).distinct().join(counted, key, "left").na.fill(0, ["expected", "found"])
    return counted.withColumn("recall", F.col("found") / F.nullif(F.col("expected"), F.lit(0)))
