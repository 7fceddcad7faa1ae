"""Evaluation sets: planning, generating, migrating, adding and revising rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions import text as X
from evalloom.functions.messages import tag_list
from evalloom.operators.metrics import dedup_first
from evalloom.operators.sampling import position_at_rank, segmented_lag
from evalloom.session import stage, stored
from evalloom.sources import append_stored, fold_kv, legacy_layout, read_stored

REQUEST = "What does {} state in part {}?"
GENERATED = "doc_uri string, question_no int, request string, expected_facts array<string>"


def plan_evals(
    docs: DataFrame, num_evals: int | None = None, *, per_doc: int = K.QUESTIONS_PER_DOC,
    position: str = "corpus_pos",
) -> DataFrame:
    """One row per question to write, numbered from 1 within its document.

    `num_evals` questions are spread evenly, the earlier documents taking the remainder; with fewer
    questions than documents the first documents get one each. Without `num_evals` every document gets
    `per_doc`. The document where the remainder ends is found on positions alone, so texts are not
    shuffled.
    """
    if num_evals is None:
        quota = F.lit(per_doc)
    else:
        last = position_at_rank(docs, lambda count: F.lit(num_evals) % count, position)
        total = docs.agg(F.count(F.lit(1))).scalar()
        extra = F.when(F.col(position) <= last, F.lit(1)).otherwise(F.lit(0))
        quota = (F.floor(F.lit(num_evals) / total) + extra).cast("int")
    planned = docs.withColumn("quota", quota).filter(F.col("quota") > 0)
    return planned.withColumn("question_no", F.explode(F.sequence(F.lit(1), F.col("quota"))))


def eval_id(request: X.ColumnLike, source: X.ColumnLike) -> Column:
    """The id of an evaluation row that came without one."""
    return F.sha2(F.concat_ws("\n", X.as_column(request), X.as_column(source)), 256)


def generate_evals(
    planned: DataFrame, *, facts_per_question: int = 2,
    generator: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
) -> DataFrame:
    """Draft evaluation rows for planned questions `content, doc_uri, question_no`.

    By default question n of a document asks for its n-th group of `facts_per_question` sentences, and
    those are the expected facts. A `generator` gets batches of the plan and returns batches of
    `doc_uri, question_no, request, expected_facts`.
    """
    if generator is None:
        start = (F.col("question_no") - 1) * facts_per_question + 1
        facts = F.slice(X.sentences("content"), start, F.lit(facts_per_question))
        request = F.format_string(REQUEST.replace("{}", "%s"), "doc_uri", F.col("question_no").cast("string"))
        drafted = planned.select(
            "doc_uri", "question_no", request.alias("request"), facts.alias("expected_facts")
        )
    else:
        drafted = planned.select("content", "doc_uri", "question_no").mapInPandas(generator, GENERATED)
    return drafted.select(
        eval_id("request", "doc_uri").alias("request_id"),
        "request",
        "expected_facts",
        F.array(F.struct(F.col("doc_uri"))).alias("expected_retrieved_context"),
        F.lit(K.SYNTHETIC_SOURCE).alias("source_type"),
        F.col("doc_uri").alias("source_id"),
    )


def facts_from_answer(answer: X.ColumnLike) -> Column:
    """The distinct sentences of an answer, in order."""
    return F.array_distinct(X.sentences(answer))


def migrate_evals(old: DataFrame) -> DataFrame:
    """Legacy evaluation rows in the current layout, as one projection.

    Grading notes extend the expected facts; a response is turned into facts, replacing what was there,
    only if there are no notes. Columns the old table lacks count as null.
    """
    columns = set(old.columns)

    def old_column(name: str, kind: str = "string") -> Column:
        return F.col(name) if name in columns else F.lit(None).cast(kind)

    no_strings = F.array().cast("array<string>")
    facts = F.coalesce(old_column("expected_facts", "array<string>"), no_strings)
    response = X.first_filled(old_column("expected_response"), old_column("ground_truth"))
    notes = X.first_filled(old_column("grading_notes"))
    kind = X.source_type(old_column("source_type"), old_column("request_source"))
    origin = F.when(kind == K.SYNTHETIC_SOURCE, old_column("synthetic_source_doc_id")).otherwise(
        old_column("created_by")
    )
    tags = no_strings
    if "tags" in columns:
        structs = old.schema["tags"].dataType.elementType.typeName() == "struct"
        tags = F.coalesce(tag_list("tags", structs), no_strings)
    return old.select(
        old_column("request_id").alias("request_id"),
        old_column("request").alias("request"),
        F.lit(None).cast("string").alias("expected_response"),
        F.when(notes.isNotNull(), F.concat(facts, X.parse_notes(notes)))
        .when(response.isNotNull(), facts_from_answer(response))
        .otherwise(facts)
        .alias("expected_facts"),
        old_column("expected_retrieved_context", "array<struct<doc_uri:string>>").alias(
            "expected_retrieved_context"
        ),
        kind.alias("source_type"),
        F.coalesce(X.first_filled(old_column("source_id")), origin).alias("source_id"),
        tags.alias("tags"),
        X.first_filled(old_column("review_status"), old_column("status")).alias("review_status"),
    )


def new_evals(existing: DataFrame, evals: DataFrame) -> DataFrame:
    """The rows of `evals` the dataset lacks, one per id; rows without an id get one from their content."""
    request_id = X.first_filled("request_id") if "request_id" in evals.columns else F.lit(None)
    identified = evals.withColumn(
        "request_id", F.coalesce(request_id, eval_id("request", "source_id"))
    )
    once = dedup_first(identified, "request_id", F.col("request"), F.col("source_id"))
    return once.join(existing.select("request_id"), "request_id", "left_anti")


def add_evals(existing: DataFrame, evals: DataFrame) -> DataFrame:
    """The dataset with the new rows added; adding the same rows again changes nothing."""
    return existing.unionByName(new_evals(existing, evals), allowMissingColumns=True)


def migrate_dataset(spark: SparkSession, old: str, path: str) -> DataFrame:
    """Bring the legacy dataset `old` into the dataset stored at `path`, and return its metadata, one row per key.

    The catalog has either a table `old` of keys and values beside the rows `old_view`, or the rows `old` beside
    `old_metadata`; `old_tags` holds the tag names, if there is one. Rows are converted by `migrate_evals` and appended to
    `path/evals`, tag names to `path/tags`; what is there already is not added again, so a migration may be repeated.
    """
    if legacy_layout(spark.table(old).columns) == "metadata":
        rows, metadata = spark.table(f"{old}_view"), spark.table(old)
    else:
        rows, metadata = spark.table(old), spark.table(f"{old}_metadata")
    parts = {"evals": (migrate_evals(rows), new_evals)}
    if spark.catalog.tableExists(f"{old}_tags"):
        parts["tags"] = (tag_names_of(spark.table(f"{old}_tags")), lambda held, new: new.join(held, "tag_name", "left_anti"))
    for name, (converted, missing) in parts.items():
        held = read_stored(spark, f"{path}/{name}") if stored(spark, f"{path}/{name}") else spark.createDataFrame([], converted.schema)
        # Staged, since the rows are appended to the table that they are compared with.
        append_stored(stage(missing(held, converted), f"migrated-{name}"), f"{path}/{name}")
    return fold_kv(metadata)


def tag_names_of(tags: DataFrame) -> DataFrame:
    """Distinct names of a table of tags."""
    return tags.select("tag_name").filter("tag_name IS NOT NULL").distinct()


def latest_revision(history: DataFrame, key: str = "request_id", revision: str = "revision") -> DataFrame:
    """The newest version of each evaluation row."""
    return dedup_first(history, key, F.desc(revision))


def revision_diff(
    history: DataFrame, column: str, key: str = "request_id", revision: str = "revision"
) -> DataFrame:
    """The revisions that changed `column`, with the value before; a row's first revision counts as one."""
    lagged = segmented_lag(history, key, revision, [revision, column])
    first = F.col(f"prev_{revision}").isNull()
    changed = ~F.col(column).eqNullSafe(F.col(f"prev_{column}"))
    return lagged.filter(first | changed).select(
        key, revision, F.col(f"prev_{column}").alias("before"), F.col(column).alias("after")
    )
