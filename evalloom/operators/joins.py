"""Joins, and the row-level updates that parquet tables have to do as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.operators.predicates import since

_HIT = "__hit"


def with_feedback(
    requests: DataFrame, assessments: DataFrame, as_of: Column, key: str = "request_id",
    ts: str = "timestamp", days: int = K.LOOKBACK_DAYS,
) -> DataFrame:
    """Ids of the unprocessed requests that got human feedback in the last `days`.

    Feedback is reduced to distinct ids before the join, so a request with very many assessments costs
    one row.
    """
    recent = since(assessments, ts, as_of, days).select(key).distinct()
    return requests.filter(F.col("run_id").isNull()).select(key).join(recent, key, "left_semi")


def mark(df: DataFrame, ids: DataFrame, value: str, key: str = "request_id", column: str = "run_id") -> DataFrame:
    """Set `column` to `value` on the rows whose id is in `ids`."""
    chosen = ids.select(key).distinct().withColumn(_HIT, F.lit(True))
    marked = df.join(chosen, key, "left")
    return marked.withColumn(
        column, F.when(F.col(_HIT), F.lit(value)).otherwise(F.col(column))
    ).drop(_HIT)


def _one_update_per_key(updates: DataFrame, key: str) -> DataFrame:
    fields = [F.col(f"`{c}`") for c in updates.columns]
    return updates.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*fields)).alias("__new")
    )


def _matched(key: str) -> Column:
    """True on rows with one update, null on rows with none; two updates of one row raise."""
    clash = F.raise_error(F.concat(F.lit(f"several updates for {key} "), F.col(key).cast("string")))
    return F.when(F.col("__n") > 1, clash.cast("boolean")).when(F.col("__n") == 1, F.lit(True))


def merge_matched(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """MERGE … WHEN MATCHED THEN UPDATE SET *, with schema evolution.

    A matched row takes every value of its update, nulls included; columns only the updates have are
    added and stay null on unmatched rows; updates without a target row are ignored. Updates are folded
    per key before the join, so the target never grows.
    """
    joined = target.join(_one_update_per_key(updates, key), key, "left").withColumn(_HIT, _matched(key))
    updated = [c for c in updates.columns if c != key]
    columns = []
    for name in target.columns:
        quoted = F.col(f"`{name}`")
        if name in updated:
            quoted = F.when(F.col(_HIT), F.col("__new")[name]).otherwise(quoted)
        columns.append(quoted.alias(name))
    for name in updated:
        if name not in target.columns:
            columns.append(F.when(F.col(_HIT), F.col("__new")[name]).alias(name))
    return joined.select(*columns)


def merge_set(target: DataFrame, updates: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """MERGE … WHEN MATCHED THEN UPDATE SET column = value, where `value` reads the target row."""
    hits = updates.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    joined = target.join(hits, key, "left").withColumn(_HIT, _matched(key))
    old = F.col(column) if column in target.columns else F.lit(None)
    return joined.withColumn(column, F.when(F.col(_HIT), value).otherwise(old)).drop(_HIT, "__n")


def remaining_docs(docs: DataFrame, evals: DataFrame, uri: str = "doc_uri", source: str = "source_id") -> DataFrame:
    """Documents no evaluation row was made from."""
    used = evals.select(F.col(source).alias(uri)).distinct()
    return docs.join(used, uri, "left_anti")


def with_source(evals: DataFrame, docs: DataFrame, source: str = "source_id", uri: str = "doc_uri") -> DataFrame:
    """Every evaluation row with the document it was made from, if that is still there."""
    return evals.join(docs.withColumnRenamed(uri, source), source, "left")


def compare_runs(before: DataFrame, after: DataFrame, key: str, passed: str = "passed") -> DataFrame:
    """Each request of two runs: better, worse, same, only_before or only_after.

    A request without a verdict in one run counts as not compared (`unknown`).
    """
    left = before.select(key, F.col(passed).alias("before"), F.lit(True).alias("in_before"))
    right = after.select(key, F.col(passed).alias("after"), F.lit(True).alias("in_after"))
    change = (
        F.when(F.col("in_after").isNull(), "only_before")
        .when(F.col("in_before").isNull(), "only_after")
        .when(F.col("before").isNull() | F.col("after").isNull(), "unknown")
        .when(F.col("before") == F.col("after"), "same")
        .when(F.col("after"), "better")
        .otherwise("worse")
    )
    return left.join(right, key, "full").select(key, "before", "after", change.alias("change"))
