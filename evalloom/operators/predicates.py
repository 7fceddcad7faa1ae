"""Projections and filters."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalloom import constants as K


def as_docs(df: DataFrame, content: str, uri: str) -> DataFrame:
    """Any corpus as `content, doc_uri`."""
    return df.select(
        F.col(content).cast("string").alias("content"), F.col(uri).cast("string").alias("doc_uri")
    )


def expected_uris(df: DataFrame, column: str = "expected_retrieved_context") -> DataFrame:
    """Replace the array of expected-context structs by the array of their `doc_uri`s."""
    return df.withColumn(column, F.col(f"{column}.doc_uri"))


def with_status_columns(df: DataFrame) -> DataFrame:
    """Add the typed null columns an unjudged request starts with."""
    return df.withColumns(
        {"run_id": F.lit(None).cast("string"), K.PRECISION_COLUMN: F.lit(None).cast("double")}
    )


def with_run_columns(df: DataFrame, key: str, run_id: str, experiment_id: str) -> DataFrame:
    """Stamp judged rows with their run, and drop what the request log already holds."""
    stamped = df.withColumns(
        {
            "run_id": F.lit(run_id),
            "experiment_id": F.lit(experiment_id),
            "topic": F.lit(None).cast("string"),
        }
    )
    return stamped.drop(*[c for c in ("request", "response", "trace") if c != key])


def result_columns(key: str, text: str, uri: str, extras: Sequence[str] = ()) -> list[str]:
    """Key, text, uri, then extras, each named once."""
    return list(dict.fromkeys([key, text, uri, *extras]))


def exclude_uri(df: DataFrame, paths: Sequence[str], uri: str = "doc_uri") -> DataFrame:
    """Drop documents whose URI holds one of `paths`: one alternation, so one regex pass per row.

    A document without a URI holds none of them and stays.
    """
    if not paths:
        return df
    listed = F.col(uri).rlike("|".join(re.escape(p) for p in paths))
    return df.filter(~F.coalesce(listed, F.lit(False)))


def by_review_status(df: DataFrame, status: str | None) -> DataFrame:
    """Rows in a review state; None selects the rows nobody has touched."""
    return df.filter(F.col("review_status").eqNullSafe(F.lit(status)))


def with_tag(df: DataFrame, tag: str) -> DataFrame:
    return df.filter(F.array_contains("tags", tag))


def since(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """Rows from `days` before `as_of` on."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def latest(df: DataFrame, ts: str) -> Column:
    """The greatest timestamp of a table, as a scalar subquery of the query that uses it."""
    return df.agg(F.max(ts)).scalar()


def unprocessed(df: DataFrame, run_id: str = "run_id") -> DataFrame:
    return df.filter(F.col(run_id).isNull())


def min_score(df: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Drop results below the threshold. Comes after the top-k, so fewer than k may be left."""
    return df.filter(F.col(score) >= threshold)


_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def _one_filter(field: str, wanted: Any) -> Column:
    column = F.col(field)
    if isinstance(wanted, Mapping):
        if len(wanted) != 1:
            raise ValueError(f"filter on {field!r} must name exactly one operator")
        ((name, operand),) = wanted.items()
        if name in _COMPARE:
            return _COMPARE[name](column, F.lit(operand))
        if name.upper() == "LIKE":
            return column.like(operand)
        if name.upper() == "NOT":
            return column != F.lit(operand)
        raise ValueError(f"unknown operator {name!r} on {field!r}")
    if isinstance(wanted, (list, tuple)):
        return column.isin(list(wanted))
    return column == F.lit(wanted)


def compile_filters(spec: Iterable[Mapping[str, Any]] | None, allowed: Iterable[str]) -> Column:
    """One predicate from a list of `{field, filter}` entries, which must all hold.

    A filter is a value (equal to it), a list (any of it), or one of `< <= > >= LIKE NOT` with its
    operand. An unknown field or operator raises. The predicate is plain Column code, so it reaches the
    parquet scan when applied before a search.
    """
    allowed = set(allowed)
    parts = []
    for entry in spec or ():
        if entry["field"] not in allowed:
            raise ValueError(f"cannot filter on {entry['field']!r}")
        parts.append(_one_filter(entry["field"], entry["filter"]))
    return functools.reduce(operator.and_, parts, F.lit(True))


def user_orders(orders: DataFrame, users: DataFrame, user: str, *columns: str) -> DataFrame:
    """Orders of every user in `users`: the lookup by user id, done for many users as one join."""
    return orders.join(users.select(user).distinct(), user).select(user, *columns)
