"""Deterministic judges as Columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalloom.functions.text import ColumnLike, as_column, words

# Personal data, in the regex subset Java and RE2 share.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z]",
    "phone": r"\+?[0-9]{1,3}[ .-]\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
    "card": r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}",
    "ip": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "secret": r"(?i)(api[_-]?key|password|secret|token)[\"']?[ ]*[:=][ ]*[\"']?[A-Za-z0-9_/+-]{8,}",
}


def fact_coverage(response: ColumnLike, facts: ColumnLike) -> Column:
    """Share of the facts that the response holds, letter case aside; null without facts."""
    facts = as_column(facts)

    def held(text: Column) -> Column:
        return F.filter(facts, lambda fact: F.contains(text, F.lower(fact)))

    # The lambda variable holds the lowered response, so it is lowered once and not once per fact.
    hits = F.transform(F.array(F.lower(as_column(response))), lambda text: F.size(held(text)))[0]
    return F.when(F.size(facts) > 0, hits / F.size(facts))


def correctness(response: ColumnLike, facts: ColumnLike) -> Column:
    """Whether the response holds every fact; null without facts."""
    return fact_coverage(response, facts) == 1.0


def retrieval_recall(retrieved: ColumnLike, expected: ColumnLike) -> Column:
    """Share of the expected documents that were retrieved; null if none is expected."""
    wanted = F.array_distinct(as_column(expected))
    found = F.array_intersect(wanted, as_column(retrieved))
    return F.when(F.size(wanted) > 0, F.size(found) / F.size(wanted))


def token_overlap(claim: ColumnLike, support: ColumnLike) -> Column:
    """Share of the distinct words of `claim` that occur in `support`; null without words."""
    claimed = F.array_distinct(words(claim))
    shared = F.array_intersect(claimed, words(support))
    return F.when(F.size(claimed) > 0, F.size(shared) / F.size(claimed))


def groundedness(response: ColumnLike, context: ColumnLike) -> Column:
    return token_overlap(response, context)


def query_relevance(query: ColumnLike, response: ColumnLike) -> Column:
    return token_overlap(query, response)


def names_any(text: ColumnLike, terms: Sequence[str]) -> Column:
    """Whether the text holds one of the terms, letter case aside."""
    lowered = F.lower(as_column(text))
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(lowered, F.lit(term.lower()))
    return found


def pii_counts(text: ColumnLike) -> dict[str, Column]:
    """Occurrences of each kind of personal data."""
    return {
        kind: F.regexp_count(as_column(text), F.lit(pattern)).alias(kind)
        for kind, pattern in PII_PATTERNS.items()
    }


def pii_score(text: ColumnLike) -> Column:
    """5 if the text holds no personal data, 1 if it does, null for null."""
    text = as_column(text)
    found = F.lit(False)
    for pattern in PII_PATTERNS.values():
        found = found | text.rlike(pattern)
    return F.when(found, F.lit(1)).when(text.isNotNull(), F.lit(5))


def yes_no(passed: ColumnLike) -> Column:
    passed = as_column(passed)
    return F.when(passed, F.lit("yes")).when(~passed, F.lit("no"))


def overall(verdicts: Sequence[ColumnLike]) -> Column:
    """`no` if a verdict is no, `yes` if all that are given are yes, null if none is given."""
    given = F.filter(F.array(*[as_column(v) for v in verdicts]), lambda v: v.isNotNull())
    return F.when(F.size(given) > 0, yes_no(F.forall(given, lambda v: v == "yes")))


def topic_keyword(text: ColumnLike, topics: Mapping[str, Sequence[str]]) -> Column:
    """The topic with the most terms in the text; ties go to the earlier topic, no term at all to `other`.

    Without topics, or with `other` as the only one, every text is `other`.
    """
    named = {name: terms for name, terms in topics.items() if name.strip() and name != "other"}
    if not named:
        return F.lit("other")
    lowered = F.lower(as_column(text))
    scores = []
    for position, (name, terms) in enumerate(named.items()):
        score = sum((F.contains(lowered, F.lit(t.lower())).cast("int") for t in terms), F.lit(0))
        scores.append(F.struct(score.alias("score"), F.lit(-position).alias("order"), F.lit(name).alias("name")))
    best = F.array_max(F.array(*scores))
    return F.when(best["score"] > 0, best["name"]).otherwise(F.lit("other"))
