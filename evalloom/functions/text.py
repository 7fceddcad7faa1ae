"""String, date and rating columns."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalloom import constants as K

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: ColumnLike) -> Column:
    """Remove outer white space of any kind. (`trim` removes blanks only.)"""
    return F.trim(as_column(value), F.lit(K.PY_SPACE_CHARS))


def translate_sku(sku: ColumnLike) -> Column:
    """`OLD-ABC-1234` becomes `NEW-1234-ABC`; any other text becomes an error text, null stays null."""
    sku = as_column(sku)
    swapped = F.concat(
        F.lit("NEW-"),
        F.regexp_extract(sku, K.SKU_PATTERN, 2),
        F.lit("-"),
        F.regexp_extract(sku, K.SKU_PATTERN, 1),
    )
    return F.when(sku.rlike(K.SKU_PATTERN), swapped).when(sku.isNotNull(), F.lit(K.SKU_ERROR))


def parse_keywords(answer: ColumnLike) -> Column:
    """Split a comma-separated answer into trimmed keywords without blank ones."""
    parts = F.transform(F.split(as_column(answer), ","), strip)
    return F.filter(parts, lambda word: word != "")


def words(text: ColumnLike) -> Column:
    """Lower-case runs of letters and digits, in order, repeats included."""
    parts = F.split(F.lower(as_column(text)), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda word: word != "")


def sentences(text: ColumnLike) -> Column:
    """Stripped, non-blank pieces between line ends or sentence marks."""
    parts = F.transform(F.split(as_column(text), r"[.!?\n]+"), strip)
    return F.filter(parts, lambda part: part != "")


def render_notes(facts: ColumnLike) -> Column:
    """Grading notes: the fixed heading, then one `- fact` line per fact. No facts give null."""
    facts = as_column(facts)
    body = F.concat(F.lit(K.NOTES_HEADER + "\n- "), F.array_join(facts, "\n- "))
    return F.when(F.size(facts) > 0, body)


def _undash(line: Column) -> Column:
    return strip(F.ltrim(line, F.lit("- ")))


def parse_notes(notes: ColumnLike) -> Column:
    """Facts held in grading notes: the heading line goes, and dashes, blanks and empty lines go."""
    notes = as_column(notes)
    lines = F.split(notes, "\n")
    body = F.when(
        _undash(notes).startswith(K.NOTES_PREFIX), F.slice(lines, F.lit(2), F.size(lines))
    ).otherwise(lines)
    return F.filter(F.transform(body, _undash), lambda line: line != "")


def first_filled(*columns: ColumnLike) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(as_column(c), F.lit("")) for c in columns])


def source_type(*columns: ColumnLike) -> Column:
    """Which kind of source the first filled column names; a mention of a human counts first."""
    named = F.lower(first_filled(*columns))
    return F.when(named.contains("human"), F.lit(K.HUMAN_SOURCE)).when(
        named.contains("synthetic"), F.lit(K.SYNTHETIC_SOURCE)
    )


def principal_slug(principal: ColumnLike) -> Column:
    """The part of an address before `@`, with dots as underscores."""
    return F.translate(F.substring_index(as_column(principal), "@", 1), ".", "_")


def quote_ident(name: ColumnLike) -> Column:
    """Back-quote every part of a dotted name."""
    parts = F.transform(F.split(as_column(name), r"\."), lambda p: F.concat(F.lit("`"), p, F.lit("`")))
    return F.array_join(parts, ".")


def tool_name(name: ColumnLike) -> Column:
    """A dotted name with `__` for each dot, as tool-calling models require."""
    return F.replace(as_column(name), F.lit("."), F.lit("__"))


def folder_name(name: ColumnLike) -> Column:
    """A dotted name as a path."""
    return F.replace(as_column(name), F.lit("."), F.lit("/"))


def pct(rate: ColumnLike) -> Column:
    """A rate in [0, 1] as whole-percent text."""
    return F.format_string("%.0f%%", as_column(rate) * 100)


def hour_of(ts: ColumnLike) -> Column:
    return F.date_trunc("hour", as_column(ts))


def pass_flag(rating: ColumnLike) -> Column:
    """1 for yes, 0 for no, null for anything else."""
    rating = as_column(rating)
    return F.when(rating == "yes", F.lit(1)).when(rating == "no", F.lit(0))


def keyword_score(text: ColumnLike, keywords: Sequence[str]) -> Column:
    """How many of `keywords` the text holds, letter case aside.

    A keyword may match inside a word, a repeated keyword counts each time, and the empty keyword is in
    every text.
    """
    lowered = F.lower(as_column(text))
    score = F.lit(0)
    for keyword in keywords:
        score = score + F.contains(lowered, F.lit(keyword.lower())).cast("int")
    return score


def place_prompt(messages: ColumnLike, prompt: ColumnLike, place: str = "user") -> Column:
    """Put `prompt` in place of the last user turn, or in the system message.

    With `place="system"` a system message that is already there is replaced, so the prompt is never lost.
    """
    messages, prompt = as_column(messages), as_column(prompt)
    made = F.array(F.struct(F.lit(place).alias("role"), prompt.alias("content")))
    size = F.size(messages)
    if place == "user":
        return F.concat(F.slice(messages, F.lit(1), F.greatest(size - 1, F.lit(0))), made)
    if place == "system":
        has_system = F.try_element_at(messages, F.lit(1))["role"] == "system"
        rest = F.when(has_system, F.slice(messages, F.lit(2), size)).otherwise(messages)
        return F.concat(made, rest)
    raise ValueError(f"place must be 'user' or 'system', not {place!r}")


def fill_template(template: str, **values: ColumnLike) -> Column:
    """A template with named slots such as `{context}` filled per row. A null value gives null."""
    parts = []
    for literal, slot, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if slot is not None:
            if slot not in values:
                raise ValueError(f"nothing to fill {{{slot}}} with")
            parts.append(as_column(values[slot]))
    return F.concat(*parts) if parts else F.lit("")


def fill_prompt(context: ColumnLike, question: ColumnLike, template: str = K.PROMPT) -> Column:
    """The prompt that puts a question after its context."""
    return fill_template(template, context=context, user_query=question)
