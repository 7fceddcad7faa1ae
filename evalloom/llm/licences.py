"""Licence scans: phrases by one Aho-Corasick automaton, tagged expressions by a shunting-yard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalloom.llm.common import as_bytes, plain_words

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notice phrases beside the base ones, as lower-case words.
NOTICES = {
    "lesser general public license": "lgpl", "affero general public license": "agpl", "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd", "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit-text", "all rights reserved": "reserved",
    "cc by": "cc-by", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by", "public domain": "public-domain",
}
TAG = "spdx license identifier"
TAGGED = re.compile(rb"SPDX-License-Identifier[ \t]*:[ \t]*([A-Za-z0-9.+()\- \t]*)", re.IGNORECASE)
TOKEN = re.compile(r"[()]|[^\s()]+")
# How far a licence restricts use: 0 free, 1 share changes of its files, 2 share the whole work, 3 not for all uses.
STRICT = (("agpl", 2), ("lgpl", 1), ("gpl", 2), ("mpl", 1), ("epl", 1), ("cc-by-nc", 3), ("cc-by-nd", 3), ("cc-by-sa", 2),
          ("reserved", 3), ("mit", 0), ("apache", 0), ("bsd", 0), ("isc", 0), ("cc0", 0), ("cc-by", 0),
          ("public-domain", 0), ("unlicense", 0))
RANK = {"or": 1, "and": 2, "with": 3}
# A tag names the licence; a phrase may only speak of one.
WEIGHTS = {"tag": 0.95, "base": 0.8, "notice": 0.6}
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expressions array<string>, strictness int"
)


def strictness(licence: str) -> int | None:
    name = licence.lower()
    return next((level for head, level in STRICT if name.startswith(head)), None)


def parse(expression: str) -> list[str] | None:
    """The expression in postfix order, operators in lower case; None if it is malformed. `with` binds closest."""
    output: list[str] = []
    stack: list[str] = []
    operand = True  # whether one is due
    for token in TOKEN.findall(expression):
        word = token.lower()
        if token == "(":
            if not operand:
                return None
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if operand or not stack:
                return None
            stack.pop()
        elif word in RANK:
            if operand:
                return None
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[word]:
                output.append(stack.pop())
            stack.append(word)
            operand = True
        else:
            if not operand:
                return None
            output.append(token)
            operand = False
    if operand or "(" in stack:
        return None
    return output + stack[::-1]


def parse_start(written: str) -> list[str] | None:
    """The postfix form of a tag's expression; of its longest valid start if prose follows on the same line.

    In such a start all licences but the first must be known ones, so that a word of the prose after `and` is none.
    """
    if (whole := parse(written)) is not None:
        return whole
    tokens = [t.rstrip(".") or t for t in TOKEN.findall(written)]
    depth, operand, before, complete = 0, True, "", 0
    for n, token in enumerate(tokens, 1):
        word = token.lower()
        if token == "(" if operand else token == ")":
            depth += 1 if operand else -1
        elif operand and token != ")" and word not in RANK and (before in ("", "with") or strictness(token) is not None):
            operand = False
        elif not operand and token != "(" and word in RANK:
            operand = True
        else:
            break
        before = word if token not in "()" else before or token
        if depth < 0:
            break
        if not operand and not depth:
            complete = n
    return parse(" ".join(tokens[:complete])) if complete else None


def evaluate(postfix: list[str]) -> tuple[set[str], int | None]:
    """The licences named, and the level of the whole: `or` lets the user choose, `and` binds to both.

    An exception after `with` loosens one level and is no licence. An unknown licence leaves the level open.
    """
    stack: list[tuple[set[str], int | None]] = []
    for token in postfix:
        if token not in RANK:
            stack.append(({token.lower()}, strictness(token)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, None if a is None else max(a - 1, 0)))
        elif token == "and":
            stack.append((left | right, None if a is None or b is None else max(a, b)))
        else:
            known = [x for x in (a, b) if x is not None]
            stack.append((left | right, min(known) if known else None))
    return stack[-1]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrases, kind in ((NOTICES, "notice"), (BASE, "base"), ({TAG: ""}, "tag")):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (len(phrase) + 2, kind, label))
    found.make_automaton()
    return found


def scan(text: bytes, phrases: ahocorasick.Automaton) -> tuple:
    words = plain_words(text)
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base, labels, kinds, places, tagged = set(), set(), {}, [], False
    for end, (length, kind, label) in phrases.iter(line):
        if kind == "tag":
            tagged = True
            continue
        labels.add(label)
        kinds[label] = max(kinds.get(label, 0), WEIGHTS[kind])
        if kind == "base":
            base.add(label)
            places.append(end - length + 1)
    expressions, level = [], None
    for match in TAGGED.finditer(text) if tagged else ():
        written = match.group(1).decode("ascii").strip()
        postfix = parse_start(written)
        if postfix:
            named, strict = evaluate(postfix)
            expressions.append(" ".join(postfix))
            level = strict if level is None else level if strict is None else max(level, strict)
            for name in named:
                labels.add(name)
                kinds[name] = WEIGHTS["tag"]
    first = last = None
    if places:
        # The line begins with a space, and one space comes before each word.
        first = line.count(" ", 0, min(places))
        last = first + line.count(" ", min(places), max(places))
    if level is None:
        known = [x for x in map(strictness, labels) if x is not None]
        level = max(known) if known else None
    doubt = 1.0
    for label in sorted(kinds):
        doubt *= 1.0 - kinds[label]
    return (
        len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)),
        1.0 - doubt if kinds else 0.0, expressions, level,
    )


def licence_scan(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Licence phrases and tags of every whole text, in one pass without a shuffle.

    `n_base` counts the places of the base phrases, `first_word` and `last_word` are their smallest and largest
    start; `labels` adds other notice phrases and the licences that tagged expressions name. `expressions` holds
    the tagged ones in postfix order; `strictness` is the level of the strictest (0 free to 3 closed). `score` is
    the belief that the text states a licence.

    Nulls: a null or empty text has no words, labels or places, and score 0; a null key stays null. Repeated rows
    are scanned each. An empty table gives no rows. Other columns are left out. Of an expression that prose follows
    the longest valid start is taken; malformed ones name nothing.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton()
        for batch in batches:
            found = [scan(x or b"", phrases) for x in as_bytes(batch.column("text"))]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                     pa.list_(pa.string()), pa.int32()]
            columns = list(zip(*found, strict=True)) or [[] for _ in types]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(columns, types, strict=True))],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(run, SCHEMA)
