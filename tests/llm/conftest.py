import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = "long words " * 6000
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, `class` long, bucket int, "
    "chunk long, label string, n long, u long, v long, component long, __bucket long, signature long"
)


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and long texts, equal rows, equal ids, near copies, shared passages."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "Über", "ÉTÉ", "naïve", "x-y", "1.5"]
    base = sentence(rng, 60, words)
    passage = sentence(rng, 25, words)
    rows = [
        (1, base, "en", "a"), (1, base, "en", "a"), (None, base, None, None), (2, None, "en", "a"), (3, "", "de", ""),
        (4, "   \n\t ", "en", None), (5, "one", "de", "b"), (6, "One", "de", "b"), (7, LONG, "en", "a"), (8, LONG, "en", "a"),
        (9, "日本語 テキスト 😀 " * 12, None, "c"), (None, None, None, None), (10, "a b c d e", "en", "b"), (11, "A b C d E", "en", "b"),
        (12, "42 -- 17", "de", "b"), (-3, base.upper(), "en", "b"),
    ]
    for i in range(20, 60):
        copy = base.split(" ")
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((i, " ".join(copy), "en", "a"))
    for i in range(60, 90):
        own = sentence(rng, 40, words)
        rows.append((i, f"{own} {passage} {sentence(rng, 20, words)}", rng.choice(["en", "de"]), rng.choice("abc")))
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows, tmp_path_factory):
    full = [(i, t, lang, s, None if t is None else len(t), 7, 7, 7, 7, "x", 7, 7, 7, 7, 7, 7) for i, t, lang, s in messy_rows]
    path = str(tmp_path_factory.mktemp("messy") / "docs")
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


