"""Hard negatives."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evalloom.llm import hard_negatives as H

KIND = "vec_id long, label string, vector array<long>, point long, tile int, dims int, block int, id int, low int, windows int"


def brute(rows, anchors, positives=5, negatives=5, least=80, most=100):
    good = [(i, *r) for i, r in enumerate(rows) if r[1] is not None and r[2] is not None and None not in r[2]]
    out = []

    def first(found, k):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

    for n, i, label, v in good:
        if not anchors(i):
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=True)), j, own) for m, j, own, w in good if m != n and len(v) == len(w)]
        for score, positive, _ in first([x for x in scores if x[2] == label], positives):
            inside = [x for x in scores if x[2] != label and least * score <= 100 * x[0] <= most * score]
            out += [(i, positive, k, x[1], score, x[0]) for k, x in enumerate(first(inside, negatives), 1)]
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 200), st.integers(0, 5))
def test_pages_hold_every_row_and_boxes_hold_their_points(seed, n, dims):
    rng = np.random.default_rng(seed)
    points = rng.integers(-9, 9, (n, dims))
    pages = H.packed(points, np.arange(n), page=4)
    assert sorted(np.concatenate(pages).tolist()) == list(range(n)) and max(map(len, pages)) <= 4
    low, high = (np.array([f(points[p], axis=0) for p in pages]) for f in (np.min, np.max))
    forest = H.Forest(["x"] * len(pages), low, high)
    anchors = rng.integers(-9, 9, (3, dims))
    least, most = forest.bounds(anchors)
    products = anchors @ points.T
    for a in range(3):
        assert least[a, forest.roots["x"]] <= products[a].min() and products[a].max() <= most[a, forest.roots["x"]]
        for i, p in enumerate(pages):
            assert least[a, i] <= products[a, p].min() and products[a, p].max() <= most[a, i]


def test_boxes_outside_the_window_stay_closed():
    points = np.array([[x, 0] for x in range(64)])
    pages = H.packed(points, np.arange(64), page=4)
    low, high = (np.array([f(points[p], axis=0) for p in pages]) for f in (np.min, np.max))
    forest = H.Forest(["x"] * len(pages), low, high)
    least, most = (x[0].tolist() for x in forest.bounds(np.array([[1, 0]])))
    opened = []

    def scores(leaf):
        opened.append(leaf)
        return [(int(points[i][0]), int(i), int(i)) for i in pages[leaf]]

    found = H.nearest(forest, list(forest.roots.values()), least, most, scores, 10, 21, 3, -1)
    assert [x[2] for x in found] == [21, 20, 19] and len(opened) == 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for i in range(400):
        label = rng.choice("aaabcd")
        base = [(ord(label) - 96) * 3 + j for j in range(6)]
        out.append((i, label, [x + rng.randrange(-6, 7) for x in base]))
    out += [(i, "a", [4, 4, 4, 4, 4, 4]) for i in range(400, 440)] + [(401, "b", [4, 4, 4, 4, 4, 4]), (401, "b", [4, 4, 4, 4, 4, 4])]
    out += [(None, "a", [9, 9, 9, 9, 9, 9]), (450, None, [1] * 6), (460, "a", None), (470, "a", [1, None, 1, 1, 1, 1])]
    out += [(480, "a", [3, 3]), (490, "b", [3, 3]), (500, "a", []), (510, "b", []), (520, "a", []), (530, "c", [-9] * 6)]
    return out


@pytest.mark.parametrize(("tile", "block"), [(64, 7), (4096, 512)])
def test_gives_the_brute_force_rows(spark, rows, tile, block):
    df = spark.createDataFrame([(*r, 7, 7, 7, 7, 7, 7, 7) for r in rows], KIND).repartition(3)
    found = H.mine(df, F.col("vec_id") % 10 == 0, tile=tile, block=block).collect()
    key = lambda x: tuple((y is None, y or 0) for y in x)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows, lambda i: i is not None and i % 10 == 0), key=key)


def test_large_numbers_and_nothing(spark):
    big = [(0, "a", [2**30, 3]), (1, "a", [2**31, 1]), (2, "b", [2**31 - 1, 7]), (3, "b", [2**29, 7])]
    kind = "vec_id long, label string, vector array<long>"
    found = H.mine(spark.createDataFrame(big, kind), F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, found)) == sorted(brute(big, lambda i: i == 0))
    assert H.mine(spark.createDataFrame([], kind), F.col("vec_id") == 0).collect() == []
    assert H.mine(spark.createDataFrame(big, kind), F.lit(None).cast("boolean")).collect() == []


def test_whole_numbers(one):
    value = lambda v: one(H.whole_numbers("a"), "a array<float>", (v,))
    assert value([0.5, -0.001, 0.0]) == [128, -1, 0] and value([]) == []
    assert value(None) is None and value([1.0, None]) is None and value([float("nan")]) is None and value([float("-inf")]) is None
