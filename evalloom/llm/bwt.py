"""Long common prefixes of all suffixes of some byte strings, by backward extension on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

from evalloom.llm.common import ranges

MARK = 255  # ends a string; no byte of UTF-8 text


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of some numbers, and these in order. Sorting numbers that end in their places is far cheaper than argsort."""
    n = len(key)
    if n.bit_length() + bits <= 64:
        shift = np.uint64(n.bit_length())
        key = np.sort((key << shift) | np.arange(n, dtype=np.uint64))
        return (key & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64), key >> shift
    order = np.argsort(key)
    return order, key[order]


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places in order of the `depth` bytes from there on, around the end; ranks of a few bytes are doubled.

    Also where the first of those few bytes differ from the ones before in that order, and how many they are: at most `depth`.
    """
    n = len(text)
    known = np.bincount(text, minlength=256) > 0
    code = (np.cumsum(known) - 1).astype(np.uint64)[text]
    bits = max(1, int(known.sum() - 1).bit_length())
    width = max(1, min(depth, (64 - n.bit_length()) // bits))
    around = np.resize(code, n + width)
    key = np.zeros(n, np.uint64)
    for i in range(width):
        key = (key << np.uint64(bits)) | around[i : i + n]
    order, placed = _sorted(key, width * bits)
    few, first = width, None
    while True:
        new = np.concatenate([[True], placed[1:] != placed[:-1]])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new, dtype=np.uint64) - np.uint64(1)
        first = rank if first is None else first
        if width >= depth or rank[order[-1]] == n - 1:
            break
        order, placed = _sorted(rank * np.uint64(n) + np.roll(rank, -width % n), (n * n).bit_length())
        width *= 2
    first = first[order]
    return order, np.concatenate([[True], first[1:] != first[:-1]]), few


def deep_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and whether each suffix shares at least `length` bytes with the one before it.

    Breadth-first interval expansion: the interval of a string w is extended backward by each byte c of the
    transform within it, to that of cw. All strings of one length are done before the next, so common prefixes come
    out by increasing value: where an interval ends and no value is set yet, it is the length of w. Only intervals
    that set a value go on, hence each place is expanded a few times; values from `length` on are never worked out.
    The sort has the intervals of all strings of a few bytes, so it begins with these.
    """
    n = len(text)
    order, new, few = suffix_order(text, length)
    transform = text[order - 1]
    by_byte = np.argsort(transform, kind="stable")
    back = np.empty(n, np.int64)
    back[by_byte] = np.arange(n)
    first_byte = transform[by_byte]
    # A byte and a place in one number: places that follow each other in the same byte differ by one.
    step = np.arange(n) + first_byte.astype(np.int64)
    open_ = np.ones(n + 1, bool)
    low = np.flatnonzero(new)
    high = np.append(low[1:], n)
    open_[low] = open_[n] = False
    for _ in range(few, length):
        if not len(low):
            break
        size = high - low
        place = back[ranges(low, size)]
        both = np.sort((np.repeat(np.arange(len(low)), size) << np.int64(31)) | place)
        place, owner = both & np.int64((1 << 31) - 1), both >> np.int64(31)
        start = np.ones(len(place), bool)
        near = step[place]
        start[1:] = (near[1:] != near[:-1] + 1) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(start)
        low = place[at]
        high = place[np.append(at[1:], len(place)) - 1] + 1
        fresh = open_[high]
        low, high = low[fresh], high[fresh]
        open_[high] = False
    shared = open_[:n].copy()
    return order, shared


def least_of_equal(strings: list[bytes], values: np.ndarray, length: int) -> list[np.ndarray]:
    """For each window of `length` bytes of each string the least value of a string that has it."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    windows = np.maximum(sizes - length + 1, 0)
    place = ranges(begin, windows)
    top = np.iinfo(np.int64).max
    value = np.full(len(text), top)
    value[place] = np.repeat(values, windows)
    order, shared = deep_prefixes(text, length)
    # Suffixes without a whole window hold the largest value and change nothing.
    first = np.flatnonzero(~shared)
    least = np.minimum.reduceat(value[order], first)
    value[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    ends, value = np.cumsum(windows), value[place]
    return [value[a:b] for a, b in zip((ends - windows).tolist(), ends.tolist(), strict=True)]
