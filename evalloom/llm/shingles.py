"""Sets of word shingles as 64-bit numbers, and their PartEnum signatures."""

from __future__ import annotations

from functools import cache

import numpy as np

from evalloom.llm.common import GOLDEN, mix

WORDS = 5
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 5
SPREAD = 2.0  # shingles a partition holds on average in the largest sets of a band
RATIO = 3  # largest over smallest size of a band
ALL = (1 << 64) - 1
OWN, BELOW, SINGLE = 0, 1, 2  # what a signature is made of: a partition of the set's band, of the one below, a shingle
SKETCH = 512
SMALLEST = 3  # smaller sets are similar only if they are equal


@cache
def _letters() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHashes:
    """Numbers of the words of some texts, computed for all of them at once."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, text after text, and the count of words of each text."""
        joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        lower = joined + (((joined >= 65) & (joined <= 90)) * np.uint8(32))
        if len(self.up) <= len(joined):
            n = 1 << len(joined).bit_length()
            self.up, self.down = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)
        space = SPACES[joined]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(_letters()[lower] * self.up[: len(joined)], out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return words, np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))


def shingle_sets(words: np.ndarray, counts: np.ndarray, width: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text in order; of fewer words than `width` the whole text is one."""
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for i in range(width):
        total += words[i : i + len(total)] * factors[i]
    total = mix(total)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= width:
            found = np.sort(total[at : at + n - width + 1])
            sets.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        elif n:
            short = (words[at : at + n] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
            sets.append(mix(np.array([short], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
        at += n
    return sets


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return tuple(int(x.sum(dtype=np.uint64).view(np.int64)) for x in (mix(found + np.uint64(1)), mix(found ^ np.uint64(GOLDEN))))


def band(size: int) -> int:
    """Sets of a band differ in size by less than RATIO."""
    i, least = 0, SMALLEST
    while size >= least * RATIO:
        i, least = i + 1, least * RATIO
    return i


def partitions(i: int) -> int:
    return int(np.ceil(SMALLEST * RATIO ** (i + 1) / SPREAD))


def _signed(found: np.ndarray, hashed: np.ndarray, i: int) -> np.ndarray:
    """One signature for each partition of the domain of band i that holds a shingle of the set."""
    n = partitions(i)
    part = ((found >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)  # shingles are in order, so are their parts
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    sums = np.add.reduceat(hashed, first)
    return mix(sums + mix(part[first] + np.uint64((i + 1) * GOLDEN & ALL)))


def limits(size: int, similarity: float) -> tuple[int, int]:
    """How many partitions a similar set may spoil: of the set's own band, and of the band below, where only smaller
    sets are at home."""
    own = size * (1.0 - similarity) / similarity
    below = 2.0 * size * (1.0 - similarity) / (1.0 + similarity)
    return int(own + 1e-9), int(below + 1e-9)


def signatures(found: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set and their kinds, so that any two sets of Jaccard similarity >= `similarity` share one.

    Sets a and b, |a| <= |b|, differ in at most d = (1 - s) / (1 + s) (|a| + |b|) shingles. In a's band both see the
    domain in the same partitions, and each of these shingles spoils one partition at most. d is not above `limits`
    of a in its band, nor of b in either; so they agree on a partition that is not empty if one of the two fills
    more than its limit. A set that fills fewer signs each shingle as well: two such sets share one.
    A set signs in its own band, and in the one below if a set of that band can be similar to it.
    """
    size = len(found)
    if size < SMALLEST:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    hashed = mix(found ^ np.uint64(BASE))
    i = band(size)
    parts = [_signed(found, hashed, i)]
    if i and size * similarity < SMALLEST * RATIO**i:
        parts.append(_signed(found, hashed, i - 1))
    if any(len(x) <= most for x, most in zip(parts, limits(size, similarity), strict=False)):
        parts += [np.empty(0, np.uint64)] * (2 - len(parts)) + [mix(hashed + np.uint64(3))]
    return np.concatenate(parts), np.repeat(np.arange(len(parts), dtype=np.uint8), [len(x) for x in parts])


def sketch(found: np.ndarray) -> np.ndarray:
    """SKETCH parities as 64-bit words. Two sets differ in at least as many shingles as their parities differ."""
    bit = (mix(found + np.uint64(5)) % np.uint64(SKETCH)).astype(np.int64)
    odd = (np.bincount(bit, minlength=SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def wide_sketch(found: np.ndarray) -> bytes | None:
    """Parities of a set that is large for SKETCH bits: at least as many as it has shingles, a power of two."""
    if len(found) <= SKETCH // 2:
        return None
    bits = 1 << (len(found) - 1).bit_length()
    bit = (mix(found + np.uint64(5)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """In how many shingles two sets differ at least, by their wide sketches; the longer one is folded."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())
