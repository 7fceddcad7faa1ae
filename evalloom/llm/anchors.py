"""Windows of bytes and the anchor each of them is known by: what stands around the least of its k-grams."""

from __future__ import annotations

import numpy as np

from evalloom.llm.common import GOLDEN, mix
from evalloom.llm.shingles import BASE, powers

GRAM = 20
PLACE = np.uint64((1 << 32) - 1)


class Anchors:
    """Runs of neighbouring windows with one anchor. Equal windows have equal anchors, wherever they are.

    The least k-gram of a window is the first of those with the smallest 32 bits of their numbers. It lies in the earlier
    or the later half of the places it may have. All windows around one gram that have it in the same half also share
    the bytes on its longer side: the anchor is the number of these bytes, about 35 of a window of 50.
    """

    def __init__(self, length: int, gram: int = GRAM):
        self.length, self.gram = length, min(gram, length)
        self.up = self.down = np.ones(1, np.uint64)
        self.letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each run: its text, the place of its first window there, its number of windows, its anchor."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = np.frombuffer(b"".join(texts), np.uint8)
        n = len(joined) - self.length + 1
        if n <= 0:
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
        if len(self.up) <= len(joined):
            room = 1 << len(joined).bit_length()
            self.up, self.down = powers(BASE, room), powers(pow(BASE, -1, 1 << 64), room)
        sums = np.zeros(len(joined) + 1, np.uint64)
        signs = self.letters[joined]
        signs *= self.up[: len(joined)]
        np.cumsum(signs, out=sums[1:])
        least = sums[self.gram :] - sums[: -self.gram]
        least *= self.down[: len(least)]
        least = mix(least)
        # The place in the lower half: the first of equal grams is the least, and tells where it is.
        least &= ~PLACE
        least |= np.arange(len(least), dtype=np.uint64)
        width, reach = 1, self.length - self.gram + 1
        while 2 * width <= reach:
            least = np.minimum(least[: len(least) - width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
        # A window belongs to the text it starts in, if it ends there too.
        ends = np.cumsum(sizes)
        new = np.ones(n, bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        edges = np.concatenate([ends - sizes, np.maximum(ends - self.length + 1, 0)])
        new[edges[edges < n]] = True
        first = np.flatnonzero(new)
        after = np.append(first[1:], n)
        kept = first + self.length <= ends[np.searchsorted(ends, first, "right")]
        first, after = first[kept], after[kept]
        at = (least[first] & PLACE).astype(np.int64)
        # The windows that start at least `half` bytes before the gram, and the others.
        half = reach // 2
        cut = np.clip(at - half + 1, first, after)
        start, stop = np.stack([first, cut], 1).ravel(), np.stack([cut, after], 1).ravel()
        left = np.stack([at - half, at], 1).ravel()
        right = np.stack([at + self.gram, at - half + 1 + self.length], 1).ravel()
        late = np.tile(np.array([0, 1], np.uint64), len(at))
        some = stop > start
        start, stop, left, right, late = (x[some] for x in (start, stop, left, right, late))
        anchor = mix(((sums[right] - sums[left]) * self.down[left]) ^ late)
        # Around a gram that follows itself, as in "ab ab ab", runs with one anchor follow each other.
        text = np.searchsorted(ends, start, "right")
        if len(start):
            head = np.ones(len(start), bool)
            head[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != stop[:-1]) | (text[1:] != text[:-1])
            stop = stop[np.append(np.flatnonzero(head)[1:], len(start)) - 1]
            text, start, anchor = text[head], start[head], anchor[head]
        return text, start - (ends - sizes)[text], stop - start, anchor
