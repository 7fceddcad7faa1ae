"""Plain restatements of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

FOLDED = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())


def plain_words(text):
    return FOLDED.findall(lower(text))


def spaced_words(text):
    return SPACED.findall(lower(text))


def crc(text):
    return zlib.crc32((text or "").encode())


def fold(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def top(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.top(a)] = self.top(b)


def shingles(text, width=5):
    words = spaced_words(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_text(rows, percent=75):
    """(doc_id, text) -> per row (doc_id, size, component)."""
    sets = [shingles(t) for _, t in rows]
    groups = Groups(len(rows))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                groups.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            top = groups.top(i)
            least[top] = min(least.get(top, doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(groups.top(i))) for i, (doc_id, _) in enumerate(rows)]


def repeats(rows, length=50):
    """(doc_id, text) -> per row (doc_id, bytes, removed, runs, digest)."""
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in texts:
        for p in range(len(t) - length + 1):
            window = t[p : p + length]
            least[window] = min(least.get(window, i), i)
    out = []
    for (doc_id, _), (i, t) in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if least[t[p : p + length]] < i:
                gone[p : p + length] = b"\x01" * length
        kept = bytes(x for x, y in zip(t, gone, strict=True) if not y)
        runs = sum(1 for p, y in enumerate(gone) if y and (p == 0 or not gone[p - 1]))
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def benchmark_hits(rows, items, window=10):
    """(doc_id, text), (item_id, text) -> per row (doc_id, words, hits, items, digest, contaminated)."""
    windows = {}
    for item, text in items:
        words = plain_words(text)
        n = min(window, len(words))
        for p in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[p : p + n]), set()).add(item)
    widths = {len(x) for x in windows}
    out = []
    for doc_id, text in rows:
        words = plain_words(text)
        hit, found = set(), set()
        for n in widths:
            for p in range(len(words) - n + 1):
                key = tuple(words[p : p + n])
                if key in windows:
                    hit.update(range(p, p + n))
                    found |= windows[key]
        ids = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(ids), digest, bool(hit)))
    return out
