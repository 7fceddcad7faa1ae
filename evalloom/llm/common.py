"""Rows, words and bytes shared by the operators of this folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalloom.session import stage

LETTERS_DIGITS = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
# A-Z to lower case; what is neither an ASCII letter or digit nor part of a longer character becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in LETTERS_DIGITS else 32 for b in range(256))
GOLDEN = 0x9E3779B97F4A7C15


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """`row` and the named columns alone, so that no other column of the table can clash.

    `row` depends only on the place of a row in its partition: a stored table that is read again, or a lost
    task that runs again, gives every row the same number.
    """
    return df.select(F.monotonically_increasing_id().alias("row"), *columns)


def fixed(df: DataFrame) -> DataFrame:
    """The table for operators that read it more than once and know its rows by `row`.

    What a shuffle computes may come in another order on a second run, so it is written first.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return stage(df, "fixed") if "Exchange" in plan or "Python" in plan or "Arrow" in plan else df


def settle() -> None:
    """Give back what a task no longer needs: workers stay, and would hold on to their largest arrays."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def settled(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run`, and then `settle`."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        settle()

    return both


def plain_words(text: bytes) -> list[bytes]:
    """Lower-case words of letters, digits and characters beyond ASCII."""
    return text.translate(FOLD).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Lower-case words between ASCII white space."""
    return text.lower().split()


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def portions(values: list[bytes | None], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about `most` bytes each; a longer text is a range of its own."""
    start = size = 0
    for i, value in enumerate(values):
        n = len(value) if value else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(values):
        yield start, len(values)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    firsts = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(firsts, counts) + np.repeat(starts, counts)
