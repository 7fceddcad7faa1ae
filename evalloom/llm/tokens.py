"""Token numbers of texts, by a byte-level BPE vocabulary file."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

END = 0


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in prints}
    for n, b in enumerate(b for b in range(256) if b not in prints):
        letters[chr(256 + n)] = b
    return letters


class Tokens:
    """Encodes whole texts as the vocabulary file's own library does (the tests compare both), several times faster.

    Strings of special tokens are ordinary text. Loaded once per task, as it is not sent between processes.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        special = {token: n for token, n in vocabulary.items() if not set(token) <= letters.keys()}
        ranks = {bytes(letters[c] for c in token): n for token, n in vocabulary.items() if token not in special}
        self.encoding = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str | None) -> np.ndarray:
        """The numbers of a text and the end mark; of a null or empty text the end mark alone."""
        if not text:
            return np.array([END], "<u4")
        return np.append(self.encoding.encode_to_numpy(text, disallowed_special=()), np.uint32(END)).astype("<u4")


def pieces(total: int, width: int) -> Iterator[tuple[int, int]]:
    """Start and length of a document's pieces: full ones, then what is left. Each token lies in one piece."""
    for start in range(0, total, width):
        yield start, min(width, total - start)


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """One text at a time: a batch of long texts is not held twice."""
    for value in column:
        yield value.as_py()
