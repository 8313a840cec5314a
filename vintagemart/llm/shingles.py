"""Words and word shingles of whole texts as 64-bit hashes, for use inside tasks.

Words are the maximal runs of bytes other than ASCII white space, after A-Z are
lower-cased, which is what ``bytes.lower().split()`` yields on UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Words remembered per worker before the memory starts anew.
REMEMBERED_WORDS = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """word -> 64-bit hash, worked out once per word and worker."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = value
        return value

    def of(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    out = values ^ (values >> np.uint64(31))
    out = out * _MIX
    out = out ^ (out >> np.uint64(29))
    out = out * _STEP
    return out ^ (out >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words, in text order; a shorter text is one
    shingle of all its words, an empty one has none."""
    if not len(words):
        return words
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for place in range(width):
        total = mixed(total + words[place : place + len(total)])
    return total


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 of a string column without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list<int64> column; unsigned hashes keep their bits."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, flat.view(np.int64))


def list_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a list<int64> column as unsigned arrays, without copies."""
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    start = 0
    for end in ends:
        yield flat[start:end]
        start = end
