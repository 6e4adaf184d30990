"""Texts as bytes inside Arrow batches: iteration, words, and word hashes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: What one step of an Arrow function takes at once, whatever the size of a batch.
CHUNK_BYTES = 4 << 20


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column, None for null."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def in_chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a list of texts that hold about ``limit`` bytes; a longer text is alone."""
    start, held = 0, 0
    for row, text in enumerate(texts):
        size = len(text or b"")
        if held and held + size > limit:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased: what bytes.split and bytes.lower do."""
    return (text or b"").lower().split()


class WordHashes(dict):
    """word -> 64-bit hash, remembered for up to ``most`` words (a cache, not a vocabulary)."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        self[word] = found
        return found


#: Odd multipliers, one for each place in a shingle.
_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93],
    dtype=np.uint64,
)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(32))


def shingle_hashes(text: bytes | None, hashes: WordHashes, width: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles.

    A text of fewer than ``width`` words has one shingle, all its words; a text
    without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    take = min(width, len(codes))
    count = len(codes) - take + 1
    sums = np.full(count, take, np.uint64)
    for place in range(take):
        sums += codes[place : place + count] * _PLACES[place % len(_PLACES)] + np.uint64(place // len(_PLACES))
    return np.unique(_mixed(sums))
