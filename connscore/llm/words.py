"""Words of a block of texts as numpy arrays, without a Python loop over words.

A word is a run of bytes other than the six ASCII white-space bytes, the same
rule as ``bytes.split()``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass
class Words:
    """Words of documents ``first`` to ``first + len(offsets) - 1`` of a batch."""
    first: int
    data: bytes          # the words, one space between those of a document
    start: np.ndarray    # of each word in data
    end: np.ndarray
    offsets: np.ndarray  # first word of each document, and the number of words
    hash: np.ndarray     # uint64 of each word


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(1 << 16, n + 1)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        have = both[0], both[1]
        if size <= 2 * CHUNK_BYTES:
            _powers[base] = have
    return have


def _ranges_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each range."""
    up, down = _power_tables(base, len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; empty if there are fewer."""
    if len(hashes) < k:
        return np.empty(0, dtype=np.uint64)
    start = np.arange(len(hashes) - k + 1)
    return _ranges_hash(hashes, start, start + k, _WORD_BASE)


def _plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a string column; null as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray, first: int = 0) -> Words:
    """Words of documents that lie one after another in ``data``."""
    space = _SPACE[data]
    inside = ~space
    before = np.empty(len(data), dtype=bool)
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begins] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    hashes = _ranges_hash(data.astype(np.uint64) + np.uint64(1), start, end, _BYTE_BASE)
    gap = end[end < len(data)]
    inside[gap[space[gap]]] = True   # one separator after a word
    place = np.cumsum(inside)
    packed = data[inside]
    packed[_SPACE[packed]] = 32
    return Words(first, packed.tobytes(), place[start] - 1, place[end - 1],
                 np.searchsorted(start, offsets), hashes)


def chunks(column: pa.Array) -> Iterator[Words]:
    """The words of a string column, a bounded number of bytes at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    data, offsets = _plain(column)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield words_of(data[offsets[low]:offsets[high]],
                       offsets[low:high + 1] - offsets[low], low)
        low = high
