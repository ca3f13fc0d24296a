"""Word and shingle hashes of whole text columns, vectorised over Arrow buffers.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. A word's hash
is a polynomial in its bytes modulo 2**64, read off prefix sums of the whole buffer and
then mixed, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= SLICE_BYTES + 1:
            _powers[base] = have
    return have[:n]


def texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``(first row, rows, bytes, offsets)`` of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last - first, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in a slice, and the first word of each text."""
    if len(raw) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True  # a text's bounds end a word
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in a slice, and the first word of each text."""
    starts, stops, firsts = word_bounds(raw, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), firsts
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[raw].astype(np.uint64) * _power(_BASE, len(raw)), out=sums[1:])
    shifted = (sums[stops] - sums[starts]) * _power(_INVERSE, len(raw))[starts]
    return mix(shifted ^ ((stops - starts).astype(np.uint64) << np.uint64(48))), firsts


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of one text, in order; fewer words than ``size`` make one."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    sums = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        sums = sums * _STEP + words[k : n - width + 1 + k]
    return mix(sums)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text, its distinct shingle hashes in ascending order."""
    for _, rows, raw, offsets in texts(column):
        words, firsts = word_hashes(raw, offsets)
        for k in range(rows):
            found = np.sort(shingle_hashes(words[firsts[k] : firsts[k + 1]], size))
            if len(found) > 1:
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
            yield found
