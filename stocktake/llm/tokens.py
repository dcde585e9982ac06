"""Words of Arrow text columns as 64-bit hashes, in numpy, a column chunk at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
#: A random number for each byte, and odd multipliers for the place in a word.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))
#: Bytes that one pass handles, so that its arrays stay in the processor's cache.
CHUNK = 1 << 20

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32
#: Word bytes: all but ASCII white space; letters only, where any byte beyond ASCII counts as a letter.
NO_SPACE = np.ones(256, dtype=bool)
NO_SPACE[[9, 10, 11, 12, 13, 32]] = False
LETTERS = np.zeros(256, dtype=bool)
LETTERS[97:123] = LETTERS[65:91] = LETTERS[128:] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of the numbers over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets of each row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `size` bytes, at least one row each."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end
        row = end


#: A text above this size is hashed in pieces that end between words.
LONG = 1 << 22


def _in_pieces(hashed, data: np.ndarray, offsets: np.ndarray, first: int, word_bytes: np.ndarray, case: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What `hashed` makes of one long row; a word longer than a piece stays whole."""
    at, end, parts = int(offsets[first]), int(offsets[first + 1]), []
    while at < end:
        cut = min(end, at + LONG)
        while cut < end:
            gap = np.flatnonzero(~word_bytes[data[cut : min(end, cut + LONG)]])
            if len(gap):
                cut += int(gap[0])
                break
            cut = min(end, cut + LONG)
        parts.append(hashed(data, np.array([at, cut]), 0, 1, word_bytes, case)[0])
        at = cut
    every = np.concatenate(parts)
    return every, np.array([0, len(every)])


def hashed_words(data: np.ndarray, offsets: np.ndarray, first: int, last: int, word_bytes: np.ndarray = NO_SPACE, case: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows first..last-1, in order, and the place of each row's first word (one more at the end)."""
    if last == first + 1 and offsets[last] - offsets[first] > LONG:
        return _in_pieces(_hashed_words, data, offsets, first, word_bytes, case)
    return _hashed_words(data, offsets, first, last, word_bytes, case)


def _hashed_words(data: np.ndarray, offsets: np.ndarray, first: int, last: int, word_bytes: np.ndarray, case: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    base, end = int(offsets[first]), int(offsets[last])
    raw = data[base:end]
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(last - first + 1, np.int64)
    inside = word_bytes[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = (offsets[first:last] - base)[offsets[first:last] < end]
    begins[rows] |= inside[rows]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(last - first + 1, np.int64)
    values = np.where(word_bytes, BYTE[case], np.uint64(0))[raw]
    index = np.arange(len(raw), dtype=np.int32)
    begin_of = np.maximum.accumulate(np.where(begins, index, np.int32(0)))
    values *= PLACE[(index - begin_of) & 4095]
    hashes = mixed(np.add.reduceat(values, starts))
    return hashes, np.searchsorted(starts, offsets[first : last + 1] - base)


def hashed_grams(data: np.ndarray, offsets: np.ndarray, first: int, last: int, size: int, word_bytes: np.ndarray = LETTERS, case: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` bytes inside words, the break before a word being its first byte; places as in hashed_words."""
    if last == first + 1 and offsets[last] - offsets[first] > LONG:
        return _in_pieces(partial(_hashed_grams, size), data, offsets, first, word_bytes, case)
    return _hashed_grams(size, data, offsets, first, last, word_bytes, case)


def _hashed_grams(size: int, data: np.ndarray, offsets: np.ndarray, first: int, last: int, word_bytes: np.ndarray, case: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    base, end = int(offsets[first]), int(offsets[last])
    raw = data[base:end]
    n = len(raw)
    bounds = offsets[first : last + 1] - base
    if n < size - 1:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = word_bytes[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = bounds[:-1][bounds[:-1] < n]
    begins[rows] |= inside[rows]
    codes = BYTE[case][raw]
    m = n - size + 2  # a run ends size - 1 bytes after its second byte
    able, total = inside[:m].copy(), np.zeros(m, np.uint64)
    for k in range(size - 1):
        total += codes[k : k + m] * PLACE[k + 1]
        if k:
            able &= inside[k : k + m] & ~begins[k : k + m]
    before = np.empty(m, np.uint64)
    before[0], before[1:] = 0, codes[: m - 1]
    total += np.where(begins[:m], np.uint64(0), before) * PLACE[0]
    at = np.flatnonzero(able)
    return mixed(total[at]), np.searchsorted(at, bounds)
