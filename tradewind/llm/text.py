"""Words and shingles of Arrow text columns as arrays of 64-bit hashes.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; A-Z count as a-z. Whole blocks of
texts are hashed at once; a text is never cut, so a block is as large as its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

# What a byte counts in a hash: one more than itself, or than its lower case.
_TERMS = np.arange(1, 257, dtype=np.uint64)
_TERMS[ord("A") : ord("Z") + 1] += np.uint64(32)

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x *= _STEP
    x ^= x >> np.uint64(29)
    x *= np.uint64(_BASE)
    x ^= x >> np.uint64(32)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def power_tables(n: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, for blocks of up to ``n`` bytes."""
    return _powers(_BASE, n), _powers(_BASE_INVERSE, n)


def text_blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of its rows) of pieces of a text column."""
    texts = texts.cast(pa.large_binary()) if len(texts) else pa.array([], pa.large_binary())
    texts = pa.concat_arrays([texts.fill_null(b"")])
    n = len(texts)
    if n == 0:
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        last = min(last, n)
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the first word of each row (one more at the end)."""
    solid = (data != 0x20) & (data - np.uint8(9) > 4)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = solid[:-1], solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray,
    offsets: np.ndarray,
    tables: tuple[np.ndarray, np.ndarray],
    spans: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the first word of each row (one more at the end); ``spans`` are
    the words' if they are known."""
    starts, ends, rows = word_spans(data, offsets) if spans is None else spans
    if len(starts) == 0:
        return np.zeros(0, np.uint64), rows
    n = len(data)
    up, down = tables if n <= len(tables[0]) else power_tables(n)
    terms = _TERMS[data]
    terms *= up[:n]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts]), rows


# The first so many bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each word, taken eight bytes at a time; other numbers than those of ``word_hashes``."""
    bytes_ = np.zeros(len(data) + 8, np.uint8)
    bytes_[:-8] = data | ((data - np.uint8(ord("A")) < 26).view(np.uint8) << np.uint8(5))
    eights = np.ndarray(len(data) + 1, "<u8", bytes_, strides=(1,))
    left = ends - starts
    out = mixed((eights[starts] & _FIRST[np.minimum(left, 8)]) + left.astype(np.uint64) * _STEP)
    at = np.flatnonzero(left > 8)
    starts, left = starts[at] + 8, left[at] - 8
    while len(at):
        out[at] = mixed(out[at] + (eights[starts] & _FIRST[np.minimum(left, 8)]))
        more = left > 8
        at, starts, left = at[more], starts[more] + 8, left[more] - 8
    return out


def blocks_of_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, word hashes, first word of each row) of a text column."""
    tables = power_tables(BLOCK_BYTES if texts.nbytes > BLOCK_BYTES else max(1, texts.nbytes))
    for row, last, data, offsets in text_blocks(texts):
        words, rows = word_hashes(data, offsets, tables)
        yield row, last, words, rows


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n words; all words as one window if there are fewer."""
    if len(words) == 0:
        return words
    width = min(n, len(words))
    out = words[: len(words) - width + 1] + np.uint64(width)
    for k in range(1, width):
        out = out * _STEP + words[k : len(words) - width + 1 + k]
    return mixed(out)
