"""Words and word shingles of whole texts as 64-bit hashes, computed with numpy over Arrow text buffers.

A word is a run of bytes outside ``\\x20\\x09-\\x0D`` of the UTF-8 text, A-Z lower-cased. Texts are worked through
in chunks of about half a megabyte, so memory does not follow the batch; a longer text is a chunk of its own.
A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_HASH = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_HASH[SPACE] = 0
BYTE_HASH[65:91] = BYTE_HASH[97:123]
#: For words of letters and digits alone: ASCII punctuation separates as white space does.
MARKS = SPACE.copy()
MARKS[[i for i in range(128) if not chr(i).isalnum()]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.full(4096, BASE, np.uint64))


def powers(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.cumprod(np.full(2 * n, BASE, np.uint64))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets of the texts in them with the end) for each chunk of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        j = min(j, n)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, byte where it starts, where each text's words begin with the end) of one chunk."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~separators[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < n]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    begins = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, begins
    at = np.arange(n, dtype=np.int64)
    at -= np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [n]))))
    values = BYTE_HASH[data]
    if separators is not SPACE:
        values[~solid] = 0
    hashes = np.add.reduceat(values * powers(int(at.max()) + 1)[at], starts)
    return mix(hashes), starts, begins


def shingles(hashes: np.ndarray, begins: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle, where each text's shingles begin with the end), repeats kept.

    A text of 1 to k-1 words has its whole sequence as one shingle; one without words has none.
    """
    count = np.diff(begins)
    n = len(hashes)
    full = np.zeros(n, np.uint64)
    for j in range(k):
        step = mix(np.full(1, j + 1, np.uint64))[0] | np.uint64(1)
        full[: n - j] += hashes[j:] * step
    take = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    ends = np.cumsum(take)
    begin = np.concatenate(([0], ends))
    where = np.arange(int(begin[-1])) + np.repeat(begins[:-1] - begin[:-1], take)
    out = full[where]
    for i in np.flatnonzero((count > 0) & (count < k)):
        h = hashes[begins[i] : begins[i + 1]]
        out[begin[i]] = np.uint64(len(h)) + np.add.reduce(h * powers(k)[: len(h)])
    return mix(out), begin


def ranked(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each text in ascending order, and which of them is the first of its kind in its text."""
    values = values.copy()
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[begin[:-1][begin[1:] > begin[:-1]]] = True
    return values, first


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text in ascending order, and where each text's begin with the end."""
    values, first = ranked(values, begin)
    return values[first], np.concatenate(([0], np.cumsum(first)))[begin]
