"""Hashed word shingles of Arrow text columns, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyward.llm.perfect_hash import mix

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
#: A random value for each byte, A-Z folded onto a-z; no byte stands for 0.
_VALUE = mix(np.arange(256, dtype=np.uint64), 3) | np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        for i, b in enumerate((BASE, INVERSE)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def pieces(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``most_bytes``; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        yield at, flat[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word, and where each document's words begin (one entry more than documents)."""
    if not len(flat):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    up, down = _power(len(flat))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_VALUE[flat] * up, dtype=np.uint64)))
    word = ~_BLANK[flat]
    edge = np.zeros(len(flat) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) & ~edge[:-1]
    after = np.concatenate((word[1:], [False])) & ~edge[1:]
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return mix((sums[ends] - sums[starts]) * down[starts], 5), np.searchsorted(starts, offsets)


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each document's distinct k-word shingles, sorted; a shorter text is one shingle, no words give none."""
    words, first = word_hashes(flat, offsets)
    if len(words) >= k:
        rolled = words[: len(words) - k + 1].copy()
        for j in range(1, k):
            rolled = rolled * STEP + words[j : len(words) - k + 1 + j]
        rolled = mix(rolled, k)
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if n >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif n:
            h = np.zeros(1, dtype=np.uint64)
            for w in words[a:b]:
                h = h * STEP + w
            yield mix(h, int(100 + n))
        else:
            yield np.zeros(0, dtype=np.uint64)
