"""Vectorised word and shingle hashes of text batches (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE = _BYTE[_LOWER]  # equal for both cases of A-Z
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _ODD, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_batches(column: pa.Array, limit: int = 262_144) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) slices of a string column of about ``limit`` bytes.

    A longer text is a slice of its own; null counts as empty.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, len(column))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) of consecutive texts, and the number of each text's words."""
    space = _SPACE[data]
    first = np.empty(len(data), bool)
    if len(data):
        first[0] = True
        first[1:] = space[:-1]
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        first &= ~space
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    at = np.flatnonzero(~space)
    begin = np.cumsum(~space, dtype=np.int64)[starts] - 1  # place of each word among the bytes that are not white space
    lengths = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, lengths)
    value = _BYTE[data[at]] * _powers(int(lengths.max()))[place]
    return mix64(np.add.reduceat(value, begin) + lengths.astype(np.uint64) * _ODD), counts


def shingle_sets(words: np.ndarray, counts: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles.

    With fewer than k words the whole sequence is one shingle; without words the set is empty.
    """
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        rolled = rolled * _ODD + words[i: i + len(rolled)]
    rolled = mix64(rolled)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= k:
            h = np.sort(rolled[end - n: end - k + 1])
            out.append(h[np.append(True, h[1:] != h[:-1])])
        elif n:
            short = (words[end - n: end] * _powers(n + 1)[1:]).sum(dtype=np.uint64)
            out.append(mix64(np.array([short], np.uint64) ^ np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_hash(s: np.ndarray) -> int:
    """A signed 64-bit hash of a whole set."""
    total = mix64(np.array([mix64(s ^ _ODD).sum(dtype=np.uint64)]) + np.array([len(s)], np.uint64) * _ODD)
    return int(total.view(np.int64)[0])
