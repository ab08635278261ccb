"""Word and shingle hashing, vectorised over whole Arrow batches.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as
a-z.  Words are hashed straight from the UTF-8 buffer of the column: a sum of
random values per byte times powers of an odd number, modulo 2**64, read off
one running sum for every word, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
CHUNK_BYTES = 1 << 18  # of text hashed at a time; a longer text is a chunk of its own


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES = [_powers(_BASE, 1 << 16), _powers(_UNBASE, 1 << 16)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES[0]) < n:
        _TABLES[:] = [_powers(_BASE, n), _powers(_UNBASE, n)]
    return _TABLES[0][:n], _TABLES[1][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about CHUNK_BYTES of text."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and each text's first word's place (one more at the end)."""
    lo = offsets[0]
    data = data[lo : offsets[-1]]
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets - lo] = True  # a word ends with its text
    before = np.concatenate(([False], word[:-1]))
    starts = np.flatnonzero(word & (~before | edge[:n]))
    after = np.concatenate((word[1:], [False]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    up, down = _tables(n)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * up, out=run[1:])
    hashes = mix((run[ends] - run[starts]) * down[starts])
    return hashes, np.searchsorted(starts, offsets - lo)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of one text; fewer words make one shingle, none no shingle."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        out = mix(out * np.uint64(_BASE) + words[j : len(words) - n + 1 + j])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def text_shingles(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The shingle set of each text of the column, in order."""
    data, offsets = text_buffer(column)
    for row, end in chunks(offsets):
        words, first = word_hashes(data, offsets[row : end + 1])
        for k in range(end - row):
            yield shingles(words[first[k] : first[k + 1]], n)
