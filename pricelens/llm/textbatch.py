"""Whole-batch text helpers: Arrow string columns as byte arrays, words and their 64-bit hashes.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D; only A-Z is lower-cased.  A word is
identified by a 64-bit hash: each block of 8 bytes is mixed with its place, the mixed blocks are added
up, and the sum is mixed with the length.  The mixing is one to one, so words of one length of up to 8
bytes never share a hash; any other two words do with a probability near 2**-64, unless they were made
to fit this function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SHINGLE = 5

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BASE = 0x9E3779B97F4A7C15 | 5
_STEP = _rng.integers(1 << 60, 1 << 62, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bits of the first 0 to 8 bytes of a block.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_PLACE = 0x9E3779B97F4A7C15
_LONG = 256


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def string_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the ``n + 1`` offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of at most ``limit`` bytes (or one longer text): first row, end row, bytes, offsets."""
    data, off = string_column(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the ``n + 1`` word offsets of the texts."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(IS_SPACE[data], out=inside[1:n + 1])
    cut = np.zeros(n + 1, dtype=bool)          # a text begins here
    cut[off[:-1]] = True
    body = inside[1:n + 1]
    starts = np.flatnonzero(body & (~inside[:n] | cut[:n]))
    cut[n] = True
    ends = np.flatnonzero(body & (~inside[2:n + 2] | cut[1:n + 1])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each (A-Z lower-cased) word."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = LOWER[data]
    block = np.ndarray((n + 1,), "<u8", padded, strides=(1,))          # the 8 bytes from each place on
    length = ends - starts
    total = mix((block[starts] & _KEEP[np.minimum(length, 8)]) + _U(_PLACE))
    rest = np.flatnonzero((length > 8) & (length <= _LONG))
    k = 1
    while len(rest):
        left = length[rest] - 8 * k
        total[rest] += mix((block[starts[rest] + 8 * k] & _KEEP[np.minimum(left, 8)]) + _U(_PLACE * (k + 1) % (1 << 64)))
        rest, k = rest[left > 8], k + 1
    for i in np.flatnonzero(length > _LONG).tolist():                  # a long word's blocks side by side
        own = block[starts[i] + 8:ends[i]:8].copy()
        own[-1] &= _KEEP[(length[i] - 1) % 8 + 1]
        own += _U(_PLACE) * np.arange(2, len(own) + 2, dtype=np.uint64)
        total[i:i + 1] += mix(own).sum(dtype=np.uint64)
    return mix(total + length.astype(_U) * _U(_BASE))


def text_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the word offsets of the texts."""
    starts, ends, first = word_spans(data, off)
    return word_hashes(data, starts, ends), first


def shingle_sets(words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its 5-word shingles.

    A text of one to four words has one shingle, its whole sequence; a text without words has none.
    """
    n = len(words)
    whole = np.zeros(0, _U)
    if n >= SHINGLE:
        acc = words[:n - SHINGLE + 1] * _STEP[0]
        for k in range(1, SHINGLE):
            acc += words[k:n - SHINGLE + 1 + k] * _STEP[k]
        whole = mix(acc)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        k = b - a
        if k >= SHINGLE:
            s = np.sort(whole[a:b - SHINGLE + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif k:
            acc = np.array([_U(k)]) * _U(_BASE)
            for i in range(k):
                acc += words[a + i:a + i + 1] * _STEP[i]
            out.append(mix(acc))
        else:
            out.append(np.zeros(0, _U))
    return out
