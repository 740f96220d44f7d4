"""Whole Arrow columns of text as numpy arrays: bytes, document offsets, words and hashes.

Everything here works on the concatenated UTF-8 bytes of a bounded chunk of rows, so that tasks
do no per-character Python work. A chunk holds whole texts: at least one row, else rows up to
``CHUNK_BYTES``; memory is bounded by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

#: Bytes between words: space, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null reads as empty."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``limit`` bytes of text (a longer text alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, start = np.cumsum(size), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SEPARATORS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of bytes that are not separators, within rows."""
    word = ~separators[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins, ends = np.empty(len(data), bool), np.empty(len(data), bool)
    begins[0], ends[-1] = True, True
    np.logical_not(word[:-1], out=begins[1:])
    np.logical_not(word[1:], out=ends[:-1])
    begins[edges] = True
    ends[edges[1:] - 1] = True
    start = np.flatnonzero(begins & word)
    return start, np.flatnonzero(ends & word) + 1, np.searchsorted(offsets, start, "right") - 1


class _Powers:
    """Powers of the base and of its inverse, kept for as many bytes as were hashed so far. Jobs carry
    this module by value, and the powers take 16 MB: a pickled copy starts without any."""

    def __init__(self):
        self.known = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):
        return type(self), ()

    def __call__(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known[0]) < length:
            for k, base in enumerate((_BASE, _BASE_INVERSE)):
                steps = np.full(max(length, CHUNK_BYTES + 2), base, np.uint64)
                steps[0] = 1
                self.known[k] = np.multiply.accumulate(steps)
        return self.known[0][:length], self.known[1][:length]


_power = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal spans wherever they lie."""
    power, inverse = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:-1], out=total[1:])
    length = (end - start).astype(np.uint64)
    return mix((total[end] - total[start]) * inverse[start] + length * np.uint64(0xD6E8FEB86659FD93))


def symbol_hashes(s: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of an array of non-negative integers."""
    power, inverse = _power(len(s) + 1)
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    return mix((total[stop] - total[start]) * inverse[start] + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of first word) of every window of ``size`` words within one row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(rows[:n] == rows[size - 1 :])
    found = np.zeros(len(first), np.uint64)
    for k in range(size):
        found = mix(found * np.uint64(31) + words[first + k] + np.uint64(k + 1))
    return found, first


def per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of integer values by row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    bounds = np.searchsorted(rows, np.arange(n + 1))
    return total[bounds[1:]] - total[bounds[:-1]]


def span_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over the byte ranges that ``offsets`` cut."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


#: Bytes that no word of running text holds: ASCII other than letters, digits and the underscore.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B)]] = False
PUNCTUATION[0x80:] = False


def lower_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, words before each row) of the lower-cased words of a text column."""
    data, offsets = buffers(pc.utf8_lower(column))
    start, end, row = word_spans(data, offsets, PUNCTUATION)
    return span_hashes(data, start, end), row, np.searchsorted(row, np.arange(len(column) + 1))
