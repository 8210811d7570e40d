"""Vectorised word and hash work on Arrow text columns, shared by the operators.

A chunk of documents is one byte array; words, their hashes and word windows are found with numpy over the whole
chunk, so a task never loops over words in Python. Memory per task follows ``CHUNK_BYTES`` (or the longest single
document, where that is longer), never the number of documents.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        tables = []
        for base in (_BASE, _BASE_INV):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            tables.append(table)
        _powers[:] = tables
    return _powers[0], _powers[1]


def release() -> None:
    """Give memory that is no longer used back to the system: workers live on between the stages of a job."""
    if _powers and len(_powers[0]) > CHUNK_BYTES + 1:  # of a text longer than a chunk
        _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and ``len + 1`` offsets into them; null reads as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes of text each, or one longer document alone."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop
    release()


class Words:
    """The words (runs without ASCII white space) of a column of texts.

    ``start``/``end`` are byte positions, ``first[d]:first[d + 1]`` the words of document ``d``.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        raw, at = text_buffers(column)
        self.raw, self.at, self.docs = (_LOWER[raw] if lower else raw), at, len(at) - 1
        solid = ~_BLANK[raw]
        begins, ends = solid.copy(), solid.copy()
        if len(raw):
            begins[1:] &= ~solid[:-1]
            ends[:-1] &= ~solid[1:]
            inner = at[(at > 0) & (at < len(raw))]
            begins[inner] = solid[inner]
            ends[inner - 1] = solid[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.first[-1] = len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word: a polynomial over its bytes, then scrambled."""
        return span_hashes(self.raw, self.start, self.end)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans in order of their start, from about a chunk of bytes at a time: running sums take 8 bytes a byte."""
    if len(raw) <= CHUNK_BYTES:
        return _span_hashes(raw, start, end)
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = int(np.searchsorted(start, start[i] + CHUNK_BYTES // 2, "right"))
        base, top = start[i], end[i:j].max()
        out[i:j] = _span_hashes(raw[base:top], start[i:j] - base, end[i:j] - base)
        i = j
    return out


def _span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    power, inverse = _power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[raw] * power[: len(raw)], out=total[1:])
    value = (total[end] - total[start]) * inverse[start]
    return mix64(value + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def window_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word windows that lie in one document, and the word each begins at."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    factor = 1
    for k in range(width):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        value += words[k : k + n] * np.uint64(factor)
    keep = np.ones(n, bool)
    for k in range(1, width):  # windows that would cross into the next document
        cut = first[1:-1] - k
        keep[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(keep)
    return mix64(value[at]), at


def spans_per_doc(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the first window of each document in ``at`` (sorted word positions), plus the end."""
    out = np.searchsorted(at, first)
    out[-1] = len(at)
    return out


def sums_per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over ``values[first[d]:first[d + 1]]``; documents without values sum to 0."""
    shape = (len(first) - 1, *values.shape[1:])
    out = np.zeros(shape, np.float64 if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0, dtype=out.dtype)
    return out


_CLASS = np.where(_BLANK, 0, 2).astype(np.uint8)
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


class Runs(Words):
    """Like ``Words``, but letters and digits (and all non-ASCII) apart from ASCII punctuation."""

    def __init__(self, column: pa.Array):
        raw, at = text_buffers(column)
        self.raw, self.at, self.docs = raw, at, len(at) - 1
        kind = _CLASS[raw]
        begins, ends = kind > 0, kind > 0
        if len(raw):
            same = kind[1:] == kind[:-1]
            inner = at[(at > 0) & (at < len(raw))]
            same[inner - 1] = False
            begins[1:] &= ~same
            ends[:-1] &= ~same
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.first[-1] = len(self.start)
