"""Matching hashes of all documents without a row for each.

Documents are dealt by key into cells of bounded size. A cell sends the hashes it holds, sorted and cut by bucket (the
leading bits), as byte blobs; a bucket sees every cell's hashes of its range, decides, and answers each cell with the
hashes it should know about. Both numbers follow the input, so cells and buckets keep their size on larger inputs.
A hash that a third of all documents hold is sent once for each cell.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import release

CELL_BYTES = 8 << 20
CELL_DOCS = 16_384
REST_BITS = 30  # hash bits beside the bucket; the two lowest of 32 carry flags


class Layout:
    """Number of cells, and bits of the bucket number, for a table of documents."""

    def __init__(self, docs: DataFrame, text: str = "text"):
        size = docs.agg(F.sum(F.octet_length(text)).alias("bytes"), F.count("*").alias("rows")).first()
        self.cells = max(1, -(-(size["bytes"] or 0) // CELL_BYTES), -(-size["rows"] // CELL_DOCS))
        self.bucket_bits = max(3, int(self.cells - 1).bit_length())

    def dealt(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        cell = F.pmod(F.xxhash64(F.lit(71), key), F.lit(self.cells)).cast("int")
        return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), cell.alias("_cell"))

    def short(self, hashes: np.ndarray) -> np.ndarray:
        """Bucket and rest of 64-bit hashes as one number of ``bucket_bits + REST_BITS`` bits."""
        return hashes >> np.uint64(64 - REST_BITS - self.bucket_bits)

    def blobs(self, cell: int, short: np.ndarray, flags: np.ndarray) -> list[tuple[int, int, bytes]]:
        """(cell, bucket, packed) for sorted short hashes, each with two bits of flags."""
        value = ((short & np.uint64((1 << REST_BITS) - 1)) << np.uint64(2) | flags.astype(np.uint64)).astype(np.uint32)
        bucket = (short >> np.uint64(REST_BITS)).astype(np.int64)
        edges = np.searchsorted(bucket, np.arange((1 << self.bucket_bits) + 1))
        return [(cell, b, pack(value[i:j])) for b, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]

    def unpack_answers(self, buckets: list[int], packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted short hashes of a cell's answers, and their flags."""
        if not buckets:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        parts = []
        for k in np.argsort(buckets):
            parts.append(unpack(packed[k]).astype(np.uint64) | np.uint64(int(buckets[k]) << 32))
        value = np.concatenate(parts)
        return value >> np.uint64(2), (value & np.uint64(3)).astype(np.uint8)


BLOBS = "_cell int, bucket int, packed binary"


def pack(value: np.ndarray) -> bytes:
    """Sorted 32-bit values by byte planes: the high ones are runs, which the shuffle's compression removes."""
    return np.ascontiguousarray(value.astype("<u4").view(np.uint8).reshape(-1, 4).T[::-1]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1)[::-1].T).view("<u4").ravel()


def blob_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    cell, bucket, packed = zip(*rows) if rows else ((), (), ())
    return pa.table({"_cell": pa.array(cell, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "packed": pa.array(packed, pa.binary())})


def answer(blobs: DataFrame, decide: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Per bucket: ``decide(flags, first)`` gets the flags of all entries, sorted by hash, and where each hash begins;
    it returns the answer's flags for each hash, 255 to stay silent. Cells get the hashes they sent, as ``BLOBS``."""

    def run(table: pa.Table) -> pa.Table:
        release()
        cells, packed = table["_cell"].to_numpy(), table["packed"].to_pylist()
        parts = [unpack(p) for p in packed]
        source = np.repeat(np.arange(len(parts), dtype=np.uint64), [len(p) for p in parts])
        value = np.concatenate(parts).astype(np.uint64)
        entry = value >> np.uint64(2) << np.uint64(32) | source << np.uint64(2) | value & np.uint64(3)
        entry.sort()
        rest = entry >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        told = decide((entry & np.uint64(3)).astype(np.uint8), first)
        told = np.repeat(told, np.diff(first, append=len(entry)))
        kept = told != 255
        source = (entry[kept] >> np.uint64(2) & np.uint64((1 << 30) - 1)).astype(np.int64)
        out = (rest[kept] << np.uint64(2) | told[kept].astype(np.uint64)).astype(np.uint32)
        order = np.argsort(source, kind="stable")
        out, edges = out[order], np.searchsorted(source[order], np.arange(len(parts) + 1))
        bucket = int(table["bucket"][0].as_py())
        return blob_table([(int(cells[k]), bucket, pack(out[i:j])) for k, (i, j) in enumerate(zip(edges, edges[1:])) if j > i])

    return blobs.groupBy("bucket").applyInArrow(run, BLOBS)


def lookup(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted value in a sorted array, -1 if absent. A bit table turns most absent ones away."""
    out = np.full(len(wanted), -1, np.int64)
    if not len(sorted_values) or not len(wanted):
        return out
    mask = np.uint64((1 << 22) - 1)
    seen = np.zeros(1 << 22, bool)
    seen[sorted_values & mask] = True
    maybe = np.flatnonzero(seen[wanted & mask])
    at = np.minimum(np.searchsorted(sorted_values, wanted[maybe]), len(sorted_values) - 1)
    hit = sorted_values[at] == wanted[maybe]
    out[maybe[hit]] = at[hit]
    return out
