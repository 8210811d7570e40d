"""Substring deduplication with fixed-block anchors.

A repeat of ``width`` words in a document covers at least one whole block of ``(width + 1) // 2`` words that begins at a
multiple of that length. Such blocks of every document are indexed; every rolling window of the block's length probes
the index. Around hits, windows of ``width`` words are compared by 64-bit hash over all documents, and neighbouring
ones that repeat make up the maximal exact repeats. The document with the smallest key keeps a repeat, later ones lose
its words.

Nulls and texts under ``width`` words lose nothing. Rows with equal keys are one document's: they don't count as repeats
of each other. Rows with a null key are returned whole and are no reference. Repeats inside one document stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import BLOBS, Layout, answer, blob_table, lookup
from .textops import Words, chunks, window_hashes

WIDTH = 13


def _cell_words(table: pa.Table) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a cell's documents in order of key, their hashes, the keys, and the number of the key of each word."""
    table = table.sort_by("_key")
    words = Words(table["_text"].combine_chunks())
    key = table["_key"].to_numpy()
    number = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
    return words, words.hashes(), key, np.repeat(number, words.counts())


def _send_anchors(layout: Layout, width: int):
    """Blobs of a cell's rolling windows; flag 1: one is a block of the index, flag 2: several documents hold it."""
    block = (width + 1) // 2

    def run(table: pa.Table) -> pa.Table:
        cell = int(table["_cell"][0].as_py())
        words, hashes, _, number = _cell_words(table)
        window, at = window_hashes(hashes, words.first, block)
        begin = np.repeat(words.first[:-1], words.counts())
        anchor = ((at - begin[at]) % block == 0).astype(np.uint64)
        short, doc = layout.short(window), number[at]
        rows = []
        for low in range(0, int(doc[-1]) + 1 if len(doc) else 0, 1 << 16):  # numbers of documents have 16 bits here
            part = slice(*np.searchsorted(doc, [low, low + (1 << 16)]))
            entry = short[part] << np.uint64(17) | (doc[part] - low).astype(np.uint64) << np.uint64(1) | anchor[part]
            entry.sort()
            value = entry >> np.uint64(17)
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            last = np.append(first[1:], len(entry)) - 1
            who = entry >> np.uint64(1) & np.uint64(0xFFFF)
            flags = np.maximum.reduceat(entry & np.uint64(1), first) | (who[first] != who[last]).astype(np.uint64) << np.uint64(1)
            rows += layout.blobs(cell, value[first], flags)
        return blob_table(rows)

    return run


def _shared_anchor(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes that are a block somewhere and that at least two documents hold."""
    any_ = np.bitwise_or.reduceat(flags, first)
    several = (np.diff(first, append=len(flags)) > 1) | (any_ & 2 > 0)
    return np.where((any_ & 1 > 0) & several, 0, 255).astype(np.uint8)


def _send_windows(layout: Layout, width: int):
    """Full windows around hits: per bucket the sorted hashes, and the smallest key of the cell that holds each."""
    block = (width + 1) // 2

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {"_cell": [], "bucket": [], "hashes": [], "keys": [], "several": []}
        if table.num_rows and answers.num_rows:
            cell = int(table["_cell"][0].as_py())
            words, hashes, key, number = _cell_words(table)
            known, _ = layout.unpack_answers(answers["bucket"].to_pylist(), answers["packed"].to_pylist())
            window, at = window_hashes(hashes, words.first, block)
            hits = np.zeros(len(hashes) + 1, np.int64)
            hits[at[lookup(known, layout.short(window)) >= 0] + 1] = 1
            hits = np.cumsum(hits)
            full, at = window_hashes(hashes, words.first, width)
            near = hits[at + width - block + 1] > hits[at]  # a hit begins in the first words of the window
            full, doc = full[near], number[at[near]]
            order = np.argsort(full, kind="stable")  # words are in order of key, so the first of a run is the smallest
            full, doc = full[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], full[1:] != full[:-1]])) if len(full) else np.zeros(0, np.int64)
            several = doc[first] != doc[np.append(first[1:], len(full)) - 1] if len(full) else np.zeros(0, bool)
            keys = key[np.searchsorted(np.cumsum(np.diff(key, prepend=key[:1]) != 0), doc[first])]
            bucket = (full[first] >> np.uint64(64 - layout.bucket_bits)).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange((1 << layout.bucket_bits) + 1))
            for b, (i, j) in enumerate(zip(edges, edges[1:])):
                if j > i:
                    for name, value in zip(out, (cell, b, full[first[i:j]].tobytes(), keys[i:j].astype(np.int64).tobytes(), np.packbits(several[i:j]).tobytes())):
                        out[name].append(value)
        return pa.table({n: pa.array(v, pa.int32() if n in ("_cell", "bucket") else pa.binary()) for n, v in out.items()})

    return run


WINDOWS = "_cell int, bucket int, hashes binary, keys binary, several binary"
OWNERS = "_cell int, hashes binary, keys binary"


def _owners(table: pa.Table) -> pa.Table:
    """Per bucket: the smallest key of each window that several documents hold, told to every cell that has it."""
    cells = table["_cell"].to_numpy()
    parts = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
    hashes = np.concatenate(parts)
    keys = np.concatenate([np.frombuffer(k, np.int64) for k in table["keys"].to_pylist()])
    several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=len(p)) for s, p in zip(table["several"].to_pylist(), parts)])
    source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(hashes, kind="stable")
    hashes, keys, several, source = hashes[order], keys[order], several[order], source[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    size = np.diff(first, append=len(hashes))
    owner = np.repeat(np.minimum.reduceat(keys, first), size)
    told = np.repeat((size > 1) | (np.maximum.reduceat(several, first) > 0), size)
    hashes, owner, source = hashes[told], owner[told], source[told]
    order = np.argsort(source, kind="stable")
    hashes, owner, edges = hashes[order], owner[order], np.searchsorted(source[order], np.arange(len(parts) + 1))
    rows = [(int(cells[k]), hashes[i:j].tobytes(), owner[i:j].tobytes()) for k, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
    cell, found, keys_ = zip(*rows) if rows else ((), (), ())
    return pa.table({"_cell": pa.array(cell, pa.int32()), "hashes": pa.array(found, pa.binary()), "keys": pa.array(keys_, pa.binary())})


def _kept(words: Words, gone: np.ndarray, digest: bool) -> tuple[pa.Array, pa.Array, pa.Array]:
    raw = words.raw.tobytes()
    removed = np.zeros(len(gone) + 1, np.int64)
    np.cumsum(gone, out=removed[1:])
    removed = np.diff(removed[words.first])
    at, first = words.at.tolist(), words.first.tolist()
    texts = []
    for d in range(words.docs):
        left = raw[at[d] : at[d + 1]].split()
        if removed[d]:
            left = compress(left, ~gone[first[d] : first[d + 1]])
        kept = b" ".join(left)
        texts.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
    return pa.array(words.counts(), pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())


def _cut_repeats(width: int, digest: bool, name: str):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        words, hashes, key, _ = _cell_words(table)
        gone = np.zeros(len(hashes) + 1, np.int64)
        if answers.num_rows:
            known = np.concatenate([np.frombuffer(h, np.uint64) for h in answers["hashes"].to_pylist()])
            owner = np.concatenate([np.frombuffer(k, np.int64) for k in answers["keys"].to_pylist()])
            order = np.argsort(known)
            known, owner = known[order], owner[order]
            full, at = window_hashes(hashes, words.first, width)
            found = lookup(known, full)
            at, found = at[found >= 0], found[found >= 0]
            late = at[owner[found] < np.repeat(key, words.counts())[at]]
            np.add.at(gone, late, 1)
            np.add.at(gone, late + width, -1)
        counts, removed, texts = _kept(words, np.cumsum(gone[:-1]) > 0, digest)
        return pa.table({"_key": pa.array(key, pa.int64()), "n_words": counts, "n_removed": removed, name: texts})

    return run


def dedup_substrings(docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """``key`` (an integer), ``n_words``, ``n_removed`` and ``kept`` (or with ``digest`` its ``kept_sha256``), one row for
    each input row: the kept words joined by one space."""
    name = "kept_sha256" if digest else "kept"
    keyed = docs.select(F.col(key).cast("long").alias(key), text).where(F.col(key).isNotNull())
    layout = Layout(keyed, text)
    dealt = layout.dealt(keyed, key, text)
    anchors = dealt.groupBy("_cell").applyInArrow(_send_anchors(layout, width), BLOBS)
    hits = answer(anchors, _shared_anchor)
    windows = dealt.groupBy("_cell").cogroup(hits.groupBy("_cell")).applyInArrow(_send_windows(layout, width), WINDOWS)
    owners = windows.groupBy("bucket").applyInArrow(_owners, OWNERS)
    result = dealt.groupBy("_cell").cogroup(owners.groupBy("_cell")).applyInArrow(_cut_repeats(width, digest, name), f"_key long, n_words long, n_removed long, {name} string")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                words = Words(part.column(text))
                columns = _kept(words, np.zeros(len(words.start), bool), digest)
                yield pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), *columns], ["_key", "n_words", "n_removed", name])

    unkeyed = docs.select(key, text).where(F.col(key).isNull()).select(text).mapInArrow(whole, result.schema)
    return result.union(unkeyed).withColumnRenamed("_key", key)
