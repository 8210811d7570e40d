"""Approximate nearest neighbours by a hash-prefix forest.

Each tree hashes a vector to a long string: ``SYMBOLS`` symbols of seven bits, each naming the nearest of 128 signed
directions of a random rotation, then 64 bits of four more projections in turn, the high ones first, which tell apart
vectors of one dense cluster, whose symbols are equal. The sorted strings are the tree: the strings under a prefix of any length are one range.

A query descends each tree to the longest prefix it shares with others, then all trees ascend together, a bit at a time,
until the ranges under its prefixes hold enough candidates. At the last step trees with few new ones ascend first, and
the others stay where they were. This is planned on a sample of the strings (all of them, in a small table); a sample
also cuts each tree into slices, one group each. The query goes to every slice its range touches, where the whole range
is found by binary search and scored exactly in double precision. The best of all slices and trees are merged.

Enough is ``reach * n ** POWER`` candidates of ``n`` vectors and ``LEAST * (k + 1)`` for each tree, counted once in each
tree: some tree then holds ``k + 1`` different ones. Work for all queries so grows slower than the square of the table.
The sample grows with the number of slices and slices with the ranges, so the sample grows with a small power of ``n``.
``reach`` and ``trees`` are the recall parameters. No range is cut: a query may read more than enough, never less.

Equal vectors are one entry of the index, under their smallest id, with as many of their smallest ids as a result can
need: the rest could not be among the ``k`` nearest. So a vector that a third of all rows share costs one entry.

Vectors that are null, zero or have null or non-finite components take no part. Vectors of different lengths are never
compared. Ties go to the smaller id. An empty table gives no rows. With fewer than ``k`` candidates a query finds all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SYMBOLS = 4
DEPTH = 7 * SYMBOLS
LEVELS = DEPTH + 64
TREES = 48
REACH = 1.25
POWER = 0.85
LEAST = 2.0  # times k + 1, from each tree
SLICE_ROWS = 32_768
SAMPLE_ROWS = 8192

_FULL = np.uint64((1 << DEPTH) - 1)
#: The bits that a prefix of each length keeps, of the symbols and of the projection.
_KEEP = np.array([[(1 << DEPTH) - (1 << (DEPTH - min(x, DEPTH))), (1 << 64) - (1 << (64 - max(x - DEPTH, 0)))] for x in range(LEVELS + 1)], np.uint64)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vkey`` (smallest id), ``ids`` (the ``k + 1`` smallest, ascending), ``asks`` (any row is a query), ``vector``."""
    rank = Window.partitionBy(vector).orderBy(key)
    few = rows.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k + 1)
    few = few.select(vector, key, F.lit(False).alias("_asks"))
    asking = rows.where("_asks").select(vector, F.lit(None).cast(few.schema[key].dataType).alias(key), F.lit(True).alias("_asks")).distinct()
    entries = few.union(asking).groupBy(vector).agg(F.sort_array(F.collect_list(key)).alias("ids"), F.max("_asks").alias("asks"))
    return entries.select(F.col("ids")[0].alias("vkey"), "ids", "asks", F.col(vector).alias("vector"))


@lru_cache(maxsize=1)
def _directions(dim: int, trees: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each tree: ``SYMBOLS`` sets of 64 directions, orthogonal as far as the length allows, and four more."""
    rng = np.random.default_rng([seed, dim])
    sets = rng.standard_normal((trees, SYMBOLS, dim, 64))
    if dim >= 64:
        sets = np.linalg.qr(sets)[0]
    return sets.astype(np.float32), rng.standard_normal((trees, dim, 4))


def _spread(x: np.ndarray) -> np.ndarray:
    """16-bit values with three zeros before each bit."""
    for shift, mask in ((24, 0x000000FF000000FF), (12, 0x000F000F000F000F), (6, 0x0303030303030303), (3, 0x1111111111111111)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def hash_strings(vectors: np.ndarray, trees: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each vector and tree: the symbols as an integer, and the four projections as one, their bits in turn."""
    sets, last = _directions(vectors.shape[1], trees, seed)
    scaled = vectors / np.abs(vectors).max(1, initial=1e-300)[:, None]
    scaled /= np.linalg.norm(scaled, axis=1)[:, None]
    single = scaled.astype(np.float32)
    bits, rest = np.zeros((len(vectors), trees), np.int64), np.empty((len(vectors), trees), np.uint64)
    row = np.arange(len(vectors))
    for t in range(trees):
        for directions in sets[t]:
            on = single @ directions
            nearest_one = np.abs(on).argmax(1)
            bits[:, t] = bits[:, t] << 7 | nearest_one << 1 | (on[row, nearest_one] > 0)
        steps = np.clip((scaled @ last[t] + 8) * 4096, 0, 65535).astype(np.uint64)  # of unit vectors: within 8 nearly always
        rest[:, t] = _spread(steps) @ np.array([8, 4, 2, 1], np.uint64)
    return bits, rest


def strings(bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Both parts as 16 bytes that compare like them."""
    return np.stack([bits.astype(np.uint64), rest], 1).astype(">u8").view("S16").ravel()


def prefix_ends(bits: np.ndarray, rest: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last string that share ``level`` leading bits with each of the given ones."""
    keep_bits, keep_rest = _KEEP[level, 0], _KEEP[level, 1]
    own_bits, own_rest = bits.astype(np.uint64) & keep_bits, rest & keep_rest
    return strings(own_bits, own_rest), strings(own_bits | (_FULL ^ keep_bits), own_rest | ~keep_rest)


@dataclass
class Trees:
    """The trees over the vectors of one length, by a sorted sample of the strings of each."""

    sample: np.ndarray  # [tree, place]
    slices: int
    enough: float  # candidates of all trees together, in places of the sample
    base: int  # number of its first group

    def slice_of(self, tree: int, keys: np.ndarray) -> np.ndarray:
        cuts = np.arange(1, self.slices) * self.sample.shape[1] // self.slices
        return np.searchsorted(self.sample[tree][cuts], keys, "right")

    def held(self, bits: np.ndarray, rest: np.ndarray, level: np.ndarray) -> np.ndarray:
        """[query, tree]: how many strings share ``level`` (of each query) leading bits with the query's."""
        out = np.empty(bits.shape, np.int64)
        for t in range(bits.shape[1]):
            first, last = prefix_ends(bits[:, t], rest[:, t], level)
            out[:, t] = np.searchsorted(self.sample[t], last, "right") - np.searchsorted(self.sample[t], first, "left")
        return out

    def ascend(self, bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """[query, tree]: the prefix length at which the common ascent ends.

        What all trees hold only grows on the way up, so the level where it first is enough is found by halving."""
        low, high = np.zeros(len(bits), np.int64), np.full(len(bits), LEVELS + 1)
        while (high - low).max(initial=0) > 1:
            middle = (low + high) // 2
            fine = self.held(bits, rest, middle).sum(1) >= self.enough
            low, high = np.where(fine, middle, low), np.where(fine, high, middle)
        below = np.where((low < LEVELS)[:, None], self.held(bits, rest, np.minimum(low + 1, LEVELS)), 0)
        added = self.held(bits, rest, low) - below
        order = np.argsort(added, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(added, order, 1), 1) - np.take_along_axis(added, order, 1) + below.sum(1)[:, None]
        up = np.empty(bits.shape, bool)
        np.put_along_axis(up, order, before < self.enough, 1)
        return np.where(up | (low == LEVELS)[:, None], low[:, None], low[:, None] + 1)


def plan_trees(index: DataFrame, k: int, trees: int, reach: float, seed: int, slice_rows: int) -> tuple[dict[int, Trees], int]:
    """The trees by length of vector, and the number of groups."""
    count = {r["dim"]: r["count"] for r in index.groupBy(F.size("vector").alias("dim")).count().collect()}
    if not count:
        return {}, 0
    enough = {dim: trees * LEAST * (k + 1) + reach * n**POWER for dim, n in count.items()}
    slices = {dim: math.ceil(n / max(slice_rows, enough[dim] / trees / 4)) for dim, n in count.items()}
    part = {dim: max(SAMPLE_ROWS, 16 * slices[dim]) / n for dim, n in count.items()}
    parts = F.create_map(*(F.lit(x) for item in part.items() for x in item))
    draw = F.pmod(F.xxhash64(F.lit(37), "vkey"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = index.where(draw < F.element_at(parts, F.size("vector"))).select("vector").toArrow()["vector"].combine_chunks()
    size = np.diff(drawn.offsets.to_numpy()) if len(drawn) else np.zeros(0, np.int64)
    plan, base = {}, 0
    for dim in sorted(count):
        where = np.flatnonzero(size == dim)
        flat = drawn.take(pa.array(where)).flatten().to_numpy().reshape(len(where), dim).astype(np.float64)
        bits, rest = hash_strings(flat, trees, seed)
        sample = np.stack([np.sort(strings(bits[:, t], rest[:, t])) for t in range(trees)])
        plan[dim] = Trees(sample, slices[dim] if len(where) else 1, enough[dim] * len(where) / count[dim], base)
        base += trees * plan[dim].slices
    return plan, base


def _forest(index: DataFrame, plan: dict[int, Trees], trees: int, seed: int) -> DataFrame:
    """Every vector in its slice of each tree, and every query (``level`` is not -1) in the slices its range touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, min(1000, batch.num_rows - k))
                column = part.column("vector")
                size = np.diff(column.offsets.to_numpy())
                for dim in np.unique(size).tolist():
                    where = np.flatnonzero(size == dim)
                    flat = column.take(pa.array(where)).flatten().to_numpy().reshape(len(where), dim).astype(np.float64)
                    bits, rest = hash_strings(flat, trees, seed)
                    packed = pa.array([v.tobytes() for v in flat.astype(np.float32 if column.type.value_type == pa.float32() else np.float64)], pa.binary())
                    own = part.take(pa.array(where))
                    asking = np.flatnonzero(own.column("asks").to_numpy(zero_copy_only=False))
                    levels = plan[dim].ascend(bits[asking], rest[asking])
                    for t in range(trees):
                        keys = strings(bits[:, t], rest[:, t])
                        low, high = (plan[dim].slice_of(t, x) for x in prefix_ends(bits[asking, t], rest[asking, t], levels[:, t]))
                        many = high - low + 1
                        to = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                        row = np.concatenate([np.arange(len(where)), np.repeat(asking, many)])
                        group = plan[dim].base + t * plan[dim].slices + np.concatenate([plan[dim].slice_of(t, keys), to])
                        level = np.concatenate([np.full(len(where), -1), np.repeat(levels[:, t], many)])
                        take = pa.array(row)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(group.astype(np.int32)), pa.array(level.astype(np.int8)), pa.array(bits[row, t]), pa.array(rest[row, t].view(np.int64)), own.column("vkey").take(take), packed.take(take)],
                            ["group", "level", "bits", "rest", "vkey", "packed"],
                        )

    return index.select("vkey", "asks", "vector").mapInArrow(run, "group int, level byte, bits long, rest long, vkey long, packed binary")


def _search(forest: DataFrame, plan: dict[int, Trees], k: int, element: np.dtype) -> DataFrame:
    """Per query vector and slice: the best ``k + 1`` entries under its prefix."""

    def run(table: pa.Table) -> pa.Table:
        group = table["group"][0].as_py()
        dim = max((d for d in plan if plan[d].base <= group), key=lambda d: plan[d].base)
        bits, rest, vkey, level = (table[c].to_numpy() for c in ("bits", "rest", "vkey", "level"))
        keys, packed = strings(bits, rest.view(np.uint64)), table["packed"].combine_chunks()
        entries, queries = np.flatnonzero(level < 0), np.flatnonzero(level >= 0)
        entries = entries[np.argsort(keys[entries], kind="stable")]
        read = lambda at: np.frombuffer(b"".join(packed.take(pa.array(at)).to_pylist()), element).reshape(len(at), dim)
        vectors, asked, ids = read(entries).astype(np.float64), read(queries), vkey[entries]
        first, last = prefix_ends(bits[queries], rest[queries].view(np.uint64), level[queries].astype(np.int64))
        low, high = np.searchsorted(keys[entries], first, "left"), np.searchsorted(keys[entries], last, "right")
        found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for q, v, a, b in zip(vkey[queries], asked, low, high):
            score = vectors[a:b] @ v.astype(np.float64)
            if len(score) > k + 1:
                least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                near = np.flatnonzero(score >= least)
            else:
                near = np.arange(len(score))
            near = near[np.lexsort((ids[a:b][near], -score[near]))][: k + 1]
            found.append((np.full(len(near), q), ids[a:b][near], score[near]))
        return pa.table(dict(zip(("asker", "vkey", "score"), map(np.concatenate, zip(*found)))))

    return forest.groupBy("group").applyInArrow(run, "asker long, vkey long, score double")


def nearest(rows: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, reach: float = REACH, seed: int = 31, slice_rows: int = SLICE_ROWS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` nearest found for every query row."""
    usable = rows.where(_usable(F.col(vector))).select(key, vector, is_query.alias("_asks"))
    element = np.dtype(np.float32 if usable.schema[vector].dataType.elementType.simpleString() == "float" else np.float64)
    distinct = distinct_vectors(usable, k, key, vector)
    index = materialize(distinct, "forest-index")
    plan, groups = plan_trees(index, k, trees, reach, seed, slice_rows)
    forest = _forest(index, plan, trees, seed).repartition(max(1, groups), "group")
    hits = _search(forest, plan, k, element).groupBy("asker", "vkey").agg(F.max("score").alias("score"))
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "vkey")
    best = hits.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k + 1)
    named = best.join(index.select("vkey", "ids"), "vkey").select("asker", "score", F.explode("ids").alias("id"))
    # k + 1 ids for each distinct query vector; a query drops its own
    top = named.withColumn("_rank", F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "id"))).where(F.col("_rank") <= k + 1)
    lists = top.groupBy("asker").agg(F.sort_array(F.collect_list(F.struct("_rank", "id", "score"))).alias("found"))
    lists = lists.join(index.select(F.col("vkey").alias("asker"), "vector"), "asker")
    queries = usable.where("_asks").select(F.col(key).alias("query_id"), vector)
    answered = queries.join(lists, queries[vector] == lists["vector"])
    own = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    ranked = answered.select("query_id", F.posexplode(own).alias("pos", "hit"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
