"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a target number of words. Full passes over a source take each document whole; the rest of the target
is met from a random permutation of the source's blocks (fixed hash groups of documents). Each pass's blocks form the
source's quota. A binary tree over the output shards splits all quotas at once: at each node the blocks that go left
are one multivariate-hypergeometric draw from those at hand, so shards get equal numbers of blocks and, in expectation,
the mixture's proportions. A shard's blocks of a source are disjoint stretches of a permutation, and rows are ordered
within the shard by hash.

Only totals per source and per block reach the driver: blocks hold about ``block_docs`` documents, and a source has at
most ``MAX_BLOCKS``. Documents stay in place; each is joined with its block's few instances. All draws come from hashes
and seeded generators, so reruns agree.

A null text has size 0 and takes part with 0 words; a null source is a source of its own, the last. No rows give no rows.
Repeated keys are separate documents of the same block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MAX_BLOCKS = 4096
LATER = 64
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets in proportion to the weights that add up to ``share`` of all sizes, none above ``most`` times its size.

    Excess is shared again by weight among the sources below their limit; if all are at it, the rest stays unassigned.
    """
    left = share * sum(sizes)
    out = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        weight = sum(weights[k] for k in free)
        full = {k for k in free if left * weights[k] / weight > most * sizes[k]}
        if not full:
            for k in free:
                out[k] = left * weights[k] / weight
            break
        for k in full:
            out[k] = most * sizes[k]
        left -= sum(out[k] for k in full)
        free -= full
    return out


def split_quotas(blocks: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """A row per shard, a column per source: how many of the source's blocks the shard gets."""
    if shards == 1 or not len(blocks):
        return blocks[None, :]
    left = shards // 2
    take = int(blocks.sum()) * left // shards
    drawn = rng.multivariate_hypergeometric(blocks, take, method="marginals") if blocks.sum() else blocks
    return np.vstack([split_quotas(drawn, left, rng), split_quotas(blocks - drawn, shards - left, rng)])


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _plan(sizes: pd.DataFrame, blocks: pd.DataFrame, target: list[float], shards: int, seed: int) -> list[tuple]:
    """Instances of blocks: source number, block, pass, words asked of a partly taken block (else None), shard."""
    rng = np.random.default_rng(seed)
    rows, count = [], []
    grouped = dict(iter(blocks.groupby("source_no")))
    for k, size in zip(sizes["source_no"], sizes["source_size"]):
        group = grouped[k].sort_values("block")
        ids, words = group["block"].tolist(), group["words"].tolist()
        passes = int(target[k] // size) if size else 0
        rest = round(target[k] - passes * size)
        own = [(k, b, p, None) for p in range(passes) for b in ids]
        for j in rng.permutation(len(ids)):
            if rest > 0 and words[j]:
                own.append((k, ids[j], passes, None if words[j] <= rest else rest))
                rest -= min(rest, words[j])
        count.append(len(own))
        rows.append([own[j] for j in rng.permutation(len(own))])
    quotas = split_quotas(np.array(count, np.int64), shards, rng)
    return [(*row, int(s)) for k, own in enumerate(rows) for row, s in zip(own, np.repeat(np.arange(shards), quotas[:, k]))]


def _cut(rows: pd.DataFrame) -> tuple[int, list[int]]:
    """Documents a partly taken block gives, by their place: all up to a cut, and single later ones that still fit.

    Rows that share a place (repeated keys) go together. After the cut at most ``LATER`` documents are added.
    """
    rest = int(rows["rest"].iloc[0])
    units = rows.groupby("place")["_size"].sum().sort_index()
    total = units.cumsum()
    head = int((total <= rest).sum())
    rest -= int(total.iloc[head - 1]) if head else 0
    later = []
    for place, size in units.iloc[head:].sort_values(ascending=False, kind="stable").items():
        if 0 < size <= rest and len(later) < LATER:
            later.append(int(place))
            rest -= size
    over = units.iloc[head:].drop(later)
    over = over[over > rest]
    if len(over) and over.min() < 2 * rest:  # one more document comes nearer than stopping short
        later.append(int(over.idxmin()))
    return (int(units.index[head - 1]) if head else -(1 << 63)), later


def mix(docs: DataFrame, shards: int = 16, seed: int = 23, key: str = "doc_id", source: str = "source", size: str = "size", block_docs: int = 256, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, sized: DataFrame | None = None) -> DataFrame:
    """Each row with its columns and ``source_size``, ``target`` and ``copies``: an array of (``pass``, ``shard``), an
    element for each time the mixture takes the document. ``size`` names the column with a document's words.

    ``sized`` may hold key, source and size of the same rows; then only it is read for planning, and ``docs`` needs no
    size. Columns of the input named like an added one give way to it.
    """
    spark = docs.sparkSession
    docs = docs.drop("source_size", "target", "copies")

    def held(df: DataFrame) -> DataFrame:
        return df.withColumns({"_mix_cell": F.pmod(F.xxhash64(F.lit(seed), key), F.lit(MAX_BLOCKS)), "_mix_place": F.xxhash64(F.lit(seed + 1), key)})

    sized = held((docs if sized is None else sized).select(key, F.col(source).alias("_mix_from"), F.col(size).alias("_mix_size"))).drop(key)
    cells = sized.groupBy("_mix_from", "_mix_cell").agg(F.sum("_mix_size").alias("words"), F.count("*").alias("docs"))
    sizes = cells.groupBy("_mix_from").agg(F.sum("words").alias("source_size"), F.sum("docs").alias("docs")).toPandas()
    names = [None if pd.isna(s) else s for s in sizes["_mix_from"]]
    order = sorted(range(len(names)), key=lambda k: (names[k] is None, names[k] or ""))
    sizes = sizes.iloc[order].reset_index(drop=True).assign(source_no=range(len(names)))
    target = targets(sizes["source_size"].tolist(), [weights[k % len(weights)] for k in range(len(names))], share, most)
    blocks = np.clip(sizes["docs"] // block_docs, 1, MAX_BLOCKS).astype(int)
    known = spark.createDataFrame(
        [(names[k], no, int(z), float(t), int(b)) for no, (k, z, t, b) in enumerate(zip(order, sizes["source_size"], target, blocks))],
        "_mix_source string, _mix_no int, source_size long, target double, _mix_blocks int",
    )
    known = F.broadcast(known)  # a row per source, as collected above

    def placed(df: DataFrame, source: str = "_mix_from") -> DataFrame:
        joined = df.join(known, df[source].eqNullSafe(F.col("_mix_source")))
        return joined.withColumn("_mix_block", F.floor(F.col("_mix_cell") * F.col("_mix_blocks") / MAX_BLOCKS).cast("int")).drop("_mix_source", "_mix_blocks", "_mix_cell")

    words = placed(cells).groupBy(F.col("_mix_no").alias("source_no"), F.col("_mix_block").alias("block")).agg(F.sum("words").alias("words")).toPandas()
    plan = _plan(sizes, words, target, shards, seed)
    partly = spark.createDataFrame([(int(k), int(b), int(r)) for k, b, _, r, _ in plan if r is not None], "_mix_no int, _mix_block int, rest long")

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        at, later = _cut(rows.rename(columns={"_mix_place": "place", "_mix_size": "_size"}))
        return pd.DataFrame({"_mix_no": [rows["_mix_no"].iloc[0]], "_mix_block": [rows["_mix_block"].iloc[0]], "cut": [at], "later": [later]})

    edge = placed(sized).select("_mix_no", "_mix_block", "_mix_place", "_mix_size").join(F.broadcast(partly), ["_mix_no", "_mix_block"])  # a block per source
    cuts = {(r["_mix_no"], r["_mix_block"]): (r["cut"], r["later"]) for r in edge.groupBy("_mix_no", "_mix_block").applyInPandas(cut, "_mix_no int, _mix_block int, cut long, later array<long>").collect()}
    taken: dict[tuple[int, int], list[tuple]] = {}
    for k, b, p, rest, shard in plan:
        at, later = (None, None) if rest is None else cuts[k, b]
        taken.setdefault((int(k), int(b)), []).append((int(p), shard, at, later))
    slots = spark.createDataFrame([(*at, copies) for at, copies in taken.items()], "_mix_no int, _mix_block int, _mix_slots array<struct<pass:int,shard:int,cut:bigint,later:array<bigint>>>")
    rows = placed(held(docs), source).join(F.broadcast(slots), ["_mix_no", "_mix_block"], "left")  # a row per block

    def gives(slot):
        return slot["cut"].isNull() | (F.col("_mix_place") <= slot["cut"]) | F.array_contains(slot["later"], F.col("_mix_place"))

    copies = F.transform(F.filter("_mix_slots", gives), lambda s: F.struct(s["pass"].alias("pass"), s["shard"].alias("shard")))
    none = F.array().cast("array<struct<pass:int,shard:int>>")
    return rows.select(*docs.columns, "source_size", "target", F.coalesce(copies, none).alias("copies"))


def sizes_of(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Key, source and ``size`` in words of every row, stored: what planning a mixture needs of the texts."""
    return materialize(docs.select(key, source, word_count(F.col(text)).alias("size")), "mixing-sizes")


def mixture(docs: DataFrame, text: str = "text", seed: int = 23, key: str = "doc_id", source: str = "source", sized: DataFrame | None = None, **options) -> DataFrame:
    """The rows of the mixture: a document's columns once for each copy, with ``shard`` and ``shard_order``.

    Texts are read once for their sizes (unless ``sized`` has them already, see ``sizes_of``) and once for the result.
    Columns of the input named like an added one give way to it; those named like an inner one (``_mix_...``) are not
    supported.
    """
    kept = docs.drop("shard", "shard_order")
    sized = sizes_of(docs, key, source, text) if sized is None else sized
    given = [c for c in kept.columns if c in ("source_size", "target", "copies")]
    rows = kept.withColumnsRenamed({c: f"_mix_in_{c}" for c in given})
    taken = mix(rows, seed=seed, key=key, source=source, sized=sized, **options).withColumn("_mix_copy", F.explode("copies"))
    place = F.xxhash64(F.lit(seed + 2), F.col("_mix_copy.shard"), F.col("_mix_copy.pass"), F.col(key))
    own = [F.col(f"_mix_in_{c}").alias(c) if c in given else F.col(c) for c in kept.columns]
    return taken.select(*own, F.col("_mix_copy.shard").alias("shard"), place.alias("shard_order"))
