"""N-gram Jaccard join: a token-group matrix over documents' sets of word shingles.

Exact copies become one set first. The number of documents that hold each shingle is found for all shingles; a set's
rarest shingles (as many as one of them must be in any partner) are its keys. Sets that share their most common key form
a group, stored as the shingles of its most typical member, the hub, and the most that a member has beside them: a bound
of the group's union. Members that reach the threshold with the hub are linked to it and stay in the group; the others
are grouped anew by their least common shared key, some rounds long, and then stand alone.

A set meets the other groups that share a key with it, where the key, as the first the two share, leaves enough behind it
on both sides. What it has in common with the hub, and the group's most beside
it, bound its overlap with any member. Only groups whose bound reaches the threshold are opened: the set is compared
with the members that share a key with it, exactly. Within a group no pairs are made. The links found connect the same
documents as all pairs would; links that only repeat a connection through a hub are not listed.

Shingles are 64-bit hashes. A text of fewer words than ``width`` is one shingle; texts without words have an empty set
and no links. Rows with equal keys and different texts are separate texts of one id. Rows with a null key have a null
component. Sets of any size are compared whole, and groups of any size are never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .exchange import BLOBS, Layout, answer, blob_table, lookup
from .graph import components
from .textops import Words, chunks, mix64, release, spans_per_doc, window_hashes

ROUNDS = 3


def signatures(words: Words, hashes: np.ndarray) -> np.ndarray:
    """A hash of each document's whole sequence of words."""
    n = words.counts()
    place = np.arange(len(hashes)) - np.repeat(words.first[:-1], n)
    value = mix64(hashes + place.astype(np.uint64) * np.uint64(0x9E6C63D0876A9A47))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    return mix64(total[words.first[1:]] - total[words.first[:-1]] + n.astype(np.uint64))


def shingle_sets(words: Words, hashes: np.ndarray, width: int, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every document, and their bounds. ``whole``: hashes of the documents as a whole."""
    shingle, at = window_hashes(hashes, words.first, width)
    first = spans_per_doc(at, words.first)
    short = np.flatnonzero((np.diff(first) == 0) & (words.counts() > 0))
    if len(short):
        shingle = np.insert(shingle, first[short], whole[short])
        add = np.zeros(len(first), np.int64)
        add[short + 1] = 1
        first = first + np.cumsum(add)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        shingle[a:b].sort()
    keep = np.ones(len(shingle), bool)
    if len(shingle):
        keep[1:] = shingle[1:] != shingle[:-1]
        keep[first[:-1][np.diff(first) > 0]] = True
    total = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    return shingle[keep], total[first]


def text_signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                words = Words(part.column(text), lower=True)
                sig = signatures(words, words.hashes()).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(sig), pa.array(words.counts(), pa.int64())], ["id", "sig", "words"])

    return docs.select(F.col(key).cast("long").alias("_id"), text).mapInArrow(run, "id long, sig long, words long")


def _sets(table: pa.Table, told: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, shingles and bounds of the cell's documents that stand for their copies."""
    chosen = b"".join(p for b, p in zip(told["bucket"].to_pylist(), told["packed"].to_pylist()) if b < 0)
    chosen = set(map(tuple, np.frombuffer(chosen, np.int64).reshape(-1, 2).tolist()))
    table = table.filter(pa.array(np.isin(table["_key"].to_numpy(), np.array([k for _, k in chosen], np.int64))))
    words = Words(table["_text"].combine_chunks(), lower=True)
    hashes = words.hashes()
    whole = signatures(words, hashes)
    shingle, first = shingle_sets(words, hashes, width, whole)
    sig, keep, seen = whole.view(np.int64), [], set()
    for d, pair in enumerate(zip(sig.tolist(), table["_key"].to_pylist())):
        if pair in chosen and pair not in seen:
            seen.add(pair)
            keep.append(d)
    if len(keep) < len(sig):
        size = np.diff(first)[keep]
        take = np.repeat(first[:-1][keep] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        shingle, first = shingle[take], np.concatenate([[0], np.cumsum(size)])
    return sig[keep], shingle, first


def _chosen(table: pa.Table) -> pa.Table:
    pairs = np.stack([table["sig"].to_numpy(), table["rep"].to_numpy()], 1)
    return blob_table([(int(table["_cell"][0].as_py()), -1, pairs.tobytes())])


def _send_counts(layout: Layout, width: int):
    """Blobs of a cell's shingles, flagged with the number of its sets that hold each: 1, 2 or more (3)."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        release()
        if not table.num_rows or not told.num_rows:
            return blob_table([])
        _, shingle, _ = _sets(table, told, width)
        short = layout.short(shingle)
        short.sort()
        first = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])) if len(short) else np.zeros(0, np.int64)
        count = np.diff(first, append=len(short))
        return blob_table(layout.blobs(int(table["_cell"][0].as_py()), short[first], np.minimum(count, 3)))

    return run


def _rarity(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Silence for shingles of one set; for others a class by the number of sets: below 4, 16, 256, above."""
    count = np.add.reduceat(flags.astype(np.int64), first)
    return np.where(count < 2, 255, np.searchsorted([4, 16, 256], count, "right")).astype(np.uint8)


def _send_prefixes(layout: Layout, width: int, percent: int):
    """Per set: its size, its shingles that no other set has, and, if others share its rarest ones, those and all."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        release()
        out: dict[str, list] = {"sig": [], "n": [], "lone": [], "prefix": [], "tokens": []}
        if table.num_rows and told.num_rows:
            sig, shingle, first = _sets(table, told, width)
            buckets, packed = told["bucket"].to_pylist(), told["packed"].to_pylist()
            where = [k for k, b in enumerate(buckets) if b >= 0]
            known, rarity = layout.unpack_answers([buckets[k] for k in where], [packed[k] for k in where])
            at = lookup(known, layout.short(shingle))
            level = np.where(at >= 0, rarity[at] + 1, 0) if len(rarity) else np.zeros(len(shingle), np.int64)
            for d, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                n = b - a
                if not n:
                    continue
                own, lone = level[a:b], int((level[a:b] == 0).sum())
                # any partner shares at least ceil(percent * n / 100) shingles, so one of the n - that + 1 rarest
                length = n - -(-percent * n // 100) + 1
                prefix = shingle[a:b][np.argsort(own, kind="stable")[lone:length]] if lone < length else None
                out["sig"].append(int(sig[d]))
                out["n"].append(n)
                out["lone"].append(lone)
                out["prefix"].append(None if prefix is None else prefix.view(np.int64))
                out["tokens"].append(None if prefix is None else shingle[a:b].tobytes())
        kinds = {"sig": pa.int64(), "n": pa.int64(), "lone": pa.int64(), "prefix": pa.list_(pa.int64()), "tokens": pa.binary()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return run


SETS = "sig long, n long, lone long, prefix array<long>, tokens binary"
LINKED = "a long, b long, common long, linked boolean"


def _compare(pairs: DataFrame, percent: int) -> DataFrame:
    """Shared shingles of the sets ``a`` and ``b``, and whether they are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            common, linked = [], []
            for b, bt, at in zip(*(batch.column(c).to_pylist() for c in ("b", "b_tokens", "a_tokens"))):
                if b != last:
                    last, held = b, np.frombuffer(bt, np.uint64)
                own = np.frombuffer(at, np.uint64)
                at_ = np.minimum(np.searchsorted(held, own), len(held) - 1)
                n = int((held[at_] == own).sum())
                common.append(n)
                linked.append(100 * n >= percent * (len(own) + len(held) - n))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(linked, pa.bool_())], ["a", "b", "common", "linked"])

    return pairs.select("a", "b", "a_tokens", "b_tokens").mapInArrow(run, LINKED)


def _compare_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    own = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("a_tokens"))
    held = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("b_tokens"))
    return _compare(pairs.join(own, "a").join(held, "b"), percent)


def _gather(lists: DataFrame, sets: DataFrame, percent: int, name: str, common: bool) -> DataFrame:
    """One partition of sets into groups: each joins, of the lists it shares with others, the one with the most members
    (``common``) or the fewest, and is compared with the group's hub, the member with the smallest share of shingles
    that no other set has."""
    size = lists.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    choice = lists.join(size, "token").groupBy("sig", "n", "lone").agg((F.max if common else F.min)(F.struct("members", "token")).alias("best"))
    choice = materialize(choice.select("sig", "n", "lone", F.col("best.token").alias("token")), name + "-choice")
    hubs = choice.groupBy("token").agg(F.min(F.struct((F.col("lone") / F.col("n")).alias("share"), F.col("sig").alias("hub"))).alias("best"))
    pairs = choice.join(hubs.select("token", F.col("best.hub").alias("hub")), "token")
    return materialize(_compare_pairs(pairs.select(F.col("sig").alias("a"), F.col("hub").alias("b")), sets, percent), name)


def set_links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (``a``, ``b``) between signatures that connect the same sets as all links do."""
    shared = sets.where(F.col("prefix").isNotNull())
    # Prefixes have one order for all sets. If a token is the first that two sets share, neither has more in common with the
    # other than what it holds from there on: ``reach`` is the size of the largest partner which that allows.
    placed = shared.select("sig", "n", "lone", F.posexplode("prefix").alias("place", "token"))
    reach = F.floor(((100 + percent) * (F.col("n") - F.col("lone") - F.col("place")) - percent * F.col("n")) / percent)
    lists = placed.select("sig", "n", "lone", "token", reach.alias("reach"))
    rest, labels = lists, None
    for k in range(ROUNDS):
        found = _gather(rest, shared, percent, f"group-{k}", k == 0).where("linked")
        labels = found if labels is None else labels.union(found)
        rest = rest.join(found.select(F.col("a").alias("sig")), "sig", "left_anti")
        if found.isEmpty():
            break
    # the matrix: a label is a group with its hub's shingles and the most that a member has beside them
    named = labels.select(F.col("a").alias("sig"), F.col("b").alias("label"), "common", F.lit(False).alias("alone"))
    lone = lists.select("sig").distinct().join(named.select("sig"), "sig", "left_anti")
    named = materialize(named.union(lone.select("sig", "sig", F.lit(None).cast("long"), F.lit(True))), "labels")
    known = lists.join(named, "sig").withColumn("common", F.coalesce("common", "n"))
    marked = materialize(known.select("sig", "n", "lone", "token", "reach", "label", "common", "alone"), "lists")
    # groups of a hub alone have no entry: there is nothing to open
    extra = marked.where("sig <> label").groupBy("label").agg(F.max(F.col("n") - F.col("common")).alias("extra"))
    # Lone shingles are in no intersection, so of any linked two one has few of them. Two labels meet from one side only:
    # a set that is alone looks for groups and for rich sets, of two groups the members of one look for the other.
    miss = 100 - percent
    rich = miss * (F.col("n") - F.col("lone")) >= 2 * percent * F.col("lone")
    groups = marked.where(rich | ~F.col("alone")).groupBy("token", F.col("label").alias("b")).agg(F.min("lone").alias("least"), F.min("n").alias("shortest"), F.max("reach").alias("longest"), F.first("alone").alias("b_alone"))
    room = miss * (F.col("n") - F.col("lone")) >= percent * (F.col("lone") + F.col("least"))
    room &= (F.col("shortest") <= F.col("reach")) & (F.col("n") <= F.col("longest"))
    both = F.col("alone") & F.col("b_alone")
    seeks = F.when(both, ~rich | (F.col("sig") < F.col("b"))).when(F.col("alone") | F.col("b_alone"), F.col("alone")).otherwise(F.col("label") < F.col("b"))
    meets = marked.join(groups, "token").where((F.col("label") != F.col("b")) & room & seeks).groupBy(F.col("sig").alias("a"), "b").agg(F.first("n").alias("n"))
    meets = materialize(meets, "meets")
    bounds = materialize(_compare_pairs(meets.select("a", "b"), shared, percent), "bounds")
    edges = named.where("sig <> label").select(F.col("sig").alias("a"), F.col("label").alias("b"))
    edges = edges.union(bounds.where("linked").select("a", "b"))
    # open a group only if what a set shares with the hub and the most a member has beside it can reach the threshold; members
    # that are parts of the hub have nothing beside it, but may be small enough for a set that the hub is too large for
    closed = bounds.where("not linked").select("a", "b", F.col("common").alias("with_hub")).join(meets, ["a", "b"]).join(extra.withColumnRenamed("label", "b"), "b")
    opened = materialize(closed.where(100 * (F.col("with_hub") + F.col("extra")) >= percent * F.col("n")).select("a", "b", "with_hub"), "opened")
    if opened.isEmpty():
        return edges
    x = marked.select(F.col("sig").alias("a"), "n", "lone", "token", "reach").join(opened.withColumnRenamed("b", "label"), "a")
    y = marked.where("sig <> label").select(F.col("sig").alias("b"), F.col("n").alias("yn"), F.col("lone").alias("yl"), "token", F.col("reach").alias("yr"), "label", "common")
    shared_most = F.least("with_hub", "common") + F.least(F.col("n") - F.col("with_hub"), F.col("yn") - F.col("common"))
    shared_most = F.least(shared_most, F.col("n") - F.col("lone"), F.col("yn") - F.col("yl"))
    possible = (F.col("yn") <= F.col("reach")) & (F.col("n") <= F.col("yr"))
    possible &= (100 * shared_most >= percent * (F.col("n") + F.col("yn") - shared_most)) & (miss * shared_most >= percent * (F.col("lone") + F.col("yl")))
    pairs = x.join(y, ["token", "label"]).where(possible).select("a", "b").distinct()
    return edges.union(_compare_pairs(pairs, shared, percent).where("linked").select("a", "b"))


def jaccard_groups(docs: DataFrame, width: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` (an integer), ``n_shingles`` and ``component_id`` for each row: the smallest key among the documents
    reachable over links, a link being 100 * intersection >= ``percent`` * union."""
    texts = materialize(text_signatures(docs, key, text), "texts")
    reps = texts.where("words > 0 and id is not null").groupBy("sig").agg(F.min("id").alias("rep"))
    keyed = docs.select(F.col(key).cast("long").alias(key), text).where(F.col(key).isNotNull())
    layout = Layout(keyed, text)
    dealt = layout.dealt(keyed, key, text)
    cell = F.pmod(F.xxhash64(F.lit(71), "rep"), F.lit(layout.cells)).cast("int")
    chosen = reps.withColumn("_cell", cell).groupBy("_cell").applyInArrow(_chosen, BLOBS)
    counts = dealt.groupBy("_cell").cogroup(chosen.groupBy("_cell")).applyInArrow(_send_counts(layout, width), BLOBS)
    told = answer(counts, _rarity).union(chosen)
    sets = materialize(dealt.groupBy("_cell").cogroup(told.groupBy("_cell")).applyInArrow(_send_prefixes(layout, width, percent), SETS), "sets")
    roots = components(set_links(sets, percent)).toDF("sig", "root")
    known = reps.join(sets.select("sig", "n"), "sig").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    known = materialize(known, "known")
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    labelled = known.join(least, "root").select("sig", "n", "component_id")
    found = texts.where("id is not null").join(labelled, "sig", "left")
    result = found.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))

    def unkeyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                words = Words(part.column(text), lower=True)
                hashes = words.hashes()
                _, first = shingle_sets(words, hashes, width, signatures(words, hashes))
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(np.diff(first)), none], [key, "n_shingles", "component_id"])

    return result.union(docs.select(key, text).where(F.col(key).isNull()).select(text).mapInArrow(unkeyed, result.schema))
