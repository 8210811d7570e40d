"""Source divergence audit by chunk factorization.

A chunk is a run without ASCII white space, a term a run of letters in it (all non-ASCII characters count as letters),
A-Z lower-cased; so terms never cross chunks. Documents are dealt by language and source, a large source in many cells,
and each cell's chunks are counted, so that counts add up before they travel. All rows of a chunk meet in one bucket,
where each distinct chunk is split into terms once, and its terms take over the chunk's rows. What is left is a table of
(language, source, term) counts.

A language keeps the terms of at least ``min_docs`` of its documents. For that, a count row names its document; where
``min_docs`` documents of a language share a chunk or term, rows without a document stand for them, one for each source,
because more need not be known. Nothing is cut off: every other document is named until the last sum.

Every kept term has in every group (a language and source, or a whole language) the scaled smoothed share
``p = 1 + floor(10**9 * (count + 1) / (N + V))``, and ``f = floor((p - q)**2 / q)`` compares two groups. Sums of ``f``
over all kept terms split into what each group's own counts give against a group without them (by a histogram of its
counts), and a correction for terms that both hold; terms that neither holds share one value. So no row is made for a
term that a group lacks, and pairs meet within blocks of terms and are added up there.

Null text, language and source read as empty texts. Repeated rows and ids are separate documents; ids are not read. A
group without terms has count 0 for every kept term. Languages without kept terms give pairs of value 0 and no terms;
a language with one source gives no pairs. Equal values are ranked by item. Of the input only the three named columns
are read. An empty table gives no rows.

Chunks are told apart by 64-bit hashes within a task's stretch of text (about a million chunks), and by their text in the
buckets. Buckets and blocks follow the input's size. Groups are numbered in one table that Spark joins by its size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textops import Words, chunks

SCALE = 10**9
#: The shape of a term: what is not ASCII, or an ASCII letter.
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
HELD_ROWS = 500_000
CELL_BYTES = 32 << 20
BUCKET_BYTES = 12 << 20
BLOCK_ROWS = 200_000
MANY = -1  # stands for ``min_docs`` documents or more


def _settle(key: np.ndarray, code: np.ndarray, doc: np.ndarray, n: np.ndarray, min_docs: int, by_doc: bool = False) -> tuple[np.ndarray, ...]:
    """Rows of (key, code, document) with their sums; where a language (the high bits of the code) has ``min_docs``
    documents for a key, one row for each code instead. Also the place of each result's first input row. ``by_doc``: the
    rows are in order of code and document.
    """
    order = np.argsort(key, kind="stable") if by_doc else np.lexsort((doc, code, key))
    key, code, doc, n = key[order], code[order], doc[order], n[order]
    if not len(key):
        return key, code, doc, n, order

    def starts(*columns: np.ndarray) -> np.ndarray:
        new = np.ones(len(columns[0]), bool)
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    at = starts(key, code, doc)
    n = np.add.reduceat(n, at)
    key, code, doc, order = key[at], code[at], doc[at], order[at]
    run = starts(key, code >> 32)
    size = np.diff(run, append=len(key))
    many = np.repeat((size >= min_docs) | np.logical_or.reduceat(doc == MANY, run), size)
    doc = np.where(many, MANY, doc)
    at = starts(key, code, doc)
    return key[at], code[at], doc[at], np.add.reduceat(n, at), order[at]


def _strings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow text column."""
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    data = raw[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])] if len(size) else raw[:0]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _doc_column(doc: np.ndarray) -> pa.Array:
    return pa.array(doc, pa.int64(), mask=doc == MANY)


def _counted(docs: DataFrame, min_docs: int) -> DataFrame:
    """``chunk``, ``_code``, ``doc``, ``n``: the chunks of each task's documents, a stretch of documents at a time."""

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        known = pa.chunked_array([h[4] for h in held])
        shift = np.cumsum([0] + [len(h[4]) for h in held[:-1]])
        word = np.concatenate([h[5] + s for h, s in zip(held, shift)])
        key, code, doc, n, first = _settle(*(np.concatenate([h[k] for h in held]) for k in range(4)), min_docs)
        text = known.take(pa.array(word[first])).combine_chunks().cast(pa.string())
        whole = pa.RecordBatch.from_arrays([text, pa.array(code), _doc_column(doc), pa.array(n)], ["chunk", "_code", "doc", "n"])
        for k in range(0, whole.num_rows, 100_000):
            yield whole.slice(k, 100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for part in chunks(batch, "_text"):
                part = part.sort_by([("_code", "ascending"), ("_doc", "ascending")])
                words = Words(part.column("_text"))
                doc = words.doc()
                code = part.column("_code").to_numpy()[doc]
                key, code, doc, n, first = _settle(words.hashes(), code, part.column("_doc").to_numpy()[doc], np.ones(len(doc), np.int64), min_docs, True)
                if not len(key):
                    continue
                head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                text = _strings(words.raw, words.start[first[head]], words.end[first[head]])
                held.append((key, code, doc, n, text, np.repeat(np.arange(len(head)), np.diff(head, append=len(key)))))
                rows += len(key)
                if rows >= HELD_ROWS:
                    yield from flush(held)
                    held, rows = [], 0
        if held:
            yield from flush(held)

    return docs.mapInArrow(run, "chunk string, _code long, doc long, n long")


def split_chunks(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """For lower-cased chunks: the chunk's number, term and number of occurrences of each term in each chunk."""
    at, terms, times = [], [], []
    for k, text in enumerate(texts):
        found = TERM.findall(text)
        if len(found) > 1:
            for term, count in Counter(found).items():
                at.append(k)
                terms.append(term)
                times.append(count)
        elif found:
            at.append(k)
            terms.append(found[0])
            times.append(1)
    return np.array(at, np.int64), terms, np.array(times, np.int64)


def _terms(counted: DataFrame, buckets: int, min_docs: int) -> DataFrame:
    """``term``, ``_code``, ``doc``, ``n``: each distinct chunk split once, in its bucket, and joined with its rows."""

    def run(table: pa.Table) -> pa.Table:
        coded = table["chunk"].combine_chunks().dictionary_encode()
        at, terms, times = split_chunks(pc.ascii_lower(coded.dictionary).to_pylist())
        chunk = coded.indices.to_numpy().astype(np.int64)
        first = np.searchsorted(at, np.arange(len(coded.dictionary) + 1))
        many = np.diff(first)[chunk]
        row = np.repeat(np.arange(len(chunk)), many)
        place = np.repeat(first[:-1][chunk] - np.cumsum(many) + many, many) + np.arange(len(row))
        term = pa.array(terms, pa.string()).dictionary_encode()
        code, n = table["_code"].to_numpy(), table["n"].to_numpy()
        doc = pc.fill_null(table["doc"], MANY).to_numpy()
        key, code, doc, n, _ = _settle(term.indices.to_numpy().astype(np.int64)[place], code[row], doc[row], n[row] * times[place], min_docs)
        return pa.table({"term": term.dictionary.take(pa.array(key)), "_code": pa.array(code), "doc": _doc_column(doc), "n": pa.array(n)})

    bucket = F.pmod(F.xxhash64(F.lit(41), "chunk"), F.lit(buckets)).cast("int")
    dealt = counted.withColumn("_bucket", bucket).groupBy("_bucket")
    return dealt.applyInArrow(run, "term string, _code long, doc long, n long")


def group_table(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """Every occurring language and source: ``_group`` numbers them, ``_code`` has the language's number above it."""
    each = docs.groupBy(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source")).agg(
        F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("size")
    )
    number = F.row_number().over(Window.orderBy("lang", "source"))
    code = F.shiftleft(F.dense_rank().over(Window.orderBy("lang")).cast("long"), 32) + number
    return materialize(each.select("lang", "source", "size", number.alias("_group"), code.alias("_code")), "divergence-groups")


def kept_terms(docs: DataFrame, groups: DataFrame, min_docs: int = 3, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``_group``, ``term``, ``n`` (in the group), ``total`` (in the language) and ``leads`` (true once for a
    language and term), for the terms that a language keeps and the groups that hold them."""
    named = docs.select(
        F.coalesce(text, F.lit("")).alias("_text"), F.coalesce(lang, F.lit("")).alias("_lang"), F.coalesce(source, F.lit("")).alias("_source"),
        F.monotonically_increasing_id().alias("_doc"),
    )
    known = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "_code", F.ceil(F.col("size") / CELL_BYTES).alias("_cells"))
    cell = F.pmod(F.xxhash64(F.lit(47), "_doc"), F.greatest("_cells", F.lit(1)))
    rows = named.join(known, ["_lang", "_source"]).where("_text <> ''").select("_text", "_code", "_doc", cell.alias("_cell"))
    rows = rows.repartition("_code", "_cell").select("_text", "_code", "_doc")
    size = groups.agg(F.sum("size").alias("n")).first()["n"] or 0
    dealt = _terms(_counted(rows, min_docs), max(1, -(-size // BUCKET_BYTES)), min_docs).repartition("term")
    # The deal by term serves all that follows: documents, groups, languages.
    by_doc = dealt.groupBy("term", "_code", "doc").agg(F.sum("n").alias("n"))
    by_group = by_doc.groupBy("term", "_code").agg(F.sum("n").alias("n"), F.count("doc").alias("docs"), F.bool_or(F.col("doc").isNull()).alias("many"))
    placed = by_group.join(groups.select("_group", "_code", "lang"), "_code")
    inside = Window.partitionBy("term", "lang")
    held = placed.select(
        "lang", "_group", "term", "n",
        F.sum("n").over(inside).alias("total"),
        F.sum(F.when(F.col("many"), F.lit(min_docs)).otherwise(F.col("docs"))).over(inside).alias("docs"),
        (F.row_number().over(inside.orderBy("_group")) == 1).alias("leads"),
    )
    return materialize(held.where(F.col("docs") >= min_docs).drop("docs"), "divergence-terms")


def _share(count: str, whole: str, terms: str) -> Column:
    """The scaled smoothed share; in decimals where ``SCALE`` times the count would not fit a long."""
    wide = f"(cast({count} as decimal(20,0)) + 1) * {SCALE} div (cast({whole} as decimal(20,0)) + {terms})"
    return F.expr(f"1 + if({count} < {8 * SCALE}, ({count} + 1) * {SCALE}L div ({whole} + {terms}), {wide})")


def _gap(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def profiles(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """A row per group: its ``whole`` count of kept terms, the language's (``lang_whole``) and its number of kept terms
    (``kept``), and ``p0``, the share of a kept term that the group lacks."""
    own = terms.groupBy("_group").agg(F.sum("n").alias("whole"))
    langs = terms.where("leads").groupBy("lang").agg(F.sum("total").alias("lang_whole"), F.count("*").alias("kept"))
    rows = groups.drop("size", "_code").join(own, "_group", "left").join(langs, "lang", "left").fillna(0, ["whole", "lang_whole", "kept"])
    p0 = F.when(F.col("kept") > 0, _share("0", "whole", "nullif(kept, 0)"))
    return materialize(rows.withColumn("p0", F.coalesce(p0, F.lit(1).cast("long"))), "divergence-profiles")


def _shared(rows: DataFrame, blocks: int) -> DataFrame:
    """``_group``, ``_other``, ``value``: per block of terms, what terms that both hold change in their sum."""

    def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def run(table: pa.Table) -> pa.Table:
        term = table["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.argsort(term, kind="stable")
        term, group, p, p0 = term[order], *(table[c].to_numpy().astype(np.int64)[order] for c in ("_group", "p", "p0"))
        pairs, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        here = np.arange(len(term))
        for step in range(1, len(term)):
            here = here[here + step < len(term)]
            here = here[term[here] == term[here + step]]
            if not len(here):
                break
            for a, b in ((here, here + step), (here + step, here)):
                key, at = np.unique(group[a] << 32 | group[b], return_inverse=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, at, gap(p[a], p[b]) - gap(p[a], p0[b]) - gap(p0[a], p[b]) + gap(p0[a], p0[b]))
                pairs.append(key)
                values.append(total)
        pair = np.concatenate(pairs)
        return pa.table({"_group": pa.array((pair >> 32).astype(np.int32)), "_other": pa.array((pair & 0xFFFFFFFF).astype(np.int32)), "value": np.concatenate(values)})

    block = F.pmod(F.xxhash64(F.lit(43), "term"), F.lit(blocks)).cast("int")
    return rows.withColumn("_block", block).groupBy("lang", "_block").applyInArrow(run, "_group int, _other int, value long")


def pair_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``_group``, ``_other``, ``value`` for every two sources of a language, both ways round."""
    others = groups.select("lang", F.col("_group").alias("_other"), F.col("p0").alias("q0"))
    met = lambda rows: rows.join(others, "lang").where("_group <> _other")
    neither = met(groups).select("_group", "_other", (F.col("kept") * _gap("p0", "q0")).alias("value"))
    level = terms.groupBy("_group", "n").agg(F.count("*").alias("times")).join(groups, "_group").withColumn("p", _share("n", "whole", "kept"))
    own = met(level).groupBy("_group", "_other").agg(
        F.sum(F.col("times") * (_gap("p", "q0") - _gap("p0", "q0"))).alias("to"), F.sum(F.col("times") * (_gap("q0", "p") - _gap("q0", "p0"))).alias("back")
    )
    there = own.select("_group", "_other", F.col("to").alias("value"))
    back = own.select(F.col("_other").alias("_group"), F.col("_group").alias("_other"), F.col("back").alias("value"))
    rows = terms.join(groups.select("_group", "whole", "kept", "p0"), "_group").select("lang", "_group", "term", "p0", _share("n", "whole", "kept").alias("p"))
    both = _shared(rows, max(1, -(-terms.count() // BLOCK_ROWS)))
    return neither.unionAll(there).unionAll(back).unionAll(both).groupBy("_group", "_other").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = 3, top_terms: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: every other source of the language, by divergence from it. Part ``term``: the ``top_terms`` terms whose
    share in the source is furthest above the language's.
    """
    numbered = group_table(docs, text, lang, source)
    terms = kept_terms(docs, numbered, min_docs, text, lang, source)
    groups = profiles(terms, numbered)
    pairs = pair_values(terms, groups).join(groups.select(F.col("_group").alias("_other"), F.col("source").alias("item")), "_other").select("_group", F.lit("pair").alias("part"), "item", "value")
    judged = terms.join(groups.select("_group", "whole", "lang_whole", "kept"), "_group").select("_group", "term", _share("n", "whole", "kept").alias("p"), _share("total", "lang_whole", "kept").alias("q"))
    above = judged.where("p > q").select("_group", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
    order = Window.partitionBy("_group").orderBy(F.desc("value"), "item")
    top = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionAll(top)
    return ranked.join(groups.select("_group", "lang", "source"), "_group").select("lang", "source", "part", "item", "value", "rank")
