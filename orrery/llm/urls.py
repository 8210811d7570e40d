"""URL filters: host and path rules, and a ratio of character language models for the rest.

Pages that a rule judges train two smoothed variable-order Markov models, one of accepted and one of rejected URLs. The
counts of all n-grams are a Spark table under the whole n-gram, summed over all such pages: it grows with the input, and no
task or driver holds it. Cells of URLs get from it the counts of the n-grams they hold. A URL without a rule is accepted if the mean log-likelihood ratio per character reaches a threshold, chosen on
judged pages that are kept out of the counts.

A null URL, or one without ``://``, has an empty host and path, so no rule fits; a null or empty URL scores 0. Without
pages judged either way all scores are 0 and the threshold is 0: everything else is accepted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import materialize
from .tables import fold
from .textops import chunks, mix64, text_buffers

ORDERS = 6  # contexts of 0 to 5 characters
CELL_BITS = 12  # of the number of rows in a cell
URL_BYTES = 256 << 10  # of URLs whose n-grams are looked at together
STRENGTH = 4.0  # weight of the shorter context's estimate, in characters

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, _UPPER, _LOWER), path


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule ``host/path`` whose host is the URL's or a parent of it and whose path starts the URL's path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every character (and the end) of every URL: 64-bit hashes, an order each, of its context and of context and
    character."""
    raw, at = text_buffers(column)
    size = np.diff(at)
    lead = ORDERS - 1
    begin = at[:-1] + np.arange(len(size)) * (lead + 1)  # each URL after some zeros, with one zero as its end
    data = np.zeros(len(raw) + len(size) * (lead + 1) + lead, np.uint64)
    where = np.arange(len(raw)) + np.repeat(begin + lead - at[:-1], size)
    data[where] = raw
    first = np.concatenate([[0], np.cumsum(size + 1)])
    here = np.arange(first[-1]) + np.repeat(begin + lead - first[:-1], size + 1)
    before = np.zeros(len(here), np.uint64)  # the context's characters, a byte each
    contexts, grams = [], []
    for order in range(ORDERS):
        if order:
            before = before | data[here - order] << np.uint64(8 * (order - 1))
        # up to five bytes of context, the order, and the character or none: different n-grams are different numbers
        context = before << np.uint64(16) | np.uint64(order << 9)
        contexts.append(mix64(context))
        grams.append(mix64(context | data[here] + np.uint64(1)))
    return np.stack(contexts), np.stack(grams), first


def ngram_counts(pages: DataFrame, label: str, url: str = "url") -> DataFrame:
    """``gram`` and its counts ``bad`` and ``good`` (``label`` 0 and 1) over all rows, added up per chunk before the
    shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, url, URL_BYTES):
                good = part.column(label).to_numpy(zero_copy_only=False)
                for value in (0, 1):
                    rows = part.column(url).filter(pa.array(good == value))
                    if len(rows):
                        context, gram, _ = ngrams(rows)
                        key, n = np.unique(np.concatenate([context.ravel(), gram.ravel()]), return_counts=True)
                        none = np.zeros(len(n), np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(none if value else n), pa.array(n if value else none)], ["gram", "bad", "good"])

    rows = pages.select(F.col(label).cast("int").alias(label), url).mapInArrow(run, "gram long, bad long, good long")
    return rows.groupBy("gram").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def likelihood(context: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Log-probability of each character from the counts, an order each, of its contexts and n-grams."""
    p = np.full(context.shape[1], 1 / 256)
    for order in range(ORDERS):
        p = (gram[order] + STRENGTH * p) / (context[order] + STRENGTH)
    return np.log(p)


def _cells_ngrams(cells: DataFrame) -> DataFrame:
    """The distinct n-grams of each cell of URLs, or of each chunk of a large one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("_cell").to_numpy()
            edges = np.flatnonzero(np.diff(cell, prepend=-1)).tolist() + [len(cell)]
            for a, b in zip(edges, edges[1:]):
                for part in chunks(batch.slice(a, b - a), "_url", URL_BYTES):
                    context, gram, _ = ngrams(part.column("_url"))
                    key = np.unique(np.concatenate([context.ravel(), gram.ravel()]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), cell[a])), pa.array(key.view(np.int64))], ["_cell", "gram"])

    return cells.select("_cell", "_url").mapInArrow(run, "_cell long, gram long")


def score_urls(pages: DataFrame, counts: DataFrame, url: str = "url") -> DataFrame:
    """The columns of ``pages`` and ``url_score``: the mean log ratio per character; positive: more like the accepted
    ones. Cells of consecutive rows ask the table of counts for the n-grams they hold."""
    held = pages.withColumns({"_url": F.coalesce(url, F.lit("")), "_cell": F.shiftright(F.monotonically_increasing_id(), CELL_BITS)})
    held = materialize(held, "url-cells")
    told = _cells_ngrams(held).join(counts, "gram").select("_cell", "gram", "bad", "good")

    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        known = told["gram"].to_numpy().view(np.uint64)
        order = np.argsort(known)
        known = known[order]
        n = [np.append(told[c].to_numpy()[order], 0) for c in ("bad", "good")]  # the last: an n-gram that is not known
        out = []
        for batch in rows.combine_chunks().to_batches():
            for part in chunks(batch, "_url", URL_BYTES):
                context, gram, first = ngrams(part.column("_url"))
                at = []
                for key in (context, gram):
                    where = np.searchsorted(known, key)
                    if len(known):
                        where[known[np.minimum(where, len(known) - 1)] != key] = len(known)
                    at.append(where)
                ratio = likelihood(n[1][at[0]], n[1][at[1]]) - likelihood(n[0][at[0]], n[0][at[1]])
                size = np.diff(first)
                out.append(np.where(size > 1, np.add.reduceat(ratio, first[:-1]) / size, 0.0))
        score = np.concatenate(out) if out else np.zeros(0)
        return rows.drop_columns(["_url", "_cell"]).append_column("url_score", pa.array(score, pa.float64()))

    schema = StructType([*pages.schema.fields, StructField("url_score", DoubleType())])
    return held.groupBy("_cell").cogroup(told.groupBy("_cell")).applyInArrow(run, schema)


def threshold(scored: DataFrame, label: str) -> float:
    """The score with the fewest errors of both kinds among rows with ``label`` 1: accepted, 0: rejected."""
    grid = scored.groupBy(label, F.least(F.greatest(F.floor(F.col("url_score") * 50), F.lit(-500)), F.lit(500)).alias("cell")).count().collect()
    good, bad = np.zeros(1002), np.zeros(1002)
    for row in grid:
        (good if row[label] else bad)[row["cell"] + 500] += row["count"]
    if not (good.sum() and bad.sum()):
        return 0.0
    loss = (np.cumsum(good) - good) / good.sum() + (bad.sum() - np.cumsum(bad) + bad) / bad.sum()
    best = np.flatnonzero(loss == loss.min())
    return (int(best[len(best) // 2]) - 500) / 50


def url_verdicts(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` and ``url_score`` for every page.

    ``rules`` maps ``host/path`` to ``allow`` or ``block``.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(key, url, host.alias("host"), path.alias("path"))
    ruled = parts.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    says = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        says = F.when(F.col("rule") == rule, verdict).otherwise(says)
    ruled = ruled.withColumn("_says", says)
    ruled = ruled.withColumns({"_good": (F.col("_says") == "allow").cast("int"), "_held": fold(key, 5) == 0})
    counts = materialize(ngram_counts(ruled.where("_good is not null and not _held"), "_good", url), "url-ngrams")
    both = counts.agg(F.max("bad").alias("bad"), F.max("good").alias("good")).first()
    if not (both["bad"] and both["good"]):
        counts = counts.limit(0)
    scored = materialize(score_urls(ruled, counts, url), "url-scores")
    least = threshold(scored.where("_good is not null and _held"), "_good") if both["bad"] and both["good"] else 0.0
    verdict = F.coalesce("_says", F.when(F.col("url_score") >= least, "allow").otherwise("block"))
    return scored.select(key, "host", "path", "rule", verdict.alias("verdict"), "url_score")
