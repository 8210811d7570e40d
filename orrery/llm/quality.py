"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features are single tokens and pairs of neighbours (runs of letters or of punctuation), hashed to ``2 ** BITS`` slots
(pairs of equal tokens share one); their values are square roots of counts scaled to length 1. The model is fitted on the driver over at most
``train_rows`` labelled documents, always the same ones (smallest hash of the key); scoring is a sparse dot product in
the tasks and covers whole texts of all rows.

Null or empty texts have the intercept's score. A label table without usable rows gives the score 0.5 to every text.
Labels that are null are not used; of several labels for one document the lowest counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import sample_rows
from .textops import Runs, chunks, window_hashes

BITS = 18
_SAME = np.uint64(0x5EED << 44)


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, values and per-document bounds of a sparse row for each text."""
    runs = Runs(column)
    words = runs.hashes()
    pair, at = window_hashes(words, runs.first, 2)
    pair[words[at] == words[at + 1]] = _SAME
    doc = runs.doc()
    shift = np.uint64(64 - bits)
    key = np.concatenate([doc, doc[at]]) << bits | np.concatenate([words >> shift, pair >> shift]).astype(np.int64)
    key.sort()
    head = np.flatnonzero(np.diff(key, prepend=-1))
    count = np.diff(head, append=len(key))
    key = key[head]
    value = np.sqrt(count.astype(np.float64))
    first = np.searchsorted(key, np.arange(runs.docs + 1) << bits)
    length = np.zeros(len(key) + 1)
    np.cumsum(count, out=length[1:])
    norm = np.sqrt(np.maximum(length[first[1:]] - length[first[:-1]], 1))
    return key & ((1 << bits) - 1), value / np.repeat(norm, np.diff(first)), first


@dataclass
class Logistic:
    weight: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        slot, value, first = features(column)
        total = np.zeros(len(slot) + 1)
        np.cumsum(self.weight[slot] * value, out=total[1:])
        return 1 / (1 + np.exp(-np.clip(total[first[1:]] - total[first[:-1]] + self.intercept, -30, 30)))


def training_features(texts: list[str | None], group: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for a training sample, some texts at a time, so that the driver holds little beside the rows."""
    parts = [features(pa.array(texts[k : k + group], pa.string())) for k in range(0, len(texts), group)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64)
    size = np.concatenate([np.diff(first) for _, _, first in parts])
    return np.concatenate([s.astype(np.int32) for s, _, _ in parts]), np.concatenate([v.astype(np.float32) for _, v, _ in parts]), np.concatenate([[0], np.cumsum(size)])


def fit(texts: list[str | None], labels: list[int], epochs: int | None = None, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> Logistic:
    """Per-coordinate follow-the-regularised-leader over the rows in a fixed shuffled order.

    Without ``epochs``, small samples are passed over more often: about 20,000 steps, 2 to 20 epochs.
    """
    epochs = epochs or max(2, min(20, 20_000 // max(len(labels), 1)))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = bias = 0.0
    slot, value, first = training_features(texts)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    rng = np.random.default_rng(5)
    for _ in range(epochs if labels else 0):
        for row in rng.permutation(len(labels)):
            s, v = slot[first[row] : first[row + 1]], value[first[row] : first[row + 1]]
            w = weights(z[s], n[s])
            bias = -bias_z / (beta + np.sqrt(bias_n)) * alpha
            error = 1 / (1 + np.exp(-np.clip(w @ v + bias, -30, 30))) - labels[row]
            g = error * v
            z[s] += g - (np.sqrt(n[s] + g * g) - np.sqrt(n[s])) / alpha * w
            n[s] += g * g
            bias_z += error - (np.sqrt(bias_n + error * error) - np.sqrt(bias_n)) / alpha * bias
            bias_n += error * error
    return Logistic(weights(z, n), -bias_z / (beta + np.sqrt(bias_n)) * alpha)


def train(docs: DataFrame, labels: DataFrame, usable, train_rows: int = 5000, key: str = "doc_id", text: str = "text", label: str = "quality") -> Logistic:
    """Fit on at most ``train_rows`` labelled documents for which ``usable`` (a column of the labels) holds.

    The label sample is small by that bound, so it is broadcast to the one scan of the documents.
    """
    marked = labels.where(usable & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("_label"))
    chosen = F.broadcast(sample_rows(marked, key, train_rows))
    rows = docs.select(key, text).join(chosen, key).select(key, text, "_label").toArrow()
    rows = rows.take(np.argsort(rows.column(key).to_numpy(), kind="stable"))
    return fit(rows.column(text).to_pylist(), [int(v > 0) for v in rows.column("_label").to_pylist()])


def quality_scores(docs: DataFrame, model: Logistic, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), score: str = "score") -> DataFrame:
    """``key``, the columns ``keep`` and the score, named ``score``, for every row."""
    names = list(dict.fromkeys([key, *keep]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(model.score(part.column(text)))], [*names, score])

    source = docs.select(*dict.fromkeys([*names, text]))
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in names) + f", `{score}` double"
    return source.mapInArrow(run, schema)
