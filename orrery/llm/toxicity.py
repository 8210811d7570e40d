"""Toxicity: FTRL-proximal logistic regression on hashed word n-grams and skip-grams.

Words are runs of letters and digits (all non-ASCII among them), A-Z lower-cased. A text's features are its distinct
words, pairs of neighbours, and pairs with one or two words between them (skip-grams), hashed to ``2 ** BITS`` slots and
present or not. Every slot has its own learning rate, and L1 keeps the weight of most slots at exactly 0, so the model is
a short list of slots and weights: that list is what goes to the tasks.

The model is fitted on the driver over a bounded sample: at most ``train_rows`` labelled documents, up to half of them of
each label, one for each key (the text with the smallest hash), and ``train_bytes`` of their texts. It is the same on
every run (smallest hash of the key). Only slots of ``MIN_TEXTS`` sample texts can get a weight, and the rarer label
counts up to ``MOST_WEIGHT`` times. Scoring covers whole texts of all rows.

A null text, an empty one and one without words have the score of the intercept. A null key is a document like any other
but never trained on. Repeated rows are each scored. Of several labels for one key the lowest counts; null labels and
labels without a document are not used. Without usable rows every score is 0.5. An empty table gives no rows. Of the
input only the key and the text are read; other columns, also ones named like a result, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import Runs, chunks, mix64

BITS = 20
GAPS = (1, 2, 3)  # a pair of neighbours, and skip-grams over one and two words
TRAIN_ROWS = 4000
TRAIN_BYTES = 24 << 20
MIN_TEXTS = 3
MOST_WEIGHT = 4.0


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots of each text, and where each text's begin."""
    runs = Runs(column)
    upper = (runs.raw >= 65) & (runs.raw <= 90)
    runs.raw = runs.raw + upper.astype(np.uint8) * np.uint8(32)
    lead = runs.raw[runs.start] if len(runs.start) else np.zeros(0, np.uint8)
    wordy = (lead >= 128) | ((lead >= 97) & (lead <= 122)) | ((lead >= 48) & (lead <= 57))
    word, doc = runs.hashes()[wordy], runs.doc()[wordy]
    parts, owner = [word], [doc]
    for gap in GAPS:
        same = np.flatnonzero(doc[gap:] == doc[:-gap])
        parts.append(mix64(word[same] * np.uint64(2 * gap + 1) + (word[same + gap] ^ np.uint64(gap << 40))))
        owner.append(doc[same])
    slot = (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)
    key = np.concatenate(owner).astype(np.int64) << BITS | slot
    key.sort()
    key = key[np.flatnonzero(np.diff(key, prepend=-1))]
    return key & ((1 << BITS) - 1), np.searchsorted(key, np.arange(runs.docs + 1) << BITS)


@dataclass
class ToxicityModel:
    slots: np.ndarray  # ascending, those with a weight only
    weights: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        slot, first = features(column)
        at = np.minimum(np.searchsorted(self.slots, slot), max(len(self.slots) - 1, 0))
        value = np.where(self.slots[at] == slot, self.weights[at], 0.0) if len(self.slots) else np.zeros(len(slot))
        total = np.zeros(len(slot) + 1)
        np.cumsum(value, out=total[1:])
        return 1 / (1 + np.exp(-np.clip(total[first[1:]] - total[first[:-1]] + self.intercept, -30, 30)))


def fit(texts: list[str | None], labels: list[int], epochs: int = 8, alpha: float = 2.0, beta: float = 1.0, l1: float = 15.0, l2: float = 0.1) -> ToxicityModel:
    """FTRL-proximal with a rate for each slot, over the rows in a fixed shuffled order."""
    z, n, seen = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS, np.int32)

    def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    bags = [features(pa.array([text], pa.string()))[0].astype(np.int32) for text in texts]
    for bag in bags:
        seen[bag] += 1
    bags = [bag[seen[bag] >= MIN_TEXTS] for bag in bags]
    rare = 1 if 2 * sum(labels) <= len(labels) else 0
    rarer = min(MOST_WEIGHT, max(1.0, len(labels) / max(labels.count(rare), 1) - 1))
    bias, bias_n = 0.0, 0.0
    rng = np.random.default_rng(12)
    for _ in range(epochs if labels else 0):
        for row in rng.permutation(len(labels)):
            s = bags[row]
            w = weight(z[s], n[s])
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30))) - labels[row]
            g *= rarer if labels[row] == rare else 1.0
            z[s] += g - (np.sqrt(n[s] + g * g) - np.sqrt(n[s])) / alpha * w
            n[s] += g * g
            bias_n += g * g
            bias -= alpha / (beta + np.sqrt(bias_n)) * g  # the intercept is not pulled to 0
    final = weight(z, n)
    slots = np.flatnonzero(final)
    return ToxicityModel(slots, final[slots], float(bias))


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, rows: int, size: int, key: str, text: str, label: str) -> tuple[list[str], list[int]]:
    """Texts and labels of the sample; keys and sizes of at most ``rows`` documents are looked at before texts are read."""
    marked = labels.where(usable & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    hashed = texts.select("_key", F.struct(F.xxhash64("_text").alias("h"), F.octet_length("_text").alias("size")).alias("_t"))
    one = hashed.join(marked, "_key").groupBy("_key").agg(F.min("_t").alias("_t"), (F.first("_label") > 0).cast("int").alias("_label"))
    one = one.withColumn("_draw", F.xxhash64(F.lit(19), "_key"))
    half = [one.where(F.col("_label") == value).orderBy("_draw", "_key").limit(rows // 2) for value in (0, 1)]
    drawn = half[0].unionAll(half[1]).select("_key", "_t.h", "_t.size", "_label", "_draw").collect()
    chosen, held = [], 0
    for r in sorted(drawn, key=lambda r: (r["_draw"], r["_key"])):
        held += r["size"]
        if held > size:
            break
        chosen.append((r["_key"], r["h"], r["_label"]))
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    wanted = spark.createDataFrame(chosen, f"_key {kind}, _h long, _label int")
    read = texts.join(F.broadcast(wanted), "_key").where(F.xxhash64("_text") == F.col("_h"))  # at most ``rows`` rows
    read = read.groupBy("_key").agg(F.min("_text").alias("_text"), F.first("_label").alias("_label")).orderBy("_key").toArrow()
    return read.column("_text").to_pylist(), read.column("_label").to_pylist()


def train(docs: DataFrame, labels: DataFrame, usable: Column, train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fit on labelled documents for which ``usable`` (a column of the labels) holds."""
    return fit(*training_rows(docs, labels, usable, train_rows, train_bytes, key, text, label))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` (0 to 1, higher: more likely toxic) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                yield pa.RecordBatch.from_arrays([part.column("_key"), pa.array(model.score(part.column("_text")))], [key, "score"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")
