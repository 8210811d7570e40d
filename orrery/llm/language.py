"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its byte 3- and 4-grams; a softmax layer on the mean gives the language. Both
are trained by stochastic gradient descent in numpy on at most ``train_rows`` documents of known language, always the
same ones. As mean and layer are linear, tasks look n-grams up in their product (one row of logits per slot).

Probabilities are calibrated by a temperature, and ``reject_below`` is the confidence under which a prediction should be
rejected; both come from training rows set aside. Null texts and texts without a letter are ``und`` with score 0; so are
all texts if no row has a known language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import sample_rows
from .textops import _BLANK, _LOWER, chunks, mix64, sums_per_doc, text_buffers

BITS = 15
DIM = 12
UNKNOWN = "und"

_FOLD = np.where(_BLANK, 32, _LOWER).astype(np.uint64)
for _c in (*range(33, 48), *range(48, 58), *range(58, 65), *range(91, 97), *range(123, 127)):
    _FOLD[_c] = 32  # digits and punctuation say little about a language


def subwords(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all byte 3- and 4-grams (blanks, digits and punctuation alike) and their bounds per text."""
    raw, at = text_buffers(column)
    byte = _FOLD[raw]
    n = len(byte)
    if n < 4:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    three = byte[: n - 3] | byte[1 : n - 2] << np.uint64(8) | byte[2 : n - 1] << np.uint64(16)
    shift = np.uint64(64 - BITS)
    factor = np.uint64(0x9E3779B97F4A7C15)
    slots = np.empty((n - 3, 2), np.int64)
    slots[:, 0] = (three + np.uint64(1 << 40)) * factor >> shift
    slots[:, 1] = (three | byte[3:] << np.uint64(24)) * factor >> shift
    # grams that would cross into the next text are left out
    keep = np.ones(n - 3, bool)
    for back in (1, 2, 3):
        cut = at[1:-1] - back
        keep[cut[(cut >= 0) & (cut < n - 3)]] = False
    where = np.flatnonzero(keep)
    first = np.searchsorted(where, at)
    first[-1] = len(where)
    return slots[where].ravel(), first * 2


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # a row per slot
    bias: np.ndarray
    temperature: float
    reject_below: float

    def raw(self, column: pa.Array) -> np.ndarray:
        slots, first = subwords(column)
        if not len(slots):
            return np.tile(self.bias, (len(first) - 1, 1))
        mean = np.stack([sums_per_doc(self.logits[:, k][slots], first) for k in range(len(self.languages))], 1)
        return mean / np.maximum(np.diff(first), 1)[:, None] + self.bias

    def probabilities(self, column: pa.Array) -> np.ndarray:
        return softmax(self.raw(column) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(texts: list[str], langs: list[str], epochs: int = 6, rate: float = 0.5, clean_loss: float = 0.01) -> LanguageModel:
    """Train on four fifths of the rows; the rest calibrates the temperature and the rejection bound.

    ``reject_below`` is the ``clean_loss`` quantile of the confidence in right predictions of the calibration rows.
    """
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], np.zeros((1, 0)), np.zeros(0), 1.0, 0.0)
    target = np.array([names.index(v) for v in langs])
    rng = np.random.default_rng(11)
    order = rng.permutation(len(texts))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    bags = []
    for text in texts:
        slots, _ = subwords(pa.array([text], pa.string()))
        slot, count = np.unique(slots, return_counts=True)
        bags.append((slot.astype(np.int32), count.astype(np.int32)))
    embed = rng.normal(0, 0.1, (1 << BITS, DIM))
    layer, bias = rng.normal(0, 0.1, (DIM, len(names))), np.zeros(len(names))
    steps, step = epochs * len(used), 0
    for _ in range(epochs):
        for r in rng.permutation(used):
            slot, count = bags[r]
            share = count / max(count.sum(), 1)
            lr = rate * (1 - step / steps) + 0.01
            mean = share @ embed[slot]
            error = softmax(mean @ layer + bias)
            error[target[r]] -= 1
            back = layer @ error
            layer -= lr * np.outer(mean, error)
            bias -= lr * 0.1 * error
            embed[slot] -= lr * 50 * np.outer(share, back)  # a mean spreads its gradient thin
            step += 1
    model = LanguageModel(names, (embed @ layer).astype(np.float64), bias, 1.0, 0.0)
    if len(held):
        raw = np.concatenate([model.raw(pa.array([texts[r]], pa.string())) for r in held])
        loss = {t: -np.log(softmax(raw / t)[np.arange(len(held)), target[held]] + 1e-12).mean() for t in np.geomspace(0.2, 5, 33)}
        model.temperature = float(min(loss, key=loss.get))
        p = softmax(raw / model.temperature)
        right = p.max(1)[p.argmax(1) == target[held]]
        model.reject_below = float(np.quantile(right, clean_loss)) if len(right) else 0.0
    return model


def train(docs: DataFrame, usable: Column, train_rows: int = 3000, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fit on at most ``train_rows`` documents of known language for which ``usable`` holds."""
    known = docs.where(usable & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(key, lang)
    chosen = F.broadcast(sample_rows(known, key, train_rows).groupBy(key).agg(F.min(lang).alias("_lang")))
    rows = docs.select(key, text).join(chosen, key).where(F.col(text).isNotNull()).toArrow()
    rows = rows.take(np.argsort(rows.column(key).to_numpy(), kind="stable"))
    return fit(rows.column(text).to_pylist(), rows.column("_lang").to_pylist())


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` (calibrated) and ``rejected`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                usable = part.column("_usable").to_numpy(zero_copy_only=False)
                if model.languages:
                    p = model.probabilities(part.column(text))
                    best = p.argmax(1)
                    score = np.where(usable, p[np.arange(len(p)), best], 0.0)
                    lang = [model.languages[b] if u else UNKNOWN for b, u in zip(best, usable)]
                else:
                    score, lang = np.zeros(part.num_rows), [UNKNOWN] * part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(lang, pa.string()), pa.array(score), pa.array(score < model.reject_below)], [key, "lang_pred", "score", "rejected"])

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_usable")
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text, letter).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, rejected boolean")
