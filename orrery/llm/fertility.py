"""Quality rules from tokeniser fertility, beside plain repetition rules.

A public vocabulary with byte fallback encodes every word of a text. Characters per token, the share of byte-fallback
tokens and the entropy of the tokens tell prose from noise: random strings break into short tokens, foreign symbols
into bytes, and boilerplate repeats a few tokens. A text is rejected if a measure leaves the band of its script: the fixed
one in ``BANDS``, or the corpus's own (``fences``), which lies around the quartiles of all texts of the script that pass the
base rules. Quartiles come from exact counts in small steps, so they depend on no order and the driver sees counts only.

Words are runs without ASCII white space, texts are whole. Null and empty texts have zero counts and fail the base rule
(fewer than ten words). Rows of one key, and null keys, are judged as texts of their own; an empty table has no bands and no
rows. The vocabulary file is a parameter; each worker loads it once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.session import materialize

from .textops import Words, chunks, mix64, window_hashes

PART_BYTES = 4 << 20

#: Per script: least and most characters per token, most byte-fallback share, least entropy in bits of texts with at
#: least ``ENTROPY_TOKENS`` tokens.
BANDS = {
    "latin": (1.3, 8.0, 0.10, 3.0),
    "greek": (0.8, 6.0, 0.30, 3.0),
    "cyrillic": (1.0, 7.0, 0.20, 3.0),
    "cjk": (0.25, 3.0, 0.75, 3.0),
    "other": (0.2, 6.0, 0.90, 3.0),
    "none": (1.4, 6.0, 0.60, 3.0),  # no letters: bare digits have 0.9 characters a token, bare symbols 1.2
}
SCRIPTS = tuple(BANDS)
ENTROPY_TOKENS = 100

#: Steps in which the corpus's measures are counted, the last one open: characters per token, byte share, entropy.
STEPS = {"chars_per_token": (0.005, 20.0), "byte_share": (0.005, 1.0), "token_entropy": (0.02, 20.0)}
#: A fence is this many quartile distances beyond the quartiles for many texts; few texts tell less and widen it.
REACH, REACH_FEW = 3.0, 30.0
#: Short texts scatter more: a fence moves out by 1 + this / sqrt(tokens) for each text.
REACH_SHORT = 10.0
#: A quartile distance counts as at least this part of the median, and at least as this much.
SPREAD, LEAST_SPREAD = 0.05, {"chars_per_token": 0.05, "byte_share": 0.01, "token_entropy": 0.2}

#: Script of a letter by its first byte in UTF-8; 255: none.
_SCRIPT = np.full(256, 255, np.uint8)
_SCRIPT[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 0
_SCRIPT[0xCD:0xD0] = 1
_SCRIPT[0xD0:0xD4] = 2
_SCRIPT[0xE3:0xEE] = 3
_SCRIPT[[*range(0xD4, 0xE0), 0xE0, 0xE1]] = 4
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "kept": "boolean", "script": "string", "n_tokens": "long", "chars_per_token": "double",
    "byte_share": "double", "token_entropy": "double",
}


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def _upto(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[at])


def duplicate_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return len(lines) - len(set(lines))


def repeated_words(hashes: np.ndarray, words: Words, width: int = 5) -> np.ndarray:
    """Per document, the words covered by a ``width``-word window that it holds twice or more."""
    window, at = window_hashes(hashes, words.first, width)
    doc = words.doc()
    own = mix64(window + doc[at].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    order = np.sort(own)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    cover = np.zeros(len(hashes) + 1, np.int64)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
        hit = at[twice[place] == own]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + width, -1)
    return _upto(np.cumsum(cover[:-1]) > 0, words.first)


def token_measures(hashes: np.ndarray, words: Words, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: tokens, byte-fallback tokens, entropy of the tokens in bits. Each distinct word is encoded once."""
    model, is_byte = _pieces(path)
    _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
    raw = words.raw.tobytes()
    start, end = words.start[example].tolist(), words.end[example].tolist()
    ids = model.encode([raw[a:b].decode() for a, b in zip(start, end)], num_threads=1)
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum()))
    begin = np.cumsum(size) - size
    count = size[which]
    tokens = _sum(count, words.first)
    byte = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(is_byte[flat], out=byte[1:])
    bytes_of = byte[begin + size] - byte[begin]
    fallback = _sum(bytes_of[which], words.first)
    place = np.repeat(begin[which] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    key = np.repeat(np.arange(words.docs), tokens) << 20 | flat[place]
    key.sort()
    head = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(head, append=len(key)).astype(np.float64)
    doc = key[head] >> 20
    log = np.bincount(doc, times * np.log2(times), words.docs)
    n = np.maximum(tokens, 1)
    return tokens, fallback, np.where(tokens > 0, np.log2(n) - log / n, 0.0)


def _sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[first])


def scripts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The script with the most letters, or none."""
    kind = _SCRIPT[raw]
    letters = np.stack([_upto(kind == k, at) for k in range(len(SCRIPTS) - 1)], 1)
    return np.where(letters.sum(1) > 0, letters.argmax(1), len(SCRIPTS) - 1)


def measure(column: pa.Array, path: str, bands: dict[str, tuple[float, float, float, float]]) -> dict[str, np.ndarray]:
    words = Words(column)
    hashes = words.hashes()
    raw, at = words.raw, words.at
    n = words.counts()
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[words.start] = 1
    inside[words.end] -= 1
    chars = _upto((np.cumsum(inside[:-1]) > 0) & ((raw & 0xC0) != 0x80), at)
    repeats = repeated_words(hashes, words)
    failed = (n < 10) | (100 * repeats > 20 * n)
    tokens, fallback, entropy = token_measures(hashes, words, path)
    script = scripts(raw, at)
    per_token, share = chars / np.maximum(tokens, 1), fallback / np.maximum(tokens, 1)
    low, high, most_bytes, least_bits = np.array([bands[s] for s in SCRIPTS]).T[:, script]
    fine = (per_token >= low) & (per_token <= high) & (share <= most_bytes) & ((entropy >= least_bits) | (tokens < ENTROPY_TOKENS))
    return {
        "n_words": n, "word_chars": chars, "n_symbols": _upto(_SYMBOL[raw], at), "n_dup_lines": np.array([duplicate_lines(t) for t in column.to_pylist()], np.int64),
        "n_repeat_words": repeats, "base_failed": failed, "kept": ~failed & fine, "script": np.array(SCRIPTS, object)[script], "n_tokens": tokens,
        "chars_per_token": per_token, "byte_share": share, "token_entropy": entropy,
    }


def fences(measured: DataFrame) -> dict[str, dict[str, tuple[float, float, float]]]:
    """Per script and measure, the first and third quartile and how far beyond them a long text is still usual in this corpus.

    One small aggregate over all measured texts that pass the base rules: counts by script and step, at most
    some thousand rows.
    """
    steps = [F.struct(F.lit(c).alias("measure"), F.floor(F.least(F.col(c), F.lit(top)) / width).alias("step")) for c, (width, top) in STEPS.items()]
    usual = measured.where("not base_failed").select("script", "n_tokens", F.explode(F.array(*steps)).alias("_m")).select("script", "n_tokens", "_m.*")
    usual = usual.where((F.col("measure") != "token_entropy") | (F.col("n_tokens") >= ENTROPY_TOKENS))
    counts: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for r in usual.groupBy("script", "measure", "step").count().collect():
        counts.setdefault((r["script"], r["measure"]), []).append((r["step"], r["count"]))
    out: dict[str, dict[str, tuple[float, float, float]]] = {}
    for (script, name), rows in counts.items():
        step, n = np.array(sorted(rows)).T
        total = np.cumsum(n)
        first, middle, third = ((step[np.searchsorted(total, q * total[-1])] + 0.5) * STEPS[name][0] for q in (0.25, 0.5, 0.75))
        reach = (REACH + REACH_FEW / np.sqrt(total[-1])) * max(third - first, SPREAD * middle, LEAST_SPREAD[name])
        out.setdefault(script, {})[name] = (float(first), float(third), float(reach))
    return out


def fertility_rules(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", bands: dict[str, tuple[float, float, float, float]] = BANDS) -> DataFrame:
    """``key`` and the measures and verdicts in ``COLUMNS`` for every row.

    The measures are stored once; the corpus's own bands are counted from them and then applied to them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text, PART_BYTES):
                found = measure(part.column(text), path, bands)
                yield pa.RecordBatch.from_arrays([part.column(key), *(pa.array(found[c]) for c in COLUMNS)], [key, *COLUMNS])

    kind = docs.schema[key].dataType.simpleString()
    measured = docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))
    measured = materialize(measured, "fertility")
    unusual, further = F.lit(False), 1 + REACH_SHORT / F.sqrt(F.greatest("n_tokens", F.lit(1)))
    for script, found in sorted(fences(measured).items()):
        out = F.lit(False)
        for name, (first, third, reach) in sorted(found.items()):
            low, high = first - reach * further, third + reach * further
            if name == "chars_per_token":
                out = out | ~F.col(name).between(low, high)
            elif name == "byte_share":
                out = out | (F.col(name) > high)
            else:
                out = out | ((F.col(name) < low) & (F.col("n_tokens") >= ENTROPY_TOKENS))
        unusual = unusual | ((F.col("script") == script) & out)
    return measured.withColumn("kept", F.col("kept") & ~unusual)
