"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that ends its encoding. The tokens that end at a position come
from an automaton with suffix links over the vocabulary; a token is the right one if the token before it (already
stored for the shorter prefix) and it stay apart under the merge rules. Back-pointers from the end of the word give the
ids. The words of a batch are sorted, so a prefix that neighbours share is worked out once.

Null and empty texts have no tokens. Special tokens written out in a text become their ids, as in the library. Texts of
any length are encoded whole; the caches of pieces between white space and of pairs of tokens are bounded.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .textops import release

CACHE_PIECES = 150_000
CACHE_PAIRS = 250_000
GROUP = 512  # documents encoded together
# The same where a worker has to stay small: about half the memory beside the vocabulary, half as much time again.
SMALL_PIECES = 40_000
SMALL_PAIRS = 60_000
SMALL_GROUP = 128

_WHITE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# The word pattern of the vocabulary file's pre-tokenizer.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _WHITE + r"\p{L}\p{N}]+")
_BLANKS = regex.compile("[" + _WHITE + "]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SUFFIX = "</w>"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else from 256 up."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A vocabulary with word ends. Symbols are bytes; the last byte of a word is raised by 256."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.specials = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.letter = letters
        symbols: dict[int, tuple[int, ...]] = {}
        for b, letter in enumerate(letters):
            symbols[vocab[letter]] = (b,)
            symbols[vocab[letter + _SUFFIX]] = (b + 256,)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = dict.fromkeys(symbols, -1)
        for rank, (left, right) in enumerate(merges):
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = rank
            if made not in symbols:
                self.parts[made], symbols[made], self.born[made] = (a, b), symbols[a] + symbols[b], rank
            if rank < max(self.born[a], self.born[b]):
                raise ValueError("a merge comes before the merges it builds on")
        self._apart: dict[tuple[int, int], bool] = {}
        whole: dict[int, bool] = dict.fromkeys(symbols, True)
        for t, (a, b) in self.parts.items():  # a token that its own text does not encode to is never used
            whole[t] = whole[a] and whole[b] and self._stay_apart(a, b, self.born[t])
        self._build({t: s for t, s in symbols.items() if whole[t]})
        self.text = {i: str(i) for i in self.token}
        self.cache: dict[str, tuple[str, str]] = {}
        self.most_pieces, self.most_pairs = CACHE_PIECES, CACHE_PAIRS

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens on the right (1) or left (0) edge of a token as it grows, each with the rank at which it is absorbed.

        Worked out for each new pair of tokens: lists of all of them take more memory than the rest of the vocabulary.
        """
        out, absorbed, parts = [(token, 1 << 60)], 0, self.parts
        while token in parts:
            absorbed, token = self.born[token], parts[token][side]
            out.append((token, absorbed))
        return out

    def _stay_apart(self, a: int, b: int, before: int = 1 << 60) -> bool:
        """No merge of rank under ``before`` ever joins the texts of ``a`` and ``b`` at their border.

        Of equal ranks the merge further left goes first, so one inside ``a`` beats the border and the border beats one
        inside ``b``.
        """
        left, ranks = self._edge(b, 0), self.rank
        for x, x_gone in self._edge(a, 1):
            for y, y_gone in left:
                rank = ranks.get((x, y))
                if rank is not None and rank < before and rank < x_gone and rank <= y_gone:
                    return False
        return True

    def _build(self, symbols: dict[int, tuple[int, ...]]) -> None:
        """The automaton: trie edges, suffix links, and per state the tokens that end there, longest first."""
        self.go: list[dict[int, int]] = [{}]
        ends: list[tuple[int, int] | None] = [None]
        for t, word in symbols.items():
            state = 0
            for s in word:
                to = self.go[state].get(s)
                if to is None:
                    to = self.go[state][s] = len(self.go)
                    self.go.append({})
                    ends.append(None)
                state = to
            ends[state] = (t, len(word))
        self.link = [0] * len(self.go)
        self.found: list[tuple[tuple[int, int], ...]] = [()] * len(self.go)
        level = [0]
        while level:
            below = []
            for state in level:
                for s, to in self.go[state].items():
                    if state:
                        back = self.link[state]
                        while back and s not in self.go[back]:
                            back = self.link[back]
                        self.link[to] = self.go[back].get(s, 0)
                    self.found[to] = ((ends[to],) if ends[to] else ()) + self.found[self.link[to]]
                    below.append(to)
            level = below

    def _step(self, state: int, s: int) -> int:
        """The state after symbol ``s``; worked out by suffix links once, then stored among the edges of the trie.

        A stored edge is right for every state that reaches it by suffix links, like an edge of the trie.
        """
        at, go = state, self.go
        while at and s not in go[at]:
            at = self.link[at]
        to = go[state][s] = go[at].get(s, 0)
        return to

    def _fits(self, before: int, token: int) -> bool:
        if len(self._apart) > self.most_pairs:
            self._apart.clear()
        ok = self._apart[before, token] = self._stay_apart(before, token)
        return ok

    def encode_words(self, words: list[bytes]) -> Iterator[list[int]]:
        """Ids of each of the sorted, distinct words."""
        go, found, apart, fits = self.go, self.found, self._apart, self._fits
        states, last, length = [0], [-1], [0]  # per prefix of the word before
        previous = b""
        for word in words:
            body = len(word) - 1
            at, most = 0, min(len(states) - 1, body)
            while at < most and previous[at] == word[at]:
                at += 1
            del states[at + 1 :], last[at + 1 :], length[at + 1 :]
            state = states[at]
            while at <= body:
                s = word[at] if at < body else word[at] + 256
                to = go[state].get(s)
                state = self._step(state, s) if to is None else to
                at += 1
                for t, n in found[state]:
                    if n == at:
                        break
                    before = last[at - n]
                    ok = apart.get((before, t))
                    if fits(before, t) if ok is None else ok:
                        break
                if at > body:
                    break
                states.append(state)
                last.append(t)
                length.append(n)
            ids, at = [t], body + 1 - n
            while at:
                ids.append(last[at])
                at -= length[at]
            ids.reverse()
            yield ids
            previous = word

    def words(self, piece: str) -> list[str]:
        """Words and special tokens of a text without white space, in order."""
        if self.specials is None or "<|" not in piece:
            return _WORD.findall(_normal(piece))
        out: list[str] = []
        for k, part in enumerate(self.specials.split(piece)):
            out += [part] if k % 2 else _WORD.findall(_normal(part))
        return out

    def forget(self) -> None:
        self.cache, self._apart = {}, {}

    def lookup(self, pieces: set[str]) -> tuple[dict[str, str], dict[str, str]]:
        """Ids and tokens of each piece as text; new ones are encoded together and cached."""
        ids_of, tokens_of = {}, {}
        new = []
        for p in pieces:
            found = self.cache.get(p)
            if found is None:
                new.append(p)
            else:
                ids_of[p], tokens_of[p] = found
        split = {p: self.words(p) for p in new}
        words = {w for ws in split.values() for w in ws}
        words.difference_update(self.special)
        order = sorted([w.encode() for w in words])
        text, name = self.text, self.token
        known = {t: (text[i], t) for t, i in self.special.items()}
        for word, ids in zip(order, self.encode_words(order)):
            known[word.decode()] = (text[ids[0]], name[ids[0]]) if len(ids) == 1 else (" ".join([text[i] for i in ids]), " ".join([name[i] for i in ids]))
        if len(self.cache) + len(new) > self.most_pieces:  # what this batch uses stays
            self.cache = {p: (ids, tokens_of[p]) for p, ids in ids_of.items()}
        for p, ws in split.items():
            found = known[ws[0]] if len(ws) == 1 else (" ".join([known[w][0] for w in ws]), " ".join([known[w][1] for w in ws]))
            self.cache[p] = found
            ids_of[p], tokens_of[p] = found
        return ids_of, tokens_of

    def split(self, text: str) -> list[str]:
        """Pieces between white space. No word, special token or composition reaches across white space."""
        if _SEPARATORS.search(text):  # Python splits at these control characters, the vocabulary doesn't
            return [p for p in _BLANKS.split(text) if p]
        return text.split()

    def encode(self, text: str) -> list[int]:
        pieces = self.split(text)
        ids_of, _ = self.lookup(set(pieces))
        return [int(i) for p in pieces for i in ids_of[p].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens joined by a space."""
        return " ".join([self.token[i] for i in ids if i in self.token])


def _normal(text: str) -> str:
    """Canonical composition and lower case, letter by letter (no final sigma)."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower() if "Σ" in text else text.lower()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """One per Python worker; later tasks in that worker reuse it."""
    return WordBpe(path)


def encode_batch(bpe: WordBpe, texts: list[str | None], group: int = GROUP) -> Iterator[tuple[str, str, int]]:
    """Ids as text, decoded text and number of tokens of each text, some documents at a time."""
    for k in range(0, len(texts), group):
        split = [bpe.split(t) if t else [] for t in texts[k : k + group]]
        ids_of, tokens_of = bpe.lookup(set().union(*split))
        for pieces in split:
            ids = " ".join(map(ids_of.__getitem__, pieces))
            yield ids, " ".join(map(tokens_of.__getitem__, pieces)), ids.count(" ") + 1 if ids else 0


def bpe_encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", digest: bool = False, keep_pieces: bool = True) -> DataFrame:
    """Token ids and decoded text of each document, or with ``digest`` their SHA-256 only.

    Returns ``key``, ``n_tokens`` and ``ids``, ``decoded`` (or ``ids_sha256``, ``decoded_sha256``); one row for each
    input row, repeated rows included. Other columns are not read. Without ``keep_pieces`` a task caches less, encodes
    fewer documents together and gives its caches up at its end: slower, but the workers are smaller.
    """

    group = GROUP if keep_pieces else SMALL_GROUP
    names = ["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        gc.freeze()  # the vocabulary's many small objects are not searched again and again
        gc.set_threshold(200_000, 20, 100)
        bpe.most_pieces, bpe.most_pairs = (CACHE_PIECES, CACHE_PAIRS) if keep_pieces else (SMALL_PIECES, SMALL_PAIRS)
        if not keep_pieces:
            release()  # of the stages before, and of building the vocabulary
        try:
            yield from encoded(bpe, batches)
        finally:
            if not keep_pieces:
                bpe.forget()
                release()

    def encoded(bpe: WordBpe, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, group):
                part = batch.slice(low, group)
                ids, decoded, count = map(list, zip(*encode_batch(bpe, part.column(text).to_pylist(), group)))
                if digest:
                    ids = pa.array([hashlib.sha256(a.encode()).hexdigest() for a in ids], pa.string())
                    decoded = [hashlib.sha256(b.encode()).hexdigest() for b in decoded]
                else:
                    flat = np.concatenate([np.fromstring(a, np.int32, sep=" ") for a in ids])
                    ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(count, pa.int64()), ids, pa.array(decoded, pa.string())], [key, "n_tokens", *names])

    kind = docs.schema[key].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, {rest}")
