"""Personal data: plain patterns, and a character BiLSTM with CRF transitions for what they miss.

The patterns find e-mail addresses, IP addresses, card and telephone numbers. The network adds other spellings of the same
(``john [at] mail dot com``, ``030 1234 5678``, cards with dots, IPv6) and two kinds without a pattern: bank accounts and
secrets such as tokens and passwords. It is trained in numpy on labelled spans: made-up ones in many spellings, set into
text of at most ``train_docs`` documents and ``train_bytes`` (always the same ones) and labelled by where they were put,
look-alikes labelled as nothing (dates, versions, numbers that fail their check digits), and windows of the documents.

It reads overlapping windows; the scores of a character from all its windows are averaged by their distance from the
window's edge, and one Viterbi pass per stretch of text settles the tags, so spans don't depend on where windows are cut.
Stretches surround every digit, ``@``, written-out ``at`` or ``dot`` in brackets, the word ``dot`` and names of secrets followed
by ``=`` or ``:``, by ``REACH`` characters and then to the end of the word, in the whole text. A span of the network stays if it
overlaps no pattern's span and could be of its kind (``possible``); pattern spans always stay.

Null and empty texts have no spans, rows of one key are separate texts, null keys are kept and never trained on. Masked
texts keep everything outside the spans.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bilstm import BiLstmCrf, char_ids

KINDS = ("email", "ip", "card", "phone")
NAMES = (*KINDS, "account", "secret")  # the last two by the network only
WINDOW, STRIDE, REACH = 64, 32, 24

# The patterns of the four kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NAMED = r"(?i:passw(?:or)?d|passphrase|secret|token|api[_-]?key|access[_-]?key)[\"']?\s*[:=]\s*"
_AT, _DOT = r"(?:\s*@\s*|\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+)", r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\.)"
_TRIGGER = re.compile(r"[0-9@]|(?i:[\[({<]\s?(?:at|dot)\s?[\])}>])|\b(?i:dot)\b|" + _NAMED)
_SPELLED = re.compile(rf"[a-z0-9_%+-]+(?:{_DOT}[a-z0-9_%+-]+)*{_AT}[a-z0-9-]+(?:{_DOT}[a-z0-9-]+)*{_DOT}[a-z]{{2,}}", re.I)
_DATE = re.compile(r"[0-9]{1,4}([./ -])[0-9]{1,2}\1[0-9]{1,4}")
_ASSIGNED = re.compile(_NAMED + r"[\"']?([^\s\"',;]{8,})")

Span = tuple[int, int, int]  # kind's number, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def pattern_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start: leftmost, not overlapping within a kind."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:  # whether a match is possible depends on what follows the @ only
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    for found in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found[0].split(".")):
            out.append((1, *found.span()))
    for found in _CARD.finditer(text):
        digits = _digits(found[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *found.span()))
    for found in _PHONE.finditer(text):
        if 8 <= len(_digits(found[0])) <= 15:
            out.append((3, *found.span()))
    return out


def _word_edge(text: str, at: int, step: int) -> int:
    """``at`` moved to the edge of the word it lies in."""
    while 0 < at < len(text) and not text[at - 1 if step < 0 else at].isspace():
        at += step
    return at


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around what may belong to a span, in whole words."""
    out: list[list[int]] = []
    for found in _TRIGGER.finditer(text):
        end = found.end() + REACH
        if out and found.start() - REACH <= out[-1][1]:
            if end > out[-1][1]:
                out[-1][1] = min(end, len(text))
            continue
        if out:
            out[-1][1] = _word_edge(text, out[-1][1], 1)
            if found.start() - REACH <= out[-1][1]:
                out[-1][1] = max(out[-1][1], min(end, len(text)))
                continue
        start = max(out[-1][1] if out else 0, found.start() - REACH)
        start = max(out[-1][1] if out else 0, _word_edge(text, start, -1))
        out.append([start, min(end, len(text))])
    if out:
        out[-1][1] = _word_edge(text, out[-1][1], 1)
    return [(a, b) for a, b in out]


def _window_starts(length: int) -> list[int]:
    return [0] if length <= WINDOW else [*range(0, length - WINDOW, STRIDE), length - WINDOW]


_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)


def _address(text: str) -> bool:
    parts = [p for p in re.split(r"[^0-9]+", text) if p]
    if len(parts) == 4 and not re.search("[A-Zb-ce-np-su-z]", text):  # no letters but those of "dot"
        return all(len(p) <= 3 and int(p) <= 255 for p in parts)
    try:
        return text.count(":") >= 2 and ipaddress.ip_address(text.strip("[]")).version == 6
    except ValueError:
        return False


def _account(text: str) -> bool:
    plain = re.sub("[ -]", "", text).upper()
    if not re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", plain):
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def possible(kind: int, text: str) -> bool:
    """Whether a span can be of its kind: whole, in range, its check digits right."""
    digits = _digits(text)
    if kind == 0:
        return _SPELLED.fullmatch(text) is not None
    if kind == 1:
        return _address(text)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9][0-9 ./_-]+[0-9]", text) is not None
    if kind == 3:
        return 7 <= len(digits) <= 15 and re.fullmatch(r"[+(0-9][0-9 ().+/-]+[0-9]", text) is not None and not _DATE.fullmatch(text) and text.count(".") < 3 and digits != text
    if kind == 4:
        return _account(text)
    return len(text) >= 8 and not any(c.isspace() for c in text) and len(set(text)) >= 5


def network_spans(texts: list[str], model: BiLstmCrf, batch: int = 2048) -> list[list[Span]]:
    """Spans the network finds in each text, by start."""
    parts = [(d, a, b) for d, text in enumerate(texts) for a, b in stretches(text)]
    out: list[list[Span]] = [[] for _ in texts]
    group, size = [], 0
    for k, part in enumerate(parts):
        group.append(part)
        size += len(_window_starts(part[2] - part[1]))
        if size < batch and k + 1 < len(parts):
            continue
        places = [(g, s) for g, (_, a, b) in enumerate(group) for s in _window_starts(b - a)]
        coded = [char_ids(texts[d][a:b]) for d, a, b in group]
        ids = np.zeros((len(places), WINDOW), np.int64)
        for row, (g, s) in enumerate(places):
            piece = coded[g][s : s + WINDOW]
            ids[row, : len(piece)] = piece
        score = [np.zeros((max(len(c), WINDOW), model.tags)) for c in coded]
        weight = [np.zeros(len(s)) for s in score]
        for low in range(0, len(ids), batch):
            found = model.emissions(ids[low : low + batch])
            for (g, s), e in zip(places[low : low + batch], found):
                score[g][s : s + WINDOW] += e * _WEIGHT[:, None]
                weight[g][s : s + WINDOW] += _WEIGHT
        for (d, a, _), c, s, w in zip(group, coded, score, weight):
            tags = model.decode((s / w[:, None])[: len(c)])
            out[d] += [(k, a + i, a + j) for k, i, j in tag_spans(tags)]
        group, size = [], 0
    return out


def tag_spans(tags: np.ndarray) -> list[Span]:
    """Tag 0 is outside; 2k + 1 begins a span of kind k and 2k + 2 continues it."""
    out: list[Span] = []
    for t, tag in enumerate(tags.tolist()):
        if tag % 2:
            out.append((tag // 2, t, t + 1))
        elif tag and out and out[-1][2] == t and out[-1][0] == tag // 2 - 1:
            out[-1] = (out[-1][0], out[-1][1], t + 1)
    return out


def all_spans(texts: list[str | None], model: BiLstmCrf | None) -> list[tuple[list[Span], list[Span]]]:
    """Pattern spans, and all spans, of each text."""
    found = [(pattern_spans(t) if t and _TRIGGER.search(t) else []) for t in texts]
    if model is None:
        return [(f, f) for f in found]
    where = [k for k, t in enumerate(texts) if t and _TRIGGER.search(t)]
    added = dict(zip(where, network_spans([texts[k] for k in where], model)))
    out = []
    for k, (text, base) in enumerate(zip(texts, found)):
        more = []
        for kind, a, b in added.get(k, ()):
            while a < b and text[a].isspace():
                a += 1
            while a < b and text[a] in "\"'":
                a += 1
            while b > a and text[b - 1] in " .,;:!?\n\"'":
                b -= 1
            if b > a and all(b <= s or a >= e for _, s, e in base) and possible(kind, text[a:b]):
                more.append((kind, a, b))
        out.append((base, sorted(base + more)))
    return out


def _letters(rng: np.random.Generator, n: int) -> str:
    return "".join(chr(97 + c) for c in rng.integers(0, 26, n))


def _number(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _card(rng: np.random.Generator, valid: bool) -> str:
    size = int(rng.choice([15, 16, 16, 16, 19]))
    body = str(int(rng.integers(3, 7))) + _number(rng, size - 2)
    right = next(d for d in range(10) if luhn(body + str(d)))
    body += str(right if valid else (right + int(rng.integers(1, 10))) % 10)
    gap = str(rng.choice(["", "", " ", "-", ".", "/", "  "]))
    return gap.join([body[:4], body[4:10], body[10:]] if size == 15 else [body[k : k + 4] for k in range(0, size, 4)])


def _email(rng: np.random.Generator) -> str:
    at, dot = [("@", "."), ("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "."), (" (at) ", "."), (" [at] ", "."), (" AT ", " DOT "), (" @ ", ".")][int(rng.integers(0, 10))]
    inner = dot if len(dot) > 3 and rng.random() < 0.5 else str(rng.choice(["", ".", "_", "-", "+"]))
    name = _letters(rng, int(rng.integers(2, 9))) + inner + _letters(rng, int(rng.integers(1, 7))) + (_number(rng, int(rng.integers(1, 4))) if rng.random() < 0.3 else "")
    host = _letters(rng, int(rng.integers(2, 9))) + (dot + _letters(rng, 4) if rng.random() < 0.2 else "")
    return f"{name}{at}{host}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'io'])}"


def _phone(rng: np.random.Generator) -> str:
    area, one, two = _number(rng, 3), _number(rng, 3), _number(rng, 4)
    style = int(rng.integers(0, 9))
    if style < 3:
        return f"+{int(rng.integers(1, 99))} " + [f"({area}) {one}-{two}", f"{area} {one} {two}", f"{area}-{one}-{two}"][style]
    return [f"({area}) {one}-{two}", f"{area}-{one}-{two}", f"0{area[:2]} {two} {_number(rng, 4)}", f"00{area[:2]} {one} {two}{area}", f"0{area}/{two}{one}", f"{area}.{one}.{two}"][style - 3]


def _iban(rng: np.random.Generator) -> str:
    country, body = str(rng.choice(["DE", "FR", "ES", "IT", "GB", "NL"])), _number(rng, int(rng.integers(14, 22)))
    rest = int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    whole = f"{country}{98 - rest:02d}{body}"
    return " ".join(whole[k : k + 4] for k in range(0, len(whole), 4)) if rng.random() < 0.5 else whole


def generated_span(kind: int, rng: np.random.Generator) -> tuple[str, str, str]:
    """A made-up span of a kind in one of many spellings, and what stands before and after it."""
    if kind == 5:
        name = str(rng.choice(["token", "password", "secret", "api_key", "apikey", "access_key", "TOKEN", "passwd", "API-KEY"]))
        joint, quote = str(rng.choice([" = ", "=", ": ", ":"])), str(rng.choice(['"', '"', "'", ""]))
        signs = str(rng.choice(["0123456789abcdef", "0123456789ABCDEF", "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789-_"]))
        size = int(rng.choice([12, 20, 32, 40]))
        return "".join(signs[c] for c in rng.integers(0, len(signs), size)), name + joint + quote, quote
    if kind == 1:
        gap = str(rng.choice([".", ".", "[.]", " . ", "(.)"]))
        if rng.random() < 0.25:
            return ":".join(f"{c:x}" for c in rng.integers(0, 65536, 8)), "", ""
        return gap.join(map(str, rng.integers(0, 256, 4))), "", ""
    text = [lambda: _email(rng), None, lambda: _card(rng, True), lambda: _phone(rng), lambda: _iban(rng)][kind]()
    lead = [["", "", "mail: ", "write to "], [], ["", "", "card "], ["", "", "call ", "tel. ", "phone: "], ["", "", "IBAN "]][kind]
    return text, str(rng.choice(lead)), ""


def generated_trap(rng: np.random.Generator) -> str:
    """Something that looks like a span and is none."""
    n = lambda a, b: int(rng.integers(a, b))
    style = n(0, 14)
    if style < 4:
        return _card(rng, False).replace("  ", " ")
    if style == 4:  # a version or a section
        return ".".join(str(n(0, 20)) for _ in range(n(2, 4)))
    if style == 5:
        return f"{n(1900, 2030)}-{n(1, 13):02d}-{n(1, 29):02d}" + (f" {n(0, 24):02d}:{n(0, 60):02d}:{n(0, 60):02d}" if rng.random() < 0.5 else "")
    if style == 6:
        return str(rng.choice(["/", "."])).join([f"{n(1, 29):02d}", f"{n(1, 13):02d}", str(n(1900, 2030))])
    if style == 7:
        return f"{n(1900, 2000)}-{n(2000, 2030)}" if rng.random() < 0.5 else f"pp. {n(1, 300)}-{n(300, 600)}"
    if style == 8:  # octets out of range
        return ".".join(str(n(256, 999)) for _ in range(4))
    if style == 9:
        return f"978-{n(0, 9)}-{_number(rng, 2)}-{_number(rng, 6)}-{n(0, 9)}"
    if style == 10:
        return f"{n(1, 999)},{_number(rng, 3)}" + (f".{_number(rng, 2)}" if rng.random() < 0.5 else "")
    if style == 11:
        return _number(rng, n(1, 13))
    if style == 12:
        return str(rng.choice(["the dot at the end", "look at the dot", "met at noon by the dot com firm", "a token of thanks", "the secret: nothing", "arrive at 9.30"]))
    return f"commit {''.join('0123456789abcdef'[c] for c in rng.integers(0, 16, 40))}"


def _assigned(text: str) -> list[Span]:
    """Values of secrets named in a document, so that its windows don't teach the network to pass them over."""
    return [(5, *found.span(1)) for found in _ASSIGNED.finditer(text)]


def training_windows(texts: list[str], made: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows with tags, at most ``made`` of the documents, as many with made-up spans of each kind and as many with
    look-alikes. Every stretch of a document may be drawn, and every part of it."""
    rng = np.random.default_rng(seed)
    rows: list[tuple[str, list[Span]]] = []
    places = [(d, a, b) for d, text in enumerate(texts) for a, b in stretches(text)]
    known: dict[int, list[Span]] = {}
    for p in rng.permutation(len(places))[:made].tolist():
        d, a, b = places[p]
        if d not in known:
            known[d] = pattern_spans(texts[d]) + _assigned(texts[d])
        s = a + int(rng.integers(0, max(1, b - a - WINDOW + 1)))
        rows.append((texts[d][s : s + WINDOW], [(k, i - s, j - s) for k, i, j in known[d] if i < s + WINDOW and j > s]))
    plain = [t for t in texts if len(t) > 2 * WINDOW] or ["lorem ipsum dolor sit amet " * 10]
    for k in range((len(NAMES) + 2) * made):
        kind = k % (len(NAMES) + 2)
        text = plain[int(rng.integers(len(plain)))]
        s = int(rng.integers(0, len(text) - WINDOW))
        span, lead, tail = generated_span(kind, rng) if kind < len(NAMES) else (generated_trap(rng), "", "")
        gap = int(rng.integers(0, max(1, WINDOW - len(span) - len(lead) + 1)))
        before = re.sub("[0-9@]", "x", text[s : s + gap])
        if before and not before[-1].isspace():
            before = before[:-1] + " "
        whole = before + lead + span + tail + str(rng.choice([" ", ". ", ", ", "; "])) + re.sub("[0-9@]", "x", text[s + gap : s + WINDOW])
        start = len(before) + len(lead)
        rows.append((whole[:WINDOW], [(kind, start, start + len(span))] if kind < len(NAMES) else [t for t in pattern_spans(whole[:WINDOW])]))
    ids, tags = np.zeros((len(rows), WINDOW), np.int64), np.zeros((len(rows), WINDOW), np.int64)
    for r, (text, spans) in enumerate(rows):
        ids[r, : len(text)] = char_ids(text)
        for kind, a, b in sorted(spans, key=lambda t: -t[0]):
            tags[r, max(a, 0) : b] = 2 * kind + 2
            if a >= 0:
                tags[r, a] = 2 * kind + 1
    return ids, tags


def training_texts(docs: DataFrame, train_docs: int, train_bytes: int, key: str, text: str) -> list[str]:
    """One text of each drawn key; keys and sizes of at most ``train_docs`` are looked at before texts are read."""
    rows = docs.where(F.col(key).isNotNull() & F.col(text).rlike("[0-9@]")).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    one = rows.groupBy("_key").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), F.octet_length("_text").alias("size"))).alias("_t"))
    drawn = one.orderBy(F.xxhash64(F.lit(17), "_key"), "_key").limit(train_docs).select("_key", "_t.h", "_t.size").collect()
    chosen, held = [], 0
    for r in drawn:
        held += r["size"]
        if held <= train_bytes:
            chosen.append((r["_key"], r["h"]))
    wanted = docs.sparkSession.createDataFrame(chosen, f"_key {docs.schema[key].dataType.simpleString()}, _h long")
    read = rows.join(F.broadcast(wanted), "_key").where(F.xxhash64("_text") == F.col("_h")).groupBy("_key").agg(F.min("_text").alias("_text"))
    return read.orderBy("_key").toArrow().column("_text").to_pylist()


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", train_docs: int = 1000, train_bytes: int = 16 << 20, made: int = 420, seed: int = 13) -> BiLstmCrf:
    """Fit on windows of at most ``train_docs`` documents with a digit or ``@``, of ``train_bytes`` in all, and made-up ones."""
    tags = 2 * len(NAMES) + 1
    banned = np.zeros((tags, tags), bool)
    for k in range(2, tags, 2):  # a span continues only what it began
        banned[:, k] = True
        banned[[k - 1, k], k] = False
    model = BiLstmCrf(tags, hidden=16, banned=banned)
    model.fit(*training_windows(training_texts(docs, train_docs, train_bytes, key, text), made, seed), epochs=6, batch=64)
    return model


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{NAMES[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, model: BiLstmCrf | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the number of pattern spans of each kind, ``base_sha256`` of their list, and ``spans``: the list of all."""
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                found = all_spans(part.column(text).to_pylist(), model)
                count = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in found], pa.int64()) for kind in range(len(KINDS))]
                digest = pa.array([hashlib.sha256(spans_text(base).encode()).hexdigest() for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(key), *count, digest, pa.array([spans_text(s) for _, s in found], pa.string())], [key, *names, "base_sha256", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the union is replaced once."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{NAMES[kind].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def mask_pii(docs: DataFrame, model: BiLstmCrf | None, text: str = "text") -> DataFrame:
    """The documents, all columns and rows, with personal data masked in ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                texts = part.column(text).to_pylist()
                clean = [masked(t, s) if s else t for t, (_, s) in zip(texts, all_spans(texts, model))]
                at = part.schema.get_field_index(text)
                yield part.set_column(at, part.schema.field(at), pa.array(clean, part.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
