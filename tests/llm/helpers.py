"""Small tables and plain-Python versions the operators are compared with."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(key: int) -> int:
    return zlib.crc32(str(key).encode())


def prose(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng: random.Random, text: list[str], edits: int) -> list[str]:
    out = list(text)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def copy_documents(seed: int = 1) -> list[tuple[int, str | None]]:
    """Documents with exact and near copies of every closeness, chains, shared passages, short, empty and null ones."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    passage = prose(rng, 60)
    for k in range(60):
        base = prose(rng, rng.choice([4, 12, 40, 150, 400]))
        texts.append(" ".join(base))
        if k % 3 == 0:
            texts += [" ".join(edited(rng, base, e)) for e in (0, 1, 1, 2, 3, 5)]
        if k % 7 == 0:  # a chain: each link an edit of the one before
            for _ in range(5):
                base = edited(rng, base, 2)
                texts.append(" ".join(base))
        if k % 4 == 0:
            texts.append(" ".join(prose(rng, 30) + passage + prose(rng, 30)))
    hub = prose(rng, 300)
    texts += [" ".join(edited(rng, hub, 5)).upper() for _ in range(80)] + [" ".join(hub)] * 20
    texts += [None, "", " \n\t ", "one", "one two", "ONE two", "one two three", "a b c d e", "x" * 3000]
    texts.append(" ".join(prose(rng, 20_000)))
    rng.shuffle(texts)
    return list(enumerate(texts))


def cropped_documents(width: int, percent: int, seed: int = 11) -> list[tuple[int, str]]:
    """Texts, their beginnings and ends just inside the threshold, and beginnings that go on differently: too far from the
    whole text, near enough to its beginning."""
    rng = random.Random(seed)
    texts = []
    for k in range(24):
        base = prose(rng, 100 + width - 1, 10**6)
        part = percent + 2 + width - 1
        texts += [" ".join(base), " ".join(base[:part]), " ".join(base[-part:])]
        more = 100 * (percent + 2) // percent - percent - 2
        texts.append(" ".join(base[:part] + prose(rng, max(1, more - k % 2), 10**6)))
        if k % 3 == 0:
            texts += [" ".join(base[4 : part + 4]), " ".join(prose(rng, 3, 10**6) + base[-part:])]
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute_components(docs: list[tuple[int, str | None]], width: int, percent: int) -> dict[int, tuple[int, int]]:
    """``doc_id`` to (number of shingles, component), over all pairs."""
    sets = {}
    for key, text in docs:
        w = words((text or "").translate(_LOWER))
        sets[key] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {key: key for key in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {key: (len(sets[key]), find(key)) for key in keys}


def brute_substrings(docs: list[tuple[int, str | None]], width: int = 13) -> dict[int, tuple[int, int, str]]:
    first: dict[tuple[str, ...], int] = {}
    split = {key: words(text) for key, text in sorted(docs)}
    for key, w in split.items():
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), key)
    out = {}
    for key, w in split.items():
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < key:
                gone[k : k + width] = [True] * width
        out[key] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def brute_fertility_base(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen: dict[tuple[str, ...], list[int]] = {}
    for k in range(len(w) - 4):
        seen.setdefault(tuple(w[k : k + 5]), []).append(k)
    covered = {k + j for at in seen.values() if len(at) > 1 for k in at for j in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)


def brute_pii(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        check = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and check % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out
