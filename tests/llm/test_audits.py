"""Centroids, toxicity and source divergence against plain Python, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import oracle
from orrery.llm import centroids, divergence, toxicity
from orrery.llm.oracles import ORACLES
from orrery.llm.queries import QUERIES

from .helpers import prose

VECTORS = "vec_id long, embedding array<double>, distance string, cluster string, _id int, centroid int"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sample_dir, name):
    assert oracle.compare(QUERIES[name](spark, sample_dir), oracle.connect(sample_dir), ORACLES[name]) is None


# -- centroids ----------------------------------------------------------------------

def brute_clusters(rows, k, rounds, dim, scale=1024, salt="3"):
    kept = [(key, [math.floor(x * scale) for x in v]) for key, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in first[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))

    def assign():
        return [min(range(len(now)), key=lambda c: (far(v, now[c]), c)) for _, v in kept]

    for _ in range(rounds):
        to = assign()
        for c in range(len(now)):
            own = [v for (_, v), t in zip(kept, to) if t == c]
            if own:
                now[c] = [sum(x) // len(own) for x in zip(*own)]
    to = assign()
    far_off = [far(v, now[t]) for (_, v), t in zip(kept, to)]
    each = Counter()
    for t, d in zip(to, far_off):
        each[t] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return Counter((key, t, d, each[t], sum(far_off), sha[t]) for (key, _), t, d in zip(kept, to, far_off))


def found_clusters(spark, rows, **options):
    table = spark.createDataFrame([(key, v, "x", "y", 7, 8) for key, v in rows], VECTORS)
    out = centroids.cluster(table, **options)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"]
    return Counter(tuple(r[c] for c in out.columns if c != "centroid") for r in out.collect())


def test_centroids_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(k % 5, 0.4) for _ in range(6)]) for k in range(400)]
    rows += [(1000 + k, [1.5, -2.0, 0.25, 0.0, 1.0, 3.0]) for k in range(200)]  # a third of all rows alike
    rows += [(7, [0.0] * 6), (7, [0.0] * 6), (7, [1.0] * 6), (None, [2.0] * 6)]  # repeated and null ids
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 5 + [None]), (2004, [float("nan")] * 6), (2005, [float("-inf")] + [0.0] * 5)]
    for rounds in (0, 1, 10):
        assert found_clusters(spark, rows, k=8, rounds=rounds, dim=6) == brute_clusters(rows, 8, rounds, 6)


def test_centroids_ties_few_and_no_vectors(spark):
    same = [(k, [0.5, 0.5]) for k in range(20)]  # all seeds equal: everything in cluster 0, the others stay empty
    assert found_clusters(spark, same, k=4, dim=2) == brute_clusters(same, 4, 10, 2)
    few = [(1, [0.0, 1.0]), (2, [4.0, -1.0])]
    assert found_clusters(spark, few, k=8, dim=2) == brute_clusters(few, 8, 10, 2)
    assert found_clusters(spark, [(1, None)], dim=2) == Counter() == found_clusters(spark, [], dim=2)


def test_centroids_too_large_for_a_long(spark):
    rows = [(k, [float(k), 1.0]) for k in range(10)]
    large = [(100, [1e30, 0.0]), (101, [-131072.0, 0.0])]
    want = brute_clusters(rows, 3, 10, 2) + Counter((key, None, None, None, None, None) for key, _ in large)
    assert found_clusters(spark, rows + large, k=3, dim=2) == want
    assert found_clusters(spark, large, k=3, dim=2) == Counter((key, None, None, None, None, None) for key, _ in large)
    edge = [(k, [131071.0 * (-1) ** k, 131071.0 * (k % 3 - 1)]) for k in range(12)]
    assert found_clusters(spark, edge, k=3, dim=2) == brute_clusters(edge, 3, 10, 2)


# -- toxicity -----------------------------------------------------------------------

MASK = (1 << 64) - 1


def mix(x: int) -> int:
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def word_hash(word: bytes) -> int:
    base, total, power = 0x9E3779B97F4A7C15 | 1, 0, 1
    for b in word:
        total += (mix((b + 1) * 0xD1342543DE82EF95 & MASK) | 1) * power
        power = power * base & MASK
    return mix((total + len(word) * 0xA24BAED4963EE407) & MASK)


def brute_slots(text: str | None) -> set[int]:
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    h = [word_hash(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", data)]
    out = set(h)
    for gap in (1, 2, 3):
        out |= {mix((a * (2 * gap + 1) + (b ^ gap << 40)) & MASK) for a, b in zip(h, h[gap:])}
    return {x >> 64 - toxicity.BITS for x in out}


def test_toxicity_scores_equal_plain_python(spark):
    rng = random.Random(4)
    texts = [" ".join(prose(rng, rng.choice([3, 40, 300]), 200) + (["Filth,", "you"] if k % 4 == 0 else [])) for k in range(300)]
    labels = [int(k % 4 == 0) for k in range(300)]
    model = toxicity.fit(texts, labels)
    assert 0 < len(model.slots) < 2000 and (model.weights != 0).all()
    weight = dict(zip(model.slots.tolist(), model.weights.tolist()))
    rows = list(enumerate(texts[:40] + [None, "", " \n", "!!! --", "Ärger FILTH", "x" * 400_000, "filth " * 30_000])) + [(3, texts[3]), (None, "filth you")]
    table = spark.createDataFrame([(key, t, 1.0, "z") for key, t in rows], "doc_id long, text string, score double, _key string")
    found = sorted((r["doc_id"] is None, r["doc_id"], r["score"]) for r in toxicity.toxicity_scores(table, model).collect() if r["doc_id"] is not None)
    want = sorted((False, key, 1 / (1 + math.exp(-max(-30, min(30, model.intercept + sum(weight.get(s, 0.0) for s in brute_slots(t))))))) for key, t in rows if key is not None)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in want], abs=1e-9)
    held = toxicity.ToxicityModel(model.slots, model.weights, model.intercept)
    assert held.score(pa.array(["so filth you see", "so they see"])).round().tolist() == [1.0, 0.0]


def test_toxicity_training_sample(spark):
    docs = [(k, f"plain words number {k}") for k in range(60)] + [(100 + k, f"vile words {k}") for k in range(60)]
    docs += [(500, f"hot id {k}") for k in range(400)] + [(None, "no id"), (900, None)]
    labels = [(k, 0) for k in range(60)] + [(100 + k, 1) for k in range(60)] + [(100, 0), (500, 0), (None, 1), (900, 1), (901, 1), (5, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("toxic", F.lit(9))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    texts, marked = toxicity.training_rows(d, marks, F.lit(True), 4000, 1 << 20, "doc_id", "text", "toxic")
    assert len(texts) == 121 and sum(marked) == 59  # one text of id 500; id 100 has a 0 as its lowest label
    assert sum(t.startswith("hot") for t in texts) == 1
    texts, marked = toxicity.training_rows(d, marks, F.lit(True), 40, 1 << 20, "doc_id", "text", "toxic")
    assert len(texts) == 40 and sum(marked) == 20
    assert sum(map(len, toxicity.training_rows(d, marks, F.lit(True), 4000, 100, "doc_id", "text", "toxic")[0])) <= 100
    for model in (toxicity.train(d, marks.limit(0), F.lit(True)), toxicity.train(d.limit(0), marks, F.lit(True)), toxicity.train(d, marks, F.lit(False))):
        assert {r["score"] for r in toxicity.toxicity_scores(d, model).collect()} == {0.5}
    assert toxicity.toxicity_scores(d.limit(0), model).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op12_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    rate = {r["toxic"]: r["p"] for r in found}
    assert rate[1] > 0.65 and rate[0] < 0.005


# -- divergence ---------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_divergence(rows, min_docs=3, top=200):
    docs = [(t or "", lang or "", source or "") for t, lang, source in rows]
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = Counter(TERM.findall(text.translate(LOWER)))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in df.items() if n >= min_docs) for lang, df in seen.items()}
    groups = sorted({(lang, source) for _, lang, source in docs})

    def shares(own, lang):
        whole, v = sum(own[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (own[t] + 1) // (whole + v) for t in kept[lang]}

    gap = lambda p, q: (p - q) * (p - q) // q
    out = Counter()
    for lang, source in groups:
        p = shares(counts[lang, source], lang)
        pairs = []
        for other in [s for g, s in groups if g == lang and s != source]:
            q = shares(counts[lang, other], lang)
            pairs.append((-sum(gap(p[t], q[t]) for t in kept[lang]), other.encode(), other))
        total = Counter()
        for g, s in groups:
            if g == lang:
                total.update(counts[g, s])
        q = shares(total, lang)
        terms = [(-gap(p[t], q[t]), t.encode(), t) for t in kept[lang] if counts[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out.update((lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1))
    return out


def found_divergence(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], "text string, lang string, source string, doc_id long, item string, _group int").repartition(5)
    out = divergence.source_divergence(table, **options)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return Counter(tuple(r) for r in out.collect())


def divergent_documents(seed=6):
    rng = random.Random(seed)
    spell = lambda w: rng.choice([w, w.upper(), f"({w},", f"{w}-{rng.choice(['x', 'É'])}", f"{w}{rng.randrange(10**6)}", f"{w}.{w}"])
    rows = []
    for k in range(300):
        lang = rng.choice(["aa", "aa", "bb", None, ""])
        source = "hot" if k % 3 == 0 else rng.choice(["s1", "s2", None, "sé", "\U0001f600"])
        words = [spell("t" + "abcdefghij"[rng.randrange(10)] * rng.randrange(1, 9)) for _ in range(rng.choice([0, 1, 30]))]
        rows.append((rng.choice([" ", "\n", "\t\x0b"]).join(words) or rng.choice([None, "", "1 2 3"]), lang, source))
    return rows + [rows[0]] * 3 + [("only here once", "cc", "s1"), (None, "cc", "s2"), ("alone", "dd", "s1")] + [("aa " * 30_000, "aa", "s1"), ("z" * 200_000, "aa", "s2")]


def test_divergence_equals_brute_force(spark, monkeypatch):
    rows = divergent_documents()
    want = brute_divergence(rows)
    assert found_divergence(spark, rows) == want
    # Small stretches, buckets and blocks: rows meet from many tasks, and terms from many buckets.
    monkeypatch.setattr(divergence, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 7)
    assert found_divergence(spark, rows) == want
    assert found_divergence(spark, rows, min_docs=5, top_terms=3) == brute_divergence(rows, 5, 3)
    assert found_divergence(spark, rows, min_docs=1) == brute_divergence(rows, 1)


def test_divergence_without_terms_or_rows(spark):
    none = [(None, "aa", "s1"), ("12 34", "aa", "s2"), ("word", "aa", "s3"), ("word", "bb", "s1")]
    assert found_divergence(spark, none) == brute_divergence(none)
    assert found_divergence(spark, []) == Counter()


def test_split_chunks_once_each():
    at, terms, times = divergence.split_chunks(["a.b.a", "--", "word", "x1y"])
    assert (at.tolist(), terms, times.tolist()) == ([0, 0, 2, 3, 3], ["a", "b", "word", "x", "y"], [2, 1, 1, 1, 1])
