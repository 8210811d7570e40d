"""Vectors, URLs, the graph helper, and the pipeline's stages on small tables."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orrery.llm import neighbours, urls
from orrery.llm.graph import components
from orrery.llm.queries import URL_RULES

from .helpers import brute_components, words

VECTORS = "vec_id long, embedding array<float>"


def brute_nearest(rows, k):
    usable = {key: np.array(v, np.float64) for key, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in usable.items():
        if q % 20 == 0:
            score = sorted((-float(v @ w), key) for key, w in usable.items() if key != q and len(w) == len(v))
            out[q] = [(key, -s) for s, key in score[:k]]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((8, 16))
    rows = [(k, [float(x) for x in np.float32(centres[k % 8] + 0.2 * rng.standard_normal(16))]) for k in range(1500)]
    rows += [(2000 + k, [1.0] * 16) for k in range(300)]  # one vector that many rows share
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [1.0, None]), (5080, [float("inf")] * 16)]
    table = spark.createDataFrame(rows, VECTORS).withColumn("bits", F.lit(1))
    want = brute_nearest(rows, 20)
    got: dict[int, list] = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0, reach=8.0, slice_rows=400).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    hits = sum(len({k for k, _ in got[q]} & {k for k, _ in want[q]}) for q in want)
    assert hits >= 0.97 * sum(map(len, want.values()))
    shared = [q for q in want if q >= 2000]
    for q in shared:  # ties go to the smaller id
        assert [k for k, _ in got[q]] == [k for k in range(2000, 2022) if k != q][:20]
    vectors = dict(rows)
    for q in want:
        for key, score in got[q]:
            assert score == pytest.approx(float(np.dot(np.array(vectors[q]), np.array(vectors[key]))), abs=1e-12)


def test_nearest_in_a_jittered_cluster(spark):
    rng = np.random.default_rng(2)
    near = rng.standard_normal(16) + 1e-3 * rng.standard_normal((8000, 16))
    near = np.float32(near / np.linalg.norm(near, axis=1)[:, None])
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(near)]
    found: dict[int, set] = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 200 == 0, slice_rows=1000).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    score = near[::200].astype(np.float64) @ near.astype(np.float64).T
    score[np.arange(40), np.arange(0, 8000, 200)] = -1
    want = np.argsort(-score, axis=1)[:, :20]
    assert sum(len(found[200 * k] & set(w.tolist())) for k, w in enumerate(want)) >= 0.9 * want.size


def test_nearest_small_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 2.0])], VECTORS)
    found = [tuple(r) for r in neighbours.nearest(few, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 1, 1.0), (20, 2, 0, 0.0)]
    assert neighbours.nearest(few.limit(0), F.lit(True)).count() == 0


def test_url_rules_and_model(spark):
    rows = [(k, f"http://www.good{k % 9}.example.net/en/{k}") for k in range(200)]
    rows += [(1000 + k, f"http://casino{k % 7}-win.example.com/de/{k}?x=1") for k in range(200)]
    rows += [(3000, None), (3001, ""), (3002, "no scheme/en/"), (3003, "HTTP://EXAMPLE.NET/en/a#b"), (3004, "x://a.org/fr/?q"), (3005, "x://a.org/FR/"), (3006, "x://sub.net"), (3007, "x://sub.net/"), (3008, "x://notexample.net/en/x"), (3009, "a://b://c.net/d"), (3010, "http://casino3-win.example.org/xx/9"), (3011, "http://www.good4.example.org/xx/9")]
    found = {r["page_id"]: r for r in urls.url_verdicts(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()}
    assert len(found) == len(rows)
    say = lambda k: (found[k]["host"], found[k]["path"], found[k]["rule"])
    assert say(0) == ("www.good0.example.net", "/en/0", "example.net/en/") and found[0]["verdict"] == "allow"
    assert say(1000)[2] == "example.com/de/" and found[1000]["verdict"] == "block"
    assert say(3000) == say(3001) == say(3002) == ("", "", None)
    assert say(3003) == ("example.net", "/en/a", "example.net/en/")
    assert say(3004)[2] == "org/fr/" and say(3005)[2] is None
    assert say(3006) == ("sub.net", "", None) and say(3007)[2] == "net/" and found[3007]["verdict"] == "block"
    assert say(3008)[2] == "net/"
    assert say(3009) == ("b:", "//c.net/d", None)
    assert found[3010]["url_score"] < found[3011]["url_score"]
    assert urls.url_verdicts(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_url_scores_with_many_ngrams(spark):
    """Far more distinct n-grams than 2^16: the counts stay those of the whole n-grams."""
    rng = random.Random(12)
    make = lambda kind: f"http://{kind}/" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    rows = [(k, make("example.net/en" if k % 2 else "example.com/de")) for k in range(6000)] + [(9000 + k, make("a.org/xx")) for k in range(50)]
    counts: list[Counter] = [Counter(), Counter()]

    def grams(url):
        data = bytes(5) + url.encode() + b"\0"
        return [[(data[i - o : i], data[i]) for o in range(6)] for i in range(5, len(data))]

    for key, url in rows:
        if key < 9000 and zlib.crc32(str(key).encode()) % 5:
            counts[key % 2].update(x for at in grams(url) for c, ch in at for x in ((c, None), (c, ch)))
    assert len(counts[0]) > 4 * 2**16

    def score(url):
        total = 0.0
        for at in grams(url):
            for label, sign in ((1, 1), (0, -1)):
                p = 1 / 256
                for c, ch in at:
                    p = (counts[label][c, ch] + 4 * p) / (counts[label][c, None] + 4)
                total += sign * math.log(p)
        return total / (len(url) + 1)

    table = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    found = {r["page_id"]: r["url_score"] for r in urls.url_verdicts(table, URL_RULES).collect()}
    for key, url in rows[:40] + rows[-50:]:
        assert found[key] == pytest.approx(score(url), abs=1e-6)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    columns = docs.columns
    good = corpus_pipeline.keep_good(spark, docs, sample_dir).cache()
    assert good.columns == columns and 0.7 * docs.count() < good.count() <= docs.count()
    distinct = corpus_pipeline.keep_distinct(spark, good, sample_dir).cache()
    groups = brute_components([(r["doc_id"], r["text"]) for r in good.select("doc_id", "text").collect()], 5, 80)
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted(k for k, (_, root) in groups.items() if k == root)
    clean = corpus_pipeline.mask_personal(spark, distinct, sample_dir).cache()
    assert clean.columns == columns and clean.count() == distinct.count()
    mixed = corpus_pipeline.mix_sources(spark, clean, sample_dir).cache()
    assert mixed.columns == columns
    size = lambda df: sum(len(words(r["text"])) for r in df.select("text").collect())
    assert size(mixed) == pytest.approx(1.5 * size(clean), rel=0.03)
    last = corpus_pipeline.encode(spark, mixed, sample_dir)
    assert last.count() == mixed.count()


def test_near_duplicates_keep_other_texts_of_an_id(spark, sample_dir):
    a = " ".join(f"w{k}" for k in range(200))
    b = " ".join(f"v{k}" for k in range(50))
    rows = [(1, a, "x", "s", 1), (5, b, "x", "s", 1), (5, a + " more", "x", "s", 1), (6, b, "x", "s", 1), (6, b, "w", "s", 1), (7, "", None, None, 0), (7, "", None, None, 0), (None, a, "x", "s", 1), (None, a, "x", "s", 1)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    kept = sorted(map(tuple, corpus_pipeline.keep_distinct(spark, docs, sample_dir).collect()), key=str)
    assert kept == sorted([rows[0], rows[1], rows[5]] + [rows[7]] * 4, key=str)


def test_pipeline_stages_with_other_columns_and_nulls(spark, sample_dir):
    """Columns named like those the operators make, null ids and texts: every stage passes them through unchanged."""
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(3).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}))
    names = ("place", "block", "source_no", "target", "copies", "source_size", "size", "component_id", "n_shingles", "n_pii", "_words")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sample_dir)
        assert out.columns == docs.columns, name
        for r in out.collect():
            own = "none" if r["doc_id"] is None else str(r["doc_id"])
            assert all(r[c] == f"{c}-{own}" for c in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sample_dir).count() == docs.count()


def test_pipeline_stages_on_empty_tables(spark, sample_dir):
    none = spark.read.parquet(f"{sample_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sample_dir).count() == 0
