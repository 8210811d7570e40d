"""The text operators against plain Python, with nulls, empty and very long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import bpe, fertility, jaccard, language, mixing, pii, quality, substrings, textops
from orrery.llm.queries import tokenizer_file

from .helpers import brute_components, brute_fertility_base, brute_pii, brute_substrings, copy_documents, cropped_documents, edited, prose, sha, words

SCHEMA = "doc_id long, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_groups(spark, width, percent):
    docs = copy_documents()
    extra = frame(spark, docs).withColumns({"sig": F.lit(1), "_key": F.lit("x"), "token": F.lit(None)}).repartition(3)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(extra, width, percent).collect()}
    assert found == brute_components(docs, width, percent)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_groups_of_parts(spark, width, percent):
    docs = cropped_documents(width, percent)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(frame(spark, docs), width, percent).collect()}
    assert found == brute_components(docs, width, percent)


def test_jaccard_edges(spark):
    assert jaccard.jaccard_groups(frame(spark, [])).count() == 0
    rows = [(7, "a b c d"), (7, "x y z w"), (3, "x y z w"), (None, "a b c d"), (9, "a b c d"), (9, "a b c d")]
    found = sorted(map(tuple, jaccard.jaccard_groups(frame(spark, rows)).collect()), key=str)
    assert found == sorted([(7, 2, 7), (7, 2, 3), (3, 2, 3), (None, 2, None), (9, 2, 7), (9, 2, 7)], key=str)


def test_substrings(spark):
    docs = copy_documents(2)
    found = {r["doc_id"]: tuple(r)[1:] for r in substrings.dedup_substrings(frame(spark, docs).repartition(3), digest=True).collect()}
    assert found == brute_substrings(docs)


def test_substrings_edges(spark):
    assert substrings.dedup_substrings(frame(spark, [])).count() == 0
    text = " ".join(prose(random.Random(1), 40))
    rows = [(5, text), (5, text), (None, text), (2, "short " + text), (1, None)]
    found = sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in substrings.dedup_substrings(frame(spark, rows)).collect())
    assert found == [(-1, 40, 0), (1, 0, 0), (2, 41, 0), (5, 40, 40), (5, 40, 40)]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [t for _, t in copy_documents(3)] + ["Σας ΟΔΟΣ á İstanbul <|startoftext|>Hello<|endoftext|>x", "it's I'LL '’s", "a" * 4000, "\x1c\x1d\x85　 x y\x00z 中文字 ½³ 12345 !!!???", "𝔘𝔫𝔦 😀😀 ﻿abc"]
    rows = {r["doc_id"]: r for r in bpe.bpe_encode(frame(spark, list(enumerate(texts))), path).collect()}
    digests = {r["doc_id"]: r for r in bpe.bpe_encode(frame(spark, list(enumerate(texts))), path, digest=True).collect()}
    for key, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[key]["ids"] == ids and rows[key]["n_tokens"] == len(ids)
        assert rows[key]["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert digests[key]["ids_sha256"] == sha(" ".join(map(str, ids))) and digests[key]["decoded_sha256"] == sha(rows[key]["decoded"])
    assert bpe.bpe_encode(frame(spark, []), path).count() == 0
    small = {r["doc_id"]: r for r in bpe.bpe_encode(frame(spark, list(enumerate(texts))), path, keep_pieces=False).collect()}
    assert small == rows


def test_bpe_workers_stay_small():
    path, rng = tokenizer_file("word_bpe_49k.json"), random.Random(5)
    tracemalloc.start()
    model = bpe.WordBpe(path)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 80 << 20  # 104 MB with edges listed for each token and the trie kept twice
    texts = [" ".join("".join(rng.choices("abcdeé1-", k=rng.randint(1, 9))) for _ in range(30)) for _ in range(60)]
    expected = list(bpe.encode_batch(model, texts))
    model.forget()
    model.most_pieces, model.most_pairs = 100, 50
    found = []
    for text in texts:
        found += bpe.encode_batch(model, [text], 1)
        assert len(model.cache) <= 130 and len(model._apart) <= 51
    assert found == expected


def test_fertility_base_measures(spark):
    rng = random.Random(4)
    texts = [t for _, t in copy_documents(4)]
    texts += ["a\nb\na\n\n \na\n b", "* # $ %& | <>", "é ü 中 文\n\né ü 中 文", " ".join(prose(rng, 20) * 3), " ".join(edited(rng, prose(rng, 9), 2)), "  　x"]
    found = {r["doc_id"]: r for r in fertility.fertility_rules(frame(spark, list(enumerate(texts))), tokenizer_file("piece_bpe_32k.model")).collect()}
    for key, text in enumerate(texts):
        r = found[key]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_fertility_base(text)
        assert not (r["kept"] and r["base_failed"])


def test_fertility_token_measures(spark):
    import math

    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    text = "The quick brown fox 中文字 😀 jumps over the lazy dog and the cat"
    row = fertility.fertility_rules(frame(spark, [(1, text)]), path).first()
    ids = [i for w in words(text) for i in model.encode(w)]
    share = [ids.count(i) / len(ids) for i in set(ids)]
    assert row["n_tokens"] == len(ids)
    assert row["byte_share"] == pytest.approx(sum(model.is_byte(i) for i in ids) / len(ids))
    assert row["token_entropy"] == pytest.approx(-sum(p * math.log2(p) for p in share))


def test_fertility_rejects_noise_and_keeps_prose(spark):
    rng = random.Random(19)
    common = "the of and to in that was his he it with is for as had you not be her on at by which have or from this him but all she they were my are me one their so an said them we who would been will no when there if more out up into do any your what has man could other than our some very time upon about may its only now like little then can made should did us such great before must two these see know over much down after first good own never old without where while people house water light under morning country began against between because through another nothing thought".split()
    english = [" ".join(rng.choice(common) for _ in range(80)) for _ in range(400)]
    noise = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(60)) for _ in range(12)]
    digits = [" ".join(str(rng.randrange(10**8)) for _ in range(60)) for _ in range(12)]
    symbols = [" ".join("".join(rng.choice("#*$%&|<>~^") for _ in range(6)) for _ in range(60)) for _ in range(12)]
    bad = noise + digits + symbols
    rows = list(enumerate(english + bad)) + [(None, english[0]), (0, bad[0]), (900, None), (901, "")]
    path = tokenizer_file("piece_bpe_32k.model")
    found = fertility.fertility_rules(frame(spark, rows).withColumn("script", F.lit("x")), path).collect()
    assert len(found) == len(rows) and not any(r["base_failed"] for r in found if r["doc_id"] is not None and 0 < r["doc_id"] < 900)
    kept = {r["doc_id"] for r in found if r["kept"]}
    assert kept == {None, *range(400)} and sorted(r["kept"] for r in found if r["doc_id"] == 0) == [False, True]
    assert fertility.fertility_rules(frame(spark, []), path).count() == 0
    alone = fertility.fertility_rules(frame(spark, [(1, english[0])]), path).first()  # one text is no evidence against itself
    assert alone["kept"]


def test_pii_patterns(spark):
    rng = random.Random(5)
    pool = list("0123456789") * 2 + list("@@..+-- ()_%ab\n")
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["mail a.b+c@mail-1.example.com, or x@y @z.com q@w.e", "call +49 (30) 1234-5678 now", "4111 1111 1111 1111 and 4111-1111-1111-1112", "1.2.3.4.5.6.7.8 256.1.1.1 010.0.0.1", None, "", "9" * 3000, "a@" * 500 + "b.c"]
    for text in texts:
        got = [(pii.KINDS[k], a, b) for k, a, b in pii.pattern_spans(text or "")]
        assert got == brute_pii(text), text


def test_pii_network(spark):
    rng = random.Random(6)
    import numpy as np

    make = np.random.default_rng(7)
    rows = []
    for k in range(240):
        text = " ".join(prose(rng, 30)).replace("w", "wo").translate(str.maketrans("0123456789", "abcdefghij"))
        rows.append((k, f"{text} {''.join(pii.generated_span(k % 4, make)[i] for i in (1, 0, 2))} {text}" if k % 2 else text))
    docs = frame(spark, [*rows, (None, None), (500, "")])
    model = pii.train(docs)
    texts = [t for _, t in rows]
    base = [set(pii.pattern_spans(t)) for t in texts]
    network = [set(s) for s in pii.network_spans(texts, model)]
    assert sum(len(b & n) for b, n in zip(base, network)) >= 0.9 * sum(map(len, base))
    found = {r["doc_id"]: r for r in pii.find_pii(docs, model).collect()}
    for (key, text), b in zip(rows, base):
        listed = set(filter(None, found[key]["spans"].split(",")))
        assert {f"{pii.KINDS[k]}:{a}:{z}" for k, a, z in b} <= listed
        if not any(c.isdigit() or c == "@" for c in text):
            assert not listed
    assert found[500]["spans"] == "" and found[None]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.mask_pii(docs.withColumn("lang", F.lit("en")), model).collect()}
    assert all(not pii.pattern_spans(masked[k]) for k, _ in rows) and masked[None] is None


def test_pii_network_finds_other_spellings_and_passes_look_alikes_over(spark):
    import numpy as np

    rng, make = random.Random(16), np.random.default_rng(17)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, truth = [], {}
    for k in range(900):
        kind = k % 8
        span, lead, tail = pii.generated_span(kind, make) if kind < 6 else (pii.generated_trap(make), "", "")
        before = line(20) + " " + lead
        rows.append((k, before + span + tail + " " + line(20)))
        truth[k] = (kind, len(before), len(before) + len(span))
    docs = frame(spark, [*rows, *[(3, f"call me {k}@x.de {line(5)}") for k in range(900)], (None, "a@b.de"), (901, None)])  # one hot id
    model = pii.train(docs)
    fresh, hits, wanted, wrong, added = [], 0, 0, 0, 0
    for k in range(600):
        kind = k % 8
        span, lead, tail = pii.generated_span(kind, make) if kind < 6 else (pii.generated_trap(make), "", "")
        before = line(25) + " " + lead
        fresh.append((before + span + tail + " " + line(10), kind, len(before), len(before) + len(span)))
    for (text, kind, a, b), (base, spans) in zip(fresh, pii.all_spans([f[0] for f in fresh], model)):
        extra = [s for s in spans if s not in base]
        assert set(base) <= set(spans) and all(pii.possible(k, text[i:j]) for k, i, j in extra)
        assert all(pii.luhn(pii._digits(text[i:j])) for k, i, j in extra if k == 2)
        wanted += kind < 6
        hits += kind < 6 and any(i < b and j > a for _, i, j in spans)
        added += len(extra)
        wrong += sum(kind >= 6 or not (i < b and j > a) for _, i, j in extra)
    assert hits >= 0.8 * wanted and wrong <= 0.05 * added
    assert len(pii.training_texts(docs, 1000, 16 << 20, "doc_id", "text")) <= 900  # one text of the hot id
    assert len(pii.training_texts(docs, 1000, 2000, "doc_id", "text")) < 20
    assert pii.training_texts(frame(spark, []), 10, 1000, "doc_id", "text") == []


def test_pii_possible_spans():
    right = [(0, "john [at] mail dot com"), (0, "a.b@c.de"), (1, "10 . 0 . 0 . 1"), (1, "2001:db8:0:0:0:0:0:1"), (2, "4111.1111.1111.1111"), (3, "(212) 555-0147"), (3, "030 1234 5678"), (4, "DE89 3704 0044 0532 0130 00"), (5, "hunter2-abc")]
    wrong = [(0, "john at mail"), (1, "4111.1111.1111.1111"), (1, "1.2.3"), (2, "4111 1111 1111 1112"), (3, "2024-01-05"), (3, "1234567890"), (3, "886.568.896.791"), (4, "DE89 3704 0044 0532 0130 01"), (5, "aaaaaaaaaa"), (5, "two words")]
    assert all(pii.possible(*r) for r in right) and not any(pii.possible(*w) for w in wrong)


def test_pii_stretches_cover_whole_words():
    rng = random.Random(18)
    pool = list("abcdefgh    ") * 6 + ["7", "@", " dot ", " [at] ", "password: ", "\n"]
    for _ in range(400):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(700)))
        parts = pii.stretches(text)
        covered = {c for a, b in parts for c in range(a, b)}
        for m in pii._TRIGGER.finditer(text):
            assert set(range(max(0, m.start() - pii.REACH), min(len(text), m.end() + pii.REACH))) <= covered
        assert all(b <= c for (_, b), (c, _) in zip(parts, parts[1:])) and all(a < b for a, b in parts)
        for a, b in parts:
            assert a == 0 or text[a - 1].isspace() or a in {e for _, e in parts}
            assert b == len(text) or text[b].isspace()
    assert pii.stretches("x" * 5000 + "1" + "y" * 5000) == [(0, 10001)] and pii.stretches("") == []


def test_quality(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(prose(rng, 60)) if k % 4 else " ".join(f"w{rng.randrange(4000)}***" for _ in range(60))) for k in range(600)]
    docs = frame(spark, [*rows, (700, None), (701, ""), (702, "x " * 30_000)])
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k, _ in rows if k % 2] + [(k, int(k % 4 > 0)) for k, _ in rows if k % 4 == 0] + [(3, None)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.col("doc_id") % 5 != 0)
    scored = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, model).collect()}
    assert len(scored) == 603 and all(0 <= s <= 1 for s in scored.values())
    assert all((scored[k] >= 0.5) == bool(k % 4) for k, _ in rows if k % 5 == 0)
    nothing = quality.train(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.quality_scores(docs, nothing).collect()} == {0.5}


def test_language(spark):
    rng = random.Random(9)
    syllables = {"aa": ["ka", "ku", "ti"], "bb": ["sch", "eit", "ung"], "cc": ["eau", "oir", "ment"]}
    rows = [(k, " ".join("".join(rng.choices(s, k=3)) for _ in range(20)), lang) for k in range(450) for lang, s in [list(syllables.items())[k % 3]]]
    docs = frame(spark, [*rows, (900, None, "aa"), (901, "123 !?", None), (902, "", "bb")], "doc_id long, text string, lang string")
    model = language.train(docs, F.col("doc_id") % 3 != 7, train_rows=300)
    found = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert sum(found[k]["lang_pred"] == lang for k, _, lang in rows) >= 0.97 * len(rows)
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in (900, 901, 902))
    unknown = language.train(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r["lang_pred"] for r in language.identify(docs, unknown).collect()} == {"und"}


def test_mixing(spark):
    rng = random.Random(10)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 80)), rng.choice(["a", "a", "a", "b", "Z", None])) for k in range(900)]
    docs = frame(spark, [*rows, (2000, None, "a"), (2001, "", "b")], "doc_id long, text string, source string").withColumn("target", F.lit("mine"))
    mixed = mixing.mixture(docs).cache()
    taken, total = {}, {}
    for _, text, source in rows:
        total[source] = total.get(source, 0) + len(words(text))
    copies = {}
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    order = ["Z", "a", "b", None]
    target = dict(zip(order, mixing.targets([total[s] for s in order], [3, 1, 2, 3])))
    assert max(copies.values()) <= 2
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s], s
    assert sorted(mixed.collect(), key=str) == sorted(mixing.mixture(docs.repartition(5)).select(*mixed.columns).collect(), key=str)
    sizes = [n for _, n in sorted((r["shard"], r["count"]) for r in mixed.groupBy("shard").count().collect())]
    assert len(sizes) > 1
    assert mixing.mixture(docs.limit(0)).count() == 0


def test_mixing_keeps_columns_with_inner_names(spark):
    rows = [(k, "a b c", "s" if k % 2 else "t", f"p{k}", f"b{k}", f"n{k}", f"c{k}") for k in range(40)]
    docs = frame(spark, rows, "doc_id long, text string, source string, place string, block string, source_no string, target string")
    mixed = mixing.mixture(docs).collect()
    assert mixed and {tuple(r[c] for c in docs.columns) for r in mixed} <= set(rows)
    sized = docs.withColumn("size", F.lit(3).cast("long"))
    assert mixing.mix(sized).columns == ["doc_id", "text", "source", "place", "block", "source_no", "size", "source_size", "target", "copies"]


def test_targets_reshare_excess():
    assert mixing.targets([10, 100, 10], [3, 1, 2]) == [20.0, 140.0, 20.0]
    assert mixing.targets([], []) == []
    assert sum(mixing.targets([5, 0, 7], [3, 1, 2])) == pytest.approx(18)


def test_hashes_of_large_chunks_are_those_of_small_ones():
    text = " ".join(f"w{k % 977}" for k in range(900_000)) + " " + "x" * (3 << 20) + " end"
    words = textops.Words(pa.array([text, "w5 end", "x" * (3 << 20)]))
    assert len(words.raw) > 2 * textops.CHUNK_BYTES
    hashes = words.hashes()
    assert (hashes[5], hashes[900_001]) == tuple(hashes[-3:-1]) and hashes[900_000] == hashes[-1]
    assert len(np.unique(hashes)) == 977 + 2
