"""Quality, packing, language ID, fingerprints and BPE."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, fingerprints, langid, packing, quality, queries
from tallyhouse.llm.common import tokenizer
from tests.llm import cases

tokenizers = pytest.importorskip("tokenizers")
SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def strange_texts():
    rng = random.Random(7)
    signs = "ab '\n\tst.é1İΣ日 m'ld reve\u0085 "
    fixed = [
        "don't I'll we've 'sad '' 's !'s it's's", "x  y \n\n z\t", "aaaa aaaaaaa",
        "a<|endoftext|> b <|startoftext|>c<|endoftext|>", "ΣΑΣ é é ǅ ẞ", "12a½ ٣٤", "\r\n\r\n a\x00b",
    ]
    return fixed + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(500)]


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_encoding_equals_the_library(name):
    path = tokenizer(name)
    texts = [t or "" for t in cases.odd_texts()] + strange_texts()
    expected = tokenizers.Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    ids, bounds = bpe.encode(pa.array(texts), path).document_ids()
    for i, one in enumerate(expected):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == one.ids, texts[i]


def test_merging_alternates_in_runs_of_one_sign():
    path = tokenizer(BYTE)
    library = tokenizers.Tokenizer.from_file(path)
    texts = ["=" * n for n in range(1, 70)] + ["aaa" * n for n in range(20)]
    ids, bounds = bpe.encode(pa.array(texts), path).document_ids()
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text).ids


def test_round_trip_of_odd_documents(spark):
    docs = cases.odd_documents(spark, ids="clash", n_tokens=3)
    library = tokenizers.Tokenizer.from_file(tokenizer(BYTE))
    found = bpe.round_trip(docs, tokenizer(BYTE)).collect()
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((r.doc_id, len(ids), ",".join(map(str, ids)), decoded))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    hashed = {tuple(r) for r in bpe.digests(docs, tokenizer(BYTE)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert hashed == {(i, n, sha(a), sha(b)) for i, n, a, b in expected}


def check_pieces(pieces, docs, window):
    library = tokenizers.Tokenizer.from_file(tokenizer(WORD))
    of_doc, of_sequence = {}, {}
    for p in pieces:
        of_doc.setdefault(p.doc_id, []).append(p)
        of_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(of_doc[doc_id], key=lambda p: p.start):
            held = np.frombuffer(p.ids, "<u4").tolist()
            assert (p.start, p.doc_tokens, p.length) == (at, len(ids), len(held))
            assert held == ids[at : at + p.length]
            at += p.length
        assert at == len(ids)
    part_full = {}
    for sequence, held in of_sequence.items():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        if at < window:
            part_full[sequence >> 40] = part_full.get(sequence >> 40, 0) + 1
    assert all(n == 1 for n in part_full.values())


@pytest.mark.parametrize("most_open", [packing.MOST_OPEN, 3])
def test_every_token_is_packed_once(spark, most_open):
    docs = [(i, t) for i, t in enumerate(cases.odd_texts())]
    docs += [(100 + i, cases.prose(i, 5 + i)) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("ids", F.lit(1))
    pieces = packing.pack(df.repartition(3), tokenizer(WORD), window=256, most_open=most_open)
    check_pieces(pieces.collect(), docs, 256)


def test_the_level_with_the_least_sum_of_squares_is_taken():
    rng = np.random.default_rng(0)
    packer = packing.Packer(16)
    for _ in range(300):
        size = int(rng.integers(1, 16))

        def after(level, size=size):
            counts = packer.counts.copy()
            if level:
                counts[level] -= 1
            if level + size < 16:
                counts[level + size] += 1
            return (counts**2).sum()

        fits = [0, *[h for h in range(1, 17 - size) if packer.counts[h]]]
        best = packer.best_level(size)
        assert best in fits and after(best) == min(map(after, fits))
        list(packer.place("d", np.arange(size)))
        assert packer.counts.tolist() == [len(x) for x in packer.open]


def test_packing_query_digests(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op2_packing(spark, SF).collect()
    library = tokenizers.Tokenizer.from_file(tokenizer(WORD))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows[:200]:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]
        piece = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(piece)


def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op1_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    known = [r for r in rows if labels.get(r.doc_id) is not None]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    good = [r.score for r in known if labels[r.doc_id] == 1 and r.held_out]
    bad = [r.score for r in known if labels[r.doc_id] == 0 and r.held_out]
    wins = sum(a > b for a in good for b in bad)
    assert wins >= 0.95 * len(good) * len(bad)


def test_quality_of_odd_documents_and_labels(spark):
    docs = cases.odd_documents(spark, score="clash", y=1)
    labels = spark.createDataFrame(
        [(8, 1), (8, 0), (9, None), (None, 1), (19, 0), (77, 1)], "doc_id long, quality int"
    )
    weights = quality.train(docs, labels, "quality", shards=1)
    rows = quality.score(docs, weights).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (0, 1)}
    assert len(empty) == 1
    none = quality.train(docs, labels.limit(0), "quality")
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), weights).count() == 0


def test_sparse_scores_are_dot_products(spark):
    text = "a b b b. c"
    found, bounds = quality.grams(pa.array([text, None, ""]))
    weights = np.random.default_rng(0).normal(size=(1 << quality.BITS) + 1)
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    at, x = quality._sparse(found[bounds[0] : bounds[1]])
    assert rows[1] == pytest.approx(1 / (1 + np.exp(-(weights[at] @ x + weights[-1]))))
    assert rows[2] == pytest.approx(1 / (1 + np.exp(-weights[-1])))


def test_held_out_languages(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_langid(spark, SF).collect()
    assert len(rows) == len(docs)
    known = [r for r in rows if r.held_out and docs[r.doc_id] is not None]
    assert sum(r.lang_pred == docs[r.doc_id] for r in known) >= 0.97 * len(known)
    assert all(0 <= r.score <= 1 for r in rows)


def test_kernel_equals_sets_of_ngrams():
    texts = ["Über  den Wolken!", "x", "don't"]
    signs, bounds, has = langid.folded(pa.array(texts))
    assert has.all()
    for i, (_, bits) in enumerate(langid.bitmaps(pa.array(texts))):
        own = signs[bounds[i] : bounds[i + 1] + 1].tolist()
        grams = set()
        for n, base in ((3, 0), (2, langid.SIGNS**3), (1, langid.SIGNS**3 + langid.SIGNS**2)):
            for j in range(len(own) - n + 1):
                code = 0
                for sign in own[j : j + n]:
                    code = code * langid.SIGNS + sign
                grams.add(base + code)
        assert set(np.flatnonzero(bits).tolist()) == grams


def test_languages_of_odd_documents(spark):
    docs = cases.odd_documents(spark, rank=1, grams="clash", score=2)
    model = langid.train(docs)
    rows = langid.predict(docs, model).collect()
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (r.doc_id not in letters)
            assert r.lang_pred != "und" or r.score == 0
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {None} == letters - {None}
    unlearned = langid.train(docs.where("lang = 'none'"))
    assert unlearned is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.keep_known(docs, None).count() == 0


def test_missing_languages_are_filled_where_a_text_is_accepted(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null")
    model = langid.train(known.where("doc_id % 2 = 0"))
    seen = known.where("doc_id % 2 = 1 and length(text) > 200")
    truth = {r.doc_id: r.lang for r in seen.collect()}
    odd = [(-1, "日本語 のテキスト こんにちは", None), (-2, "日本語", "ja"), (-3, "12 !", None), (-4, None, None)]
    texts = seen.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    docs = texts.unionByName(spark.createDataFrame(odd, texts.schema)).repartition(3)
    found = {r.doc_id: r.lang for r in langid.keep_known(docs, model).collect()}
    assert found.pop(-1, "") is None and found.pop(-2) == "ja"
    assert set(found) == {r.doc_id for r in seen.where("text rlike '[a-zA-Z]'").collect()}
    assert sum(found[i] == truth[i] for i in found) >= 0.95 * len(found)
    assert sum(found[i] not in (truth[i], None) for i in found) <= 0.02 * len(found)


def test_languages_that_the_text_contradicts_are_replaced(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and length(text) > 200")
    model = langid.train(known.where("doc_id % 2 = 0"))
    wrong = known.where("doc_id % 2 = 1 and lang <> 'en'")
    truth = {r.doc_id: r.lang for r in wrong.collect()}
    for given in ("en", "xx"):
        found = {r.doc_id: r.lang for r in langid.keep_known(wrong.withColumn("lang", F.lit(given)), model).collect()}
        assert set(found) == set(truth)
        assert sum(found[i] == truth[i] for i in truth) >= 0.95 * len(truth)
    right = {r.doc_id: r.lang for r in langid.keep_known(known, model).collect()}
    assert sum(right[r.doc_id] != r.lang for r in known.collect()) <= 0.01 * len(right)


def test_pieces_have_the_language_of_their_document(spark):
    docs = [(i, cases.prose(i, 40 * i), lang) for i, lang in enumerate(["en", None, "de", "fr"])]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    pieces = packing.pack(df, tokenizer(WORD), window=64, keep=["lang"]).collect()
    assert {(r.doc_id, r.lang) for r in pieces} == {(i, lang) for i, _, lang in docs}
    check_pieces(pieces, [(i, t) for i, t, _ in docs], 64)


def test_training_rows_are_bounded_for_repeated_ids(spark, monkeypatch):
    rows = [(i, f"{cases.prose(i, 20)} {k}", "en") for i in range(12) for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    taken, kind = [], type(docs)
    for name in ("toPandas", "collect"):
        call = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda df, f=call: taken.append(f(df)) or taken[-1])
    assert langid.train(docs, per_lang=5) is not None
    sample = next(t for t in taken if hasattr(t, "columns"))
    assert len(sample) == sample.doc_id.nunique() == 5
    taken.clear()
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    quality.train(docs, labels, "quality", train_rows=8)
    assert sum(r.n for t in taken if isinstance(t, list) for r in t) == 8


def shingles(text):
    words = [w for w in (text or "").split() if w]
    return {tuple(words[max(0, i - 4) : i + 1]) for i in range(len(words))}


def test_fingerprints_of_odd_documents(spark):
    docs = cases.odd_documents(spark, sketch="clash", next=1, bucket=1)
    rows = fingerprints.fingerprints(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        exact = len(shingles(r.text))
        assert len(r.sketch) == min(exact, fingerprints.K) and r.sketch == sorted(r.sketch)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.sketch) == r.sketch


def test_estimates_against_sets(spark):
    base = cases.prose(1, 900)
    texts = [base, cases.edited(base, 1, 30), base[: len(base) // 2], cases.prose(2, 700), "a b", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    f = fingerprints.fingerprints(df)
    a, b = f.select("doc_id", F.col("sketch").alias("a")), f.select(
        F.col("doc_id").alias("other"), F.col("sketch").alias("b")
    )
    rows = (
        a.join(b, F.col("doc_id") <= F.col("other"))
        .select(
            "doc_id", "other",
            fingerprints.resemblance("a", "b").alias("r"),
            fingerprints.containment("a", "b").alias("c"),
            fingerprints.distinct_shingles("a").alias("n"),
            fingerprints.merged("a", "b").alias("m"),
        )
        .collect()
    )
    for r in rows:
        x, y = shingles(texts[r.doc_id]), shingles(texts[r.other])
        real = len(x & y) / len(x | y) if x | y else 1.0
        assert r.r == pytest.approx(real, abs=0.2)
        assert r.n == pytest.approx(len(x), rel=0.4, abs=0.5)
        assert r.c == pytest.approx(len(x & y) / len(x) if x else 1.0, abs=0.3)
        assert len(r.m) == min(fingerprints.K, len(x | y))


@pytest.mark.parametrize("rows", [1, 2, 2048])
def test_next_document(spark, rows):
    ids = [None, 5, 5, 9, 1000, 1001, 1002, 5000, -3, -4]
    docs = spark.createDataFrame(
        [(i, f"t{n}") for n, i in enumerate(ids)], "doc_id long, text string"
    ).repartition(3)
    found = fingerprints.with_next(fingerprints.fingerprints(docs), rows=rows).collect()
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text))
    expected = {a.text: b.text for a, b in zip(order, order[1:] + order[:1], strict=True)}
    assert {r.text: r.next.text for r in found} == expected
    assert len(found) == len(ids)


def test_fingerprint_query(spark):
    rows = queries.op9_fingerprints(spark, SF).collect()
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for one, two in zip(docs, docs[1:] + docs[:1], strict=True):
        a, b = one.text or "", two.text or ""
        cut = len(a) // 4
        changed = a[: len(a) - cut] + b[:cut]
        r = by_id[one.doc_id]
        assert r.n_chars == len(a)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        x, y = shingles(a), shingles(changed)
        assert r.near_edited == pytest.approx(len(x & y) / len(x | y) if x | y else 1, abs=0.3)


def test_fingerprints_run_no_python(spark):
    text = queries.op9_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in text for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_empty_documents(spark):
    docs = cases.odd_documents(spark).limit(0)
    assert bpe.round_trip(docs, tokenizer(BYTE)).count() == 0
    assert packing.pack(docs, tokenizer(WORD)).count() == 0
    assert langid.train(docs) is None
    assert fingerprints.with_next(fingerprints.fingerprints(docs)).count() == 0
