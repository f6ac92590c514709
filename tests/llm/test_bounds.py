"""What keeps samples, graphs and staged rounds bounded, and a plain counterpart of the ridge regression."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import embeddings, langid
from tallyhouse.llm.components import components
from tests.llm import cases
from tests.llm.test_pair_operators import brute_vectors, planted_vectors


def test_the_sample_of_a_language_is_cut_by_hash_before_it_is_ranked(spark):
    ids = spark.range(0, 40_000, 1, 16).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 400 == 0, "rare").otherwise("hot").alias("lang")
    )
    cut = langid._least_hashes(ids, 50).cache()
    sizes = {r.lang: r["count"] for r in cut.groupBy("lang").count().collect()}
    assert sizes["rare"] == 100  # fewer than four times 50: all
    assert 120 < sizes["hot"] < 300
    hashed = F.xxhash64("doc_id")
    for lang in sizes:
        least = [r.doc_id for r in ids.where(F.col("lang") == lang).orderBy(hashed).limit(50).collect()]
        found = [r.doc_id for r in cut.where(F.col("lang") == lang).orderBy(hashed).limit(50).collect()]
        assert found == least


def ngrams(text):
    plain = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    folded = " ".join(["", *plain.split(), ""])
    return {folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)}


def test_ridge_regression_equals_its_dual_over_sets_of_ngrams(spark):
    """With every row a landmark, Nyström features span the kernel, and ridge regression on them is kernel ridge
    regression: a bias column adds one to the kernel."""
    texts = [(i, cases.prose(40 + i % 3, 30 + i, 60), "abc"[i % 3]) for i in range(24)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    model = langid.train(docs, landmarks=100, ridge=0.1)
    asked = [cases.prose(40 + i, 25, 60) for i in range(3)] + ["one", "q w"]
    sets, queries = [ngrams(t) for _, t, _ in texts], [ngrams(t) for t in asked]

    def kernel(a, b):
        return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])

    target = np.array([[1.0 if lang == one else -1.0 for one in "abc"] for _, _, lang in texts])
    alpha = np.linalg.solve(kernel(sets, sets) + 1 + 0.1 * np.eye(len(texts)), target)
    plain = (kernel(queries, sets) + 1) @ alpha
    shares = np.exp(4 * plain)
    shares /= shares.sum(axis=1, keepdims=True)
    rows = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    found = {r.doc_id: r for r in langid.predict(rows, model).collect()}
    for i in range(len(asked)):
        assert found[i].lang_pred == "abc"[plain[i].argmax()]
        assert abs(found[i].score - shares[i].max()) < 1e-4


def test_ngrams_do_not_depend_on_the_texts_around():
    texts = ["a.", "one", "", "b ,", None, "...", " two! ", "x"]
    alone = [next(langid.bitmaps(pa.array([t], pa.string())))[1].copy() for t in texts]
    together = [bits.copy() for _, bits in langid.bitmaps(pa.array(texts, pa.string()))]
    assert all((a == b).all() for a, b in zip(alone, together, strict=True))


@pytest.mark.parametrize("copies", [1, 2])
def test_queries_stream_past_few_copies_of_a_graph(spark, monkeypatch, copies):
    monkeypatch.setattr(embeddings, "QUERIES", 7)
    vectors = planted_vectors()
    rows = [(i, v.tolist(), i % 2 if i >= 200 else 0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    found = embeddings.near_duplicates(df, shard=40, queries=30, copies=copies, block=9).collect()
    assert {r.vec_id: (r.component_id, r.n_links) for r in found} == brute_vectors(rows, 0.98)


def test_tasks_are_bounded_by_the_cores(spark):
    most = embeddings.TASKS * spark.sparkContext.defaultParallelism
    dealt = embeddings._by_group(spark.range(10), "id", 10**9)
    assert dealt.rdd.getNumPartitions() <= most


def test_components_keep_only_the_last_round(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    found = components(spark.createDataFrame([(i, i + 1) for i in range(64)], "u long, v long"))
    assert {r.component for r in found.collect()} == {0}
    assert len(set(os.listdir(root)) - before) == 1
