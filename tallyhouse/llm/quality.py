"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

A text becomes tokens (runs of letters, single-script or not, of digits and of other
signs, in lower case); a token equal to the one before it counts as a repeat, whatever
the word. Runs of one to ``orders`` tokens are hashed into 2**bits buckets, and the
feature vector is the share of each bucket among the text's n-grams.

Training follows the regularised leader with per-coordinate rates. A bounded sample of
labelled rows (``train_rows``, the ones with the smallest hash of their id) is
dealt over ``shards`` tasks; each runs FTRL-proximal over its rows, and the weights are
averaged. Scoring is a sparse dot product per text, in one narrow pass.

Null and empty texts have no n-grams and get the score of the bias. Rows with a null
label, or without a document, are not learned from; several labels of one document
count as their largest; of several texts of one document the one with the least hash is
learned from. Repeated documents are scored alike. Other columns are left
out. Without labels of both kinds every score is that of untrained weights, 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx

BITS = 18
ORDERS = 2
SCALE = 30.0  # of the shares, so that a weight of a few units decides
PIECE = 4 << 20
_SALT = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def grams(column: pa.Array, bits: int = BITS, orders: int = ORDERS):
    """Buckets of all n-grams of all texts, and the bounds of each text's."""
    points, offsets = tx.code_points(*tx.utf8(column))
    points = tx.lower()[points]
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = tx.classes()[points]
    cut = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], n]
    inside = kind[starts] != tx.SPACE
    starts, ends = starts[inside], ends[inside]
    first = np.searchsorted(starts, offsets)
    token = tx.span_hashes(points, starts, ends)
    repeat = np.r_[False, token[1:] == token[:-1]]
    repeat[first[:-1][first[:-1] < len(token)]] = False
    token[repeat] = _SALT
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    parts, owners, run = [token], [owner], token
    for order in range(2, orders + 1):
        run = tx.mix((run[:-1] ^ np.uint64(order)) * _SALT + token[order - 1 :])
        same = owner[: len(run)] == owner[order - 1 :]
        parts.append(run[same])
        owners.append(owner[: len(run)][same])
    buckets = (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64)
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.searchsorted(owners[order], np.arange(len(offsets)))


def _sparse(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    where, counts = np.unique(buckets, return_counts=True)
    return where, counts * (SCALE / max(1, len(buckets)))


class Ftrl:
    """FTRL-proximal for logistic loss; the last weight is the bias."""

    def __init__(self, size: int, alpha=0.5, beta=1.0, l1=0.05, l2=0.1):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.sign(z) * self.l1 - z
        return np.where(
            np.abs(z) <= self.l1, 0.0, pull / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        )

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.r_[at, len(self.z) - 1], np.r_[x, 1.0]
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    train_rows: int = 16384,
    shards: int = 4,
    epochs: int = 3,
    bits: int = BITS,
    orders: int = ORDERS,
) -> np.ndarray:
    """Weights learned from at most ``train_rows`` labelled documents."""
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    # at most train_rows ids are broadcast, and one text of each goes on
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "_y")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            found, bounds = grams(batch.column("text"), bits, orders)
            pairs = [_sparse(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "y": batch.column("_y"),
                    "at": pa.array([p[0] for p in pairs], pa.list_(pa.int64())),
                    "x": pa.array([p[1] for p in pairs], pa.list_(pa.float64())),
                }
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    vectors = rows.mapInArrow(features, f"doc_id {kind}, y int, at array<long>, x array<double>")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        model = Ftrl(1 << bits)
        part = part.sort_values("doc_id")
        random = np.random.default_rng(0)
        share = part.y.mean()
        for _ in range(epochs if 0 < share < 1 else 0):
            for i in random.permutation(len(part)):
                model.update(part["at"].iat[i], part.x.iat[i], part.y.iat[i])
        weights = model.weights().astype("<f4").tobytes()
        return pd.DataFrame({"n": [len(part)], "weights": [weights]})

    # shards * 4 * 2**bits bytes, whatever the input
    models = (
        vectors.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(fit, "n long, weights binary")
        .collect()
    )
    total = np.zeros((1 << bits) + 1)
    for n, weights in models:
        total += n * np.frombuffer(weights, "<f4").astype(float)
    return total / max(1, sum(n for n, _ in models))


def score(docs: DataFrame, weights: np.ndarray, *, orders: int = ORDERS) -> DataFrame:
    """(doc_id, score): the probability of label 1 of every whole text."""
    source = docs.select("doc_id", "text")
    bits = (len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 8 * 2**bits bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in tx.slices(batches, PIECE):
            found, bounds = grams(batch.column("text"), bits, orders)
            sums = np.r_[0.0, np.cumsum(w[found])]
            sizes = np.maximum(1, np.diff(bounds))
            logit = (sums[bounds[1:]] - sums[bounds[:-1]]) * (SCALE / sizes) + w[-1]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array(1 / (1 + np.exp(-np.clip(logit, -35, 35)))),
                }
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, score double")
