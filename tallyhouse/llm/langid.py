"""Language ID by string kernels.

The kernel of two texts is the number of n-grams (n = 1, 2, 3) that both contain, over
the root of the product of their own numbers: a blended spectrum kernel on presence. The
alphabet is folded by a fixed rule: a to z stand for themselves, every other letter falls
into one of 69 classes by its lower-case code point, a run of anything else is one blank. So
the n-grams of any script are numbers below ``GRAMS``, and the n-grams of a text a bitmap.

Kernel ridge regression, one language against the rest, is fitted on Nyström features of
a bounded sample: ``per_lang`` texts of each language (at most ``most_rows`` in all), of
which the first ``landmarks`` of each language are the landmarks; of rows with equal ids one is
taken, of the least language and then the text with the least hash. The landmarks' n-grams and the
kernel values of the sample come to the driver, other n-grams don't. A batch of texts is scored by
two matrix products: bitmaps with the landmarks' bitmaps, and kernel values with the weights.

Null texts and texts without a letter are ``und`` with score 0. ``keep_known`` drops them, fills in
languages that are missing and replaces those that the text contradicts. Rows without a language are
scored and not learned from. Repeated rows are scored alike, other columns are left out; if
nothing can be learned from, every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.common import staged
from tallyhouse.operators.joins import join_by_key

SIGNS = 96
GRAMS = SIGNS**3 + SIGNS**2 + SIGNS
UNKNOWN = "und"
PIECE = 2 << 20
ROWS = 128  # texts in one product
SPARE = 4


def folded(column: pa.Array):
    """Alphabet classes of all texts, with a blank before and after each text, the
    bounds of each text, and whether it has a letter."""
    points, offsets = tx.code_points(*tx.utf8(column))
    points = tx.lower()[points]
    letter = tx.classes()[points] == tx.LETTER
    signs = np.where(letter, 27 + points * np.uint32(2654435761) // np.uint32(1 << 20) % 69, 0)
    plain = (points >= 97) & (points <= 122)
    signs[plain] = points[plain] - 96
    padded = np.insert(signs, np.r_[offsets[:-1], offsets[-1]], 0)
    bounds = offsets + np.arange(len(offsets))
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    before = tx.offsets_of(keep)
    has = np.diff(tx.offsets_of(letter)[offsets]) > 0
    # a text may end in blanks, of which only the first is kept: both bounds lie on the one that is
    return padded[keep].astype(np.int64), before[bounds + 1] - 1, has


def bitmaps(column: pa.Array):
    """For each text in turn: whether it has a letter, and a bitmap of its n-grams
    (the same array each time)."""
    signs, bounds, has = folded(column)
    pairs = signs[:-1] * SIGNS + signs[1:]
    triples = pairs[:-1] * SIGNS + signs[2:]
    bitmap = np.zeros(GRAMS, bool)
    for i in range(len(has)):
        a, b = int(bounds[i]), int(bounds[i + 1])
        bitmap[:] = False
        if has[i]:
            # up to and with the blank behind the text
            bitmap[triples[a : b - 1]] = True
            bitmap[SIGNS**3 + pairs[a:b]] = True
            bitmap[SIGNS**3 + SIGNS**2 + signs[a : b + 1]] = True
        yield bool(has[i]), bitmap


@dataclass
class Model:
    languages: list[str]
    columns: np.ndarray  # n-grams of the landmarks
    landmarks: np.ndarray  # bitmap columns x landmarks
    roots: np.ndarray  # root of each landmark's number of n-grams
    weights: np.ndarray  # landmarks + bias x languages
    familiar: float  # least kernel with any landmark of a text that may be named


def _kernels(batch: pa.RecordBatch, columns: np.ndarray, landmarks: np.ndarray, roots: np.ndarray):
    """(rows, kernel values with the landmarks) of the texts with a letter, ``ROWS`` at a time."""
    block = np.zeros((min(ROWS, batch.num_rows), len(columns)), np.float32)
    own = np.ones(len(block))
    held: list[int] = []
    for i, (has, bits) in enumerate(bitmaps(batch.column("text"))):
        if has:
            block[len(held)] = bits[columns]
            own[len(held)] = np.count_nonzero(bits)
            held.append(i)
        if held and (len(held) == len(block) or i == batch.num_rows - 1):
            n = len(held)
            yield held, block[:n] @ landmarks / np.sqrt(own[:n, None]) / roots
            held = []


def _least_hashes(ids: DataFrame, per_lang: int) -> DataFrame:
    """The rows (doc_id, lang) with the least hashes, about ``SPARE`` times ``per_lang`` of each language: a window
    over them stays small whatever the number of tasks and rows. Fewer than ``per_lang`` are left
    only where a language has fewer."""
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    share = F.least(F.lit(1.0), F.lit(float(SPARE * per_lang)) / F.col("size"))
    least = F.xxhash64("doc_id").cast("double") <= share * F.lit(2.0**64) - F.lit(2.0**63)
    return join_by_key(ids, sizes, ["lang"]).where(least).select("doc_id", "lang")


def train(
    docs: DataFrame,
    *,
    per_lang: int = 250,
    most_rows: int = 16000,
    landmarks: int = 24,
    ridge: float = 0.1,
) -> Model | None:
    """Fit on rows with a language and a text; see the module for the bounds."""
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    usable = docs.where("lang is not null and doc_id is not null and text is not null")
    ids = usable.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    chosen = (
        _least_hashes(ids, per_lang)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= per_lang)
        .orderBy("rank", "lang")
        .limit(most_rows)
        .select("doc_id", "lang", "rank")
    )
    # at most most_rows ids are broadcast, and one text of each goes on
    sample = staged(
        usable.select("doc_id", "text", "lang")
        .join(F.broadcast(chosen), ["doc_id", "lang"])
        .groupBy("doc_id", "lang", "rank")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    kind = sample.schema["doc_id"].dataType.simpleString()

    def lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            has = pa.array(folded(batch.column("text"))[2])
            yield batch.select(["doc_id", "lang", "rank"]).filter(has)

    # lang and rank name a text; at most most_rows of them
    names = sample.mapInArrow(lettered, f"doc_id {kind}, lang string, rank int").toPandas()
    names = names.sort_values(["rank", "lang"], ignore_index=True)
    if not len(names):
        return None
    languages = sorted(names.lang.unique())
    marks = names[names.groupby("lang").cumcount() < landmarks]
    columns, held, roots = _landmarks(sample, marks)
    shared = docs.sparkSession.sparkContext.broadcast((columns, held, roots))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            for at, kernel in _kernels(batch, *shared.value):
                rows = batch.select(["lang", "rank"]).take(pa.array(at))
                values = pa.array(list(kernel), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, values], ["lang", "rank", "kernel"])

    found = sample.mapInArrow(compare, "lang string, rank int, kernel array<double>").toPandas()
    found = found.sort_values(["rank", "lang"], ignore_index=True)
    kernel = np.stack(found.kernel)
    values, vectors = np.linalg.eigh(kernel[marks.index])
    good = values > 1e-8 * values.max()
    project = vectors[:, good] / np.sqrt(values[good])
    features = np.c_[kernel @ project, np.ones(len(kernel))]
    target = np.where(found.lang.to_numpy()[:, None] == np.array(languages), 1.0, -1.0)
    gram = features.T @ features + ridge * np.eye(features.shape[1])
    beta = np.linalg.solve(gram, features.T @ target)
    weights = np.r_[project @ beta[:-1], beta[-1:]]
    # half of what all but a hundredth of the sample's other texts reach
    others = np.delete(kernel, marks.index, axis=0).max(axis=1)
    familiar = float(np.quantile(others, 0.01)) / 2 if len(others) else 0.0
    return Model(languages, columns, held, roots, weights, familiar)


def _landmarks(sample: DataFrame, marks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams of the landmarks, their bitmaps as columns, and the roots of their numbers; ``marks`` are the
    landmarks' (lang, rank), in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            grams = [np.flatnonzero(bits).astype(np.int32) for _, bits in bitmaps(batch.column("text"))]
            rows = [batch.column("lang"), batch.column("rank"), pa.array(grams, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(rows, ["lang", "rank", "grams"])

    pairs = [(str(lang), int(rank)) for lang, rank in zip(marks.lang, marks["rank"], strict=True)]
    wanted = sample.sparkSession.createDataFrame(pairs, "lang string, rank int")
    lists = (
        sample.join(F.broadcast(wanted), ["lang", "rank"])
        .mapInArrow(run, "lang string, rank int, grams array<int>")
        .toPandas()
        .sort_values(["rank", "lang"], ignore_index=True)
        .grams.to_list()
    )
    columns = np.unique(np.concatenate(lists))
    held = np.zeros((len(columns), len(lists)), np.float32)
    for i, grams in enumerate(lists):
        held[np.searchsorted(columns, grams), i] = 1
    return columns, held, np.sqrt([len(grams) for grams in lists])


def _classify(batch: pa.RecordBatch, m: Model) -> tuple[np.ndarray, ...]:
    """Index of each row's language (the number of languages: unknown), its score, whether the
    text is accepted as such: the language's own regression says so (a value above 0; -1 stands for the
    rest), and some landmark is similar enough; and the values of all regressions (-1 without a letter)."""
    every = np.full((batch.num_rows, len(m.languages)), -1.0)
    best, score = np.full(batch.num_rows, len(m.languages)), np.zeros(batch.num_rows)
    accepted = np.zeros(batch.num_rows, bool)
    for at, kernel in _kernels(batch, m.columns, m.landmarks, m.roots):
        values = every[at] = kernel @ m.weights[:-1] + m.weights[-1]
        shares = np.exp(4 * (values - values.max(axis=1, keepdims=True)))
        best[at], score[at] = values.argmax(axis=1), 1 / shares.sum(axis=1)
        accepted[at] = (values.max(axis=1) > 0) & (kernel.max(axis=1) >= m.familiar)
    return best, score, accepted, every


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    if model is None:
        return source.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the landmarks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UNKNOWN], object)
        for batch in tx.slices(batches, PIECE):
            best, score, _, _ = _classify(batch, shared.value)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array(names[best], pa.string()),
                    "score": pa.array(score),
                }
            )

    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents, with all of their columns, whose text has a language of the model;
    ``und`` goes. ``lang`` becomes the predicted language if the text is accepted as such and is not one of the
    language that ``lang`` names: that is null, unknown to the model, or refused by its own regression.
    Otherwise it stays (null for a script the model has not seen). In one narrow pass."""
    if model is None:
        return docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the landmarks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, None], object)
        for batch in tx.slices(batches, PIECE):
            best, _, accepted, values = _classify(batch, shared.value)
            at = batch.schema.get_field_index("lang")
            field = batch.schema.field(at)
            given = pc.index_in(batch.column(at), value_set=pa.array(names[:-1], field.type))
            place = pc.fill_null(given, -1).to_numpy(zero_copy_only=False)
            refused = (place < 0) | (values[np.arange(len(place)), place] <= 0)
            named = pa.array(names[best], field.type)
            lang = pc.if_else(pa.array(accepted & refused), named, batch.column(at))
            kept = batch.set_column(at, field, lang)
            yield kept.filter(pa.array(best < len(shared.value.languages)))

    return docs.mapInArrow(run, docs.schema)
