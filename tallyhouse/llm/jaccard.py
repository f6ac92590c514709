"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles (all of its words where it has fewer; none
where it has no word). Documents with equal sets are one node with that many copies.

Sets are first embedded into ``SIZE`` min-hashes, each a token that two sets share with
probability equal to their similarity. In each run a set follows paths: a bucket samples one
or two coordinates (on average one over the threshold) from a hash of its own path, and its
sets split by their tokens there. Buckets of one end, small ones are compared by brute force,
larger ones split again, up to ``DEPTH`` times. The chance that a pair at the
threshold meets in a run follows from the branching, and gives the number of runs for the target
recall. Buckets that stay large hold near copies of each other and are compared in pairs of
blocks, so no task holds a whole bucket. Compared sets with near enough min-hashes are
candidates; a bucket passes on a spanning forest of its candidates, not all pairs.

The components of the candidates are then compared exactly, shingle set with shingle set,
again in pairs of blocks: that gives the number of links of each document and a forest of
true links, whose components are the classes. So links are exact within a candidate component.

Null ids come first in the order; rows of equal id and text are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.common import plain, row_key, staged, whole_groups
from tallyhouse.llm.components import components, spread
from tallyhouse.operators.joins import join_by_key

WORDS = 5
THRESHOLD = 0.8
SIZE = 64
DEPTH = 3
SMALL = 32
BLOCK = 512
BLOCK_SHINGLES = 250_000
TARGET = 0.995
PIECE = 2 << 20
KEY = "_set_key"


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, with repeats, and the bounds of each text's."""
    flat, offsets = tx.utf8(column)
    starts, ends, first = tx.words(flat, offsets)
    hashes = tx.span_hashes(flat, starts, ends)
    n_words = np.diff(first)
    counts = np.where(n_words > 0, np.maximum(1, n_words - WORDS + 1), 0)
    begin = tx.ragged(first[:-1], counts)
    length = np.repeat(np.minimum(n_words, WORDS), counts)
    return tx.span_hashes(hashes, begin, begin + length), tx.offsets_of(counts)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, key, node, size, sketch): ``node`` is a hash of the whole set, 0 for none."""
    random = np.random.default_rng(5)
    factors = random.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            found, bounds = shingles(batch.column("text"))
            full = np.flatnonzero(np.diff(bounds))
            least = np.zeros((batch.num_rows, SIZE), "<u4")
            for i, factor in enumerate(factors if len(full) else []):
                values = (found * factor) >> np.uint64(32)
                least[full, i] = np.minimum.reduceat(values, bounds[full])
            nodes = np.zeros(batch.num_rows, np.int64)
            sizes = np.zeros(batch.num_rows, np.int64)
            for i in full.tolist():
                own = np.unique(found[bounds[i] : bounds[i + 1]])
                sizes[i] = len(own)
                whole = tx.mix(np.array([tx.mix(own.copy()).sum() + np.uint64(len(own))]))
                nodes[i] = whole.view(np.int64)[0] or 1
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    KEY: batch.column(KEY),
                    "node": pa.array(nodes),
                    "size": pa.array(sizes),
                    "sketch": pa.array([row.tobytes() for row in least], pa.binary()),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", KEY, "text").mapInArrow(
        run, f"doc_id {kind}, {KEY} long, node long, size long, sketch binary"
    )


def runs_needed(threshold: float, depth: int, target: float) -> tuple[float, int]:
    """The chance of a second coordinate, and the runs until a pair at the threshold has met
    with probability ``target``. A bucket takes one coordinate, or with chance q two."""
    q = 1 / threshold - 1
    met = 1.0
    for _ in range(depth):
        one = threshold * met
        met = (1 - q) * one + q * (1 - (1 - one) ** 2)
    return q, max(1, math.ceil(math.log(1 - target) / math.log(1 - met)))


def _steps(paths: np.ndarray, sketch: np.ndarray, q: float):
    """Rows and child paths of each path: one or two sampled coordinates."""
    seed = tx.mix(paths.copy())
    one = (seed % np.uint64(SIZE)).astype(np.int64)
    two = ((seed >> np.uint64(8)) % np.uint64(SIZE - 1)).astype(np.int64)
    two += two >= one
    twice = np.flatnonzero((seed >> np.uint64(32)).astype(float) < q * 2.0**32)
    rows = np.r_[np.arange(len(paths)), twice]
    at = np.r_[one, two[twice]]
    token = sketch[rows, at].astype(np.uint64) * np.uint64(SIZE) + at.astype(np.uint64)
    child = tx.mix(seed[rows] + tx.mix(token + np.uint64(0x9E3779B97F4A7C15)))
    return rows, child


def _extend(rows: DataFrame, q: float, runs: int = 0) -> DataFrame:
    """(node, path) one level down; with ``runs``, from the roots of that many runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = b"".join(batch.column("sketch").to_pylist())
            sketch = np.frombuffer(data, "<u4").reshape(-1, SIZE)
            nodes = batch.column("node").to_numpy()
            for r in range(max(1, runs)):
                if runs:
                    paths = np.full(len(nodes), tx.mix(np.array([r + 1], np.uint64))[0])
                else:
                    paths = batch.column("path").to_numpy().view(np.uint64)
                at, child = _steps(paths, sketch, q)
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(nodes[at]), "path": pa.array(child.view(np.int64))}
                )

    columns = ["node", "sketch"] if runs else ["node", "sketch", "path"]
    return rows.select(*columns).mapInArrow(run, "node long, path long")


def _buckets(nodes: DataFrame, threshold: float, target: float, small: int) -> DataFrame:
    """(node, path, n): the buckets in which nodes are compared, of n rows each."""
    q, runs = runs_needed(threshold, DEPTH, target)
    open_rows = _extend(nodes, q, runs)
    done = []
    for depth in range(DEPTH):
        rows = open_rows.distinct()
        counted = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        level = staged(join_by_key(rows, counted, ["path"]))
        last = depth == DEPTH - 1
        done.append(level if last else level.where(F.col("n") <= small))
        large = level.where(F.col("n") > small)
        if last or large.isEmpty():
            break
        open_rows = _extend(
            join_by_key(large, nodes.select("node", "sketch"), ["node"]), q
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the labels of linked rows to the smallest."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels != (further := labels[labels])).any():
            labels = further


def _bounds(keys: np.ndarray) -> np.ndarray:
    return np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)]


def _candidates(buckets: DataFrame, nodes: DataFrame, least_equal: int, block: int) -> DataFrame:
    """(u, v): a forest of the pairs in each bucket with at least that many equal tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pair"):
            keys = table.column("pair").to_numpy()
            nodes = table.column("node").to_numpy()
            data = b"".join(table.column("sketch").to_pylist())
            sketch = np.frombuffer(data, "<u4").reshape(-1, SIZE)
            bounds = _bounds(keys)
            ends = np.repeat(bounds[1:], np.diff(bounds))
            partners = ends - np.arange(len(keys)) - 1
            labels = np.arange(len(keys))
            done = np.cumsum(partners)
            low = 0
            while low < len(keys):
                base = done[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(done, base + 100_000, "right")))
                count = partners[low:high]
                a = np.repeat(np.arange(low, high), count)
                b = tx.ragged(np.arange(low, high) + 1, count)
                apart = labels[a] != labels[b]
                a, b = a[apart], b[apart]
                near = (sketch[a] == sketch[b]).sum(axis=1) >= least_equal
                labels = _join_labels(labels, a[near], b[near])
                low = high
            linked = np.flatnonzero((labels != np.arange(len(labels))) & (nodes != nodes[labels]))
            yield pa.RecordBatch.from_pydict(
                {"u": pa.array(nodes[linked]), "v": pa.array(nodes[labels[linked]])}
            )

    sized = buckets.withColumn("parts", F.ceil(F.col("n") / block))
    pairs = spread(sized, "path", "node", "parts", "pair").select("pair", "node")
    return (
        join_by_key(pairs, nodes.select("node", "sketch"), ["node"])
        .repartition("pair")
        .sortWithinPartitions("pair")
        .mapInArrow(run, "u long, v long")
    )


def _intersections(lists: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sorted sets, by products of 0/1 matrices
    over the shingles that at least two of them have."""
    n = len(lists)
    owner = np.repeat(np.arange(n), [len(x) for x in lists])
    _, code, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    wide = counts > 1
    column = np.cumsum(wide) - 1
    shared = wide[code]
    owner, at = owner[shared], column[code[shared]]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    step = 4096
    for low in range(0, int(wide.sum()), step):
        a, b = np.searchsorted(at, [low, low + step])
        part = np.zeros((n, step), np.float32)
        part[owner[a:b], at[a:b] - low] = 1
        out += part @ part.T
    return out


def _exact(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links, label) per pair of blocks: links of the node there, counted with
    copies, and the least node it is linked with through links there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pair", 2000):
            keys = table.column("pair").to_numpy()
            nodes = table.column("node").to_numpy()
            copies = table.column("copies").to_numpy()
            block = table.column("block").to_numpy()
            crossed = table.column("crossed").to_numpy()
            column = table.column("shingles").combine_chunks()
            limits = column.offsets.to_numpy()
            values = column.values.to_numpy()
            sets = [values[a:b] for a, b in zip(limits[:-1], limits[1:], strict=True)]
            links = np.zeros(len(keys), np.int64)
            labels = np.arange(len(keys))
            bounds = _bounds(keys).tolist()
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a < 2:
                    continue
                common = _intersections(sets[a:b])
                size = np.array([len(s) for s in sets[a:b]])
                # common / union >= threshold, with room for the rounding of the threshold
                union = size[:, None] + size[None] - common
                linked = common >= threshold * union - 1e-9 * union
                np.fill_diagonal(linked, False)
                if crossed[a:b].any():
                    linked &= block[a:b, None] != block[None, a:b]
                links[a:b] = linked @ copies[a:b]
                one, two = np.nonzero(np.triu(linked))
                labels = _join_labels(labels, one + a, two + a)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array(nodes),
                    "links": pa.array(links),
                    "label": pa.array(nodes[labels]),
                }
            )

    return (
        members.select("pair", "node", "copies", "block", "crossed", "shingles")
        .repartition("pair")
        .sortWithinPartitions("pair")
        .mapInArrow(run, "node long, links long, label long")
    )


def _shingle_sets(docs: DataFrame) -> DataFrame:
    """Replace the text by its sorted shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            found, bounds = shingles(batch.column("text"))
            sets = [
                np.unique(found[a:b]).view(np.int64)
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            column = pa.array(sets, pa.list_(pa.int64()))
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "shingles", column)

    schema = ", ".join(
        "shingles array<long>" if f.name == "text" else f"{f.name} {f.dataType.simpleString()}"
        for f in docs.schema
    )
    return docs.mapInArrow(run, schema)


def join(
    docs: DataFrame,
    *,
    threshold: float = THRESHOLD,
    target: float = TARGET,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: (doc_id, ``KEY``, class_id, n_links, kept). ``class_id`` is the
    smallest doc_id that can be reached by links, ``n_links`` the number of other documents
    with a similarity of at least ``threshold``, ``kept`` marks the class's first row."""
    keyed = row_key(docs, KEY)
    rows = staged(sketches(keyed))
    first = F.min(F.struct("doc_id", KEY, "sketch"))
    nodes = staged(
        rows.where("size > 0")
        .groupBy("node")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"))
        .select("node", "copies", "size", "first.*")
    )
    slack = 3.5 * math.sqrt(SIZE * threshold * (1 - threshold))
    least_equal = math.floor(SIZE * threshold - slack)
    buckets = _buckets(nodes, threshold, target, small)
    near = components(_candidates(buckets, nodes, least_equal, block))
    members = join_by_key(near, nodes.select("node", KEY, "copies", "size"), ["node"])
    sizes = members.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("size") / BLOCK_SHINGLES)
        ).alias("parts")
    )
    members = staged(join_by_key(members, sizes, ["component"]))
    # dealt by key at every size; only the members of a partition are held, texts stream by
    held = members.select(KEY, "node", "component", "copies", "parts").hint("shuffle_hash")
    texts = keyed.select(KEY, "text").join(held, KEY)
    sets = _shingle_sets(texts.dropDuplicates([KEY]))
    found = staged(_exact(spread(sets, "component", "node", "parts", "pair"), threshold))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    true_edges = found.where("node != label").select(
        F.col("node").alias("u"), F.col("label").alias("v")
    )
    classes = components(true_edges)
    known = (
        join_by_key(
            nodes.select("node", "copies", F.struct("doc_id", KEY).alias("first")),
            classes, ["node"], "left",
        )
        .withColumn("component", F.coalesce("component", "node"))
    )
    leaders = known.groupBy("component").agg(F.min("first").alias("leader"))
    known = join_by_key(join_by_key(known, leaders, ["component"]), links, ["node"], "left")
    out = join_by_key(
        rows.select("doc_id", KEY, "node"),
        known.select("node", "copies", "leader", "links"), ["node"], "left",
    )
    return out.select(
        "doc_id",
        KEY,
        F.when(F.col("copies").isNull(), F.col("doc_id"))
        .otherwise(F.col("leader.doc_id"))
        .alias("class_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce(F.col(KEY) == F.col(f"leader.{KEY}"), F.lit(True)).alias("kept"),
    )


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The documents that are first in their class, with all of their columns."""
    names, docs = docs.columns, plain(docs, "doc_id", "text")
    kept = join(docs, **options).where("kept").select(KEY).distinct()
    rows = row_key(docs, KEY).join(kept, KEY, "left_semi").dropDuplicates([KEY])
    return rows.select(*docs.columns).toDF(*names)
