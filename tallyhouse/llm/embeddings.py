"""Embedding near-dedup with navigable small-world graphs per shard.

Vectors are compared within a label (and a dimension). Equal vectors of a label are one node
with that many copies. The nodes of a label are dealt over shards of about ``SHARD`` by hash,
and each shard gets a hierarchical small-world graph, built in one task. Then every node queries
every shard of its label: a shard's graph goes to at most ``COPIES`` tasks, each of which holds that graph
and lets its part of the queries stream by in blocks of ``QUERIES``, so no task holds a whole label and graphs
are shuffled in proportion to the vectors. A query whose beam is full of links is repeated with twice the
beam; a block whose audit (some queries, compared with the whole shard) finds too few of the
true links is repeated with twice the beam for all, and compared directly if that does
not help. A link is a pair with a cosine, in double precision, of at least ``threshold``.

A task passes on a forest of its links. Inside the components, all pairs are then compared
exactly, in pairs of blocks, which counts the links of each vector.

Vectors that are null, empty or zero, hold a null or non-finite component, or have a null label,
link with nothing. Rows with equal id are vectors of their own; the component is
the smallest id. Null ids come first.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.common import staged, whole_groups
from tallyhouse.llm.components import components, spread
from tallyhouse.llm.jaccard import _bounds, _join_labels
from tallyhouse.operators.joins import join_by_key

THRESHOLD = 0.98
SHARD = 8192
QUERIES = 2048
COPIES = 64
TASKS = 16  # per core; a task takes several shards or meetings in turn
BLOCK = 512
LINKS = 12  # per node and upper level; twice as many at the bottom
BUILD_BEAM = 48
BEAM = 32
AUDITED = 64
RECALL = 0.999


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray):
        self.vectors, self.levels = vectors, levels
        self.links: list[list[list[int]]] = [[[] for _ in range(top + 1)] for top in levels]
        self.entry = -1

    @classmethod
    def build(cls, vectors: np.ndarray, seeds: np.ndarray) -> Graph:
        """Insert all vectors; ``seeds``: random 64-bit numbers that give the levels."""
        u = (seeds >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54
        graph = cls(vectors, np.floor(-np.log(u) / math.log(LINKS)).astype(int))
        for i in range(len(vectors)):
            graph._insert(i)
        return graph

    def search(self, q: np.ndarray, starts: list[int], beam: int, level: int):
        """The ``beam`` nearest nodes found, as (cosine, node), best first."""
        seen = set(starts)
        best = [(float(self.vectors[s] @ q), s) for s in starts]
        todo = [(-c, s) for c, s in best]
        heapq.heapify(todo)
        heapq.heapify(best)
        while todo:
            cosine, node = heapq.heappop(todo)
            if len(best) >= beam and -cosine < best[0][0]:
                break
            fresh = [x for x in self.links[node][level] if x not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for c, x in zip((self.vectors[fresh] @ q).tolist(), fresh, strict=True):
                if len(best) < beam:
                    heapq.heappush(best, (c, x))
                    heapq.heappush(todo, (-c, x))
                elif c > best[0][0]:
                    heapq.heapreplace(best, (c, x))
                    heapq.heappush(todo, (-c, x))
        return sorted(best, reverse=True)

    def descend(self, q: np.ndarray, bottom: int) -> list[int]:
        """Greedy walk from the entry down to the level above ``bottom``."""
        at = [self.entry]
        for level in range(int(self.levels[self.entry]), bottom, -1):
            at = [self.search(q, at, 1, level)[0][1]]
        return at

    def _diverse(self, nodes: list[int], cosines: list[float], most: int) -> list[int]:
        """Nodes, nearest first, that are nearer to the new one than to any chosen one;
        filled up with the nearest others."""
        if len(nodes) <= most:
            return nodes
        between = self.vectors[nodes] @ self.vectors[nodes].T
        chosen: list[int] = []
        nearest = np.full(len(nodes), -np.inf)
        for i, cosine in enumerate(cosines):
            if nearest[i] < cosine:
                chosen.append(i)
                np.maximum(nearest, between[i], out=nearest)
                if len(chosen) == most:
                    break
        rest = [i for i in range(len(nodes)) if i not in set(chosen)]
        return [nodes[i] for i in chosen + rest[: most - len(chosen)]]

    def _insert(self, i: int) -> None:
        top = int(self.levels[i])
        if self.entry < 0:
            self.entry = i
            return
        q = self.vectors[i]
        at = self.descend(q, top)
        for level in range(min(top, int(self.levels[self.entry])), -1, -1):
            found = self.search(q, at, BUILD_BEAM, level)
            at = [x for _, x in found]
            chosen = self._diverse(at, [c for c, _ in found], LINKS)
            self.links[i][level] = list(chosen)
            most = LINKS * (2 if level == 0 else 1)
            for x in chosen:
                own = self.links[x][level]
                own.append(i)
                if len(own) > 2 * most:
                    cosines = self.vectors[own] @ self.vectors[x]
                    order = np.argsort(-cosines)
                    self.links[x][level] = self._diverse(
                        [own[k] for k in order], cosines[order].tolist(), most
                    )
        if top > self.levels[self.entry]:
            self.entry = i

    def linked(self, q: np.ndarray, beam: int, threshold: float) -> list[int]:
        """Nodes found with a cosine of at least ``threshold``."""
        start = self.descend(q, 0)
        while True:
            found = self.search(q, start, beam, 0)
            if found[-1][0] < threshold or len(found) < beam:
                return [x for c, x in found if c >= threshold]
            beam *= 2


def query(graph: Graph, queries: np.ndarray, threshold: float):
    """(query, node) links of a block of queries; beams widen until the audit passes."""
    n = len(graph.vectors)
    audited = np.unique(np.linspace(0, len(queries) - 1, AUDITED).astype(int))
    true = queries[audited] @ graph.vectors.T >= threshold
    beam = BEAM
    while True:
        found = [graph.linked(q, beam, threshold) for q in queries]
        hits = sum(int(row[found[i]].sum()) for i, row in zip(audited, true, strict=True))
        if hits >= RECALL * true.sum():
            break
        if beam >= n:  # a part of the graph can't be reached
            found = [np.flatnonzero(graph.vectors @ q >= threshold).tolist() for q in queries]
            break
        beam *= 2
    at = np.repeat(np.arange(len(queries)), [len(f) for f in found])
    return at, np.array([x for f in found for x in f], np.int64)


def units(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, group, unit) of vectors that can link: ``group`` is a hash of label and
    dimension, ``node`` of group and vector, ``unit`` the vector by its norm in doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for i, value in enumerate(batch.column("embedding").to_pylist()):
                if not value or None in value:
                    continue
                one = np.array(value, "<f8")
                peak = np.abs(one).max()
                if np.isfinite(peak) and peak > 0:
                    one /= peak  # squares neither overflow nor vanish
                    keep.append(i)
                    out.append((one / np.sqrt(one @ one)).tobytes())
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": rows.column("vec_id"),
                    "group": rows.column("group"),
                    "unit": pa.array(out, pa.binary()),
                }
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    group = F.xxhash64("label", F.size("embedding"))
    return (
        vectors.where("label is not null and embedding is not null")
        .select("vec_id", group.alias("group"), "embedding")
        .mapInArrow(run, f"vec_id {kind}, group long, unit binary")
        .withColumn("node", F.xxhash64("group", "unit"))
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def _by_group(df: DataFrame, key: str, groups: int, *order: Column | str) -> DataFrame:
    """Dealt by ``key`` over a fixed number of tasks, since the work is in the rows and not
    in their bytes; sorted by ``key`` and ``order``."""
    most = TASKS * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(min(max(1, groups), most), key).sortWithinPartitions(key, *order)


def _runs(batches: Iterator[pa.RecordBatch]):
    """(meeting, whether these are nodes of its graph, rows): the nodes of a meeting, then its queries, in pieces."""
    for batch in batches:
        keys, asking = batch.column("meeting").to_numpy(), batch.column("place").to_numpy() < 0
        change = (keys[1:] != keys[:-1]) | (asking[1:] != asking[:-1])
        starts = np.flatnonzero(np.r_[batch.num_rows > 0, change]).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield keys[a], not asking[a], batch.slice(a, b - a)


def _restored(pieces: list[pa.RecordBatch]) -> tuple[Graph, np.ndarray]:
    """The graph from its rows in order of place, and the nodes at these places."""
    rows = pa.Table.from_batches(pieces)
    links = rows.column("links").to_pylist()
    graph = Graph(_matrix(rows.column("unit")), np.array([len(x) - 1 for x in links]))
    graph.links = links
    graph.entry = int(graph.levels.argmax())
    return graph, rows.column("node").to_numpy()


def _graphs(nodes: DataFrame, groups: int) -> DataFrame:
    """Add level and links (places of nodes in their shard, per level) and the place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "shard", 1):
            bounds = _bounds(table.column("shard").to_numpy())
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                part = table.slice(a, b - a)
                seeds = tx.mix(part.column("node").to_numpy().view(np.uint64).copy())
                graph = Graph.build(_matrix(part.column("unit")), seeds)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": part.column("shard").combine_chunks(),
                        "group": part.column("group").combine_chunks(),
                        "node": part.column("node").combine_chunks(),
                        "unit": part.column("unit").combine_chunks(),
                        "place": pa.array(np.arange(b - a), pa.int32()),
                        "links": pa.array(graph.links, pa.list_(pa.list_(pa.int32()))),
                    }
                )

    columns = nodes.select("shard", "group", "node", "unit")
    return _by_group(columns, "shard", groups).mapInArrow(
        run, "shard long, group long, node long, unit binary, place int, links array<array<int>>"
    )


def _edges(meetings: DataFrame, groups: int, threshold: float) -> DataFrame:
    """(u, v): a forest of the links between each block of queries and a shard's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces, graph = None, [], None
        for meeting, holds, rows in _runs(batches):
            if meeting != at:
                at, pieces, graph = meeting, [], None
            if holds:
                pieces.append(rows)
                continue
            if graph is None:
                graph, places = _restored(pieces)
            for low in range(0, rows.num_rows, QUERIES):
                asked = rows.slice(low, QUERIES)
                one, two = query(graph, _matrix(asked.column("unit")), threshold)
                both = np.r_[asked.column("node").to_numpy(), places]
                labels = _join_labels(np.arange(len(both)), one, two + asked.num_rows)
                linked = np.flatnonzero(both != both[labels])
                yield pa.RecordBatch.from_pydict(
                    {"u": pa.array(both[linked]), "v": pa.array(both[labels[linked]])}
                )

    columns = meetings.select("meeting", "place", "node", "unit", "links")
    return _by_group(columns, "meeting", groups, F.col("place") < 0, "place").mapInArrow(
        run, "u long, v long"
    )


def _counts(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links) per pair of blocks, counted with copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pair", 2000):
            bounds = _bounds(table.column("pair").to_numpy())
            nodes, links = table.column("node").to_numpy(), np.zeros(len(table), np.int64)
            copies = table.column("copies").to_numpy()
            block, crossed = table.column("block").to_numpy(), table.column("crossed").to_numpy()
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                units = _matrix(table.column("unit").slice(a, b - a))
                linked = units @ units.T >= threshold
                np.fill_diagonal(linked, False)
                if crossed[a:b].any():
                    linked &= block[a:b, None] != block[None, a:b]
                links[a:b] = linked @ copies[a:b]
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes), "links": pa.array(links)})

    return (
        members.select("pair", "node", "copies", "unit", "block", "crossed")
        .repartition("pair")
        .sortWithinPartitions("pair")
        .mapInArrow(run, "node long, links long")
    )


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    shard: int = SHARD,
    queries: int = QUERIES,
    copies: int = COPIES,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors`` (vec_id,
    embedding, label)."""
    rows = staged(units(vectors))
    nodes = rows.groupBy("node").agg(
        F.first("group").alias("group"),
        F.first("unit").alias("unit"),
        F.min("vec_id").alias("vec_id"),
        F.count(F.lit(1)).alias("copies"),
    )
    sizes = nodes.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    nodes = staged(
        join_by_key(nodes, sizes, ["group"])
        .withColumn("shards", F.ceil(F.col("size") / shard))
        .withColumn("shard", F.xxhash64("group", F.pmod(F.xxhash64("node"), F.col("shards"))))
    )
    shards = nodes.select("shard").distinct().count()
    graphs = staged(_graphs(nodes, shards))
    # every part of the queries meets every shard of its group
    blocks = F.least(F.ceil(F.col("size") / queries), F.lit(copies).cast("long"))
    places = nodes.select("shard", blocks.alias("blocks")).distinct()

    def numbered(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    held = (
        join_by_key(graphs, places, ["shard"])
        .withColumn("asked_by", numbered("blocks"))
        .select(F.xxhash64("shard", "asked_by").alias("meeting"), "place", "node", "unit", "links")
    )
    asked_by = F.pmod(F.xxhash64("unit"), blocks)
    asking = (
        nodes.select("node", "unit", "group", asked_by.alias("asked_by"), numbered("shards").alias("i"))
        .select("node", "unit", "asked_by", F.xxhash64("group", "i").alias("shard"))
        .select(
            F.xxhash64("shard", "asked_by").alias("meeting"),
            F.lit(-1).alias("place"),
            "node",
            "unit",
            F.lit(None).cast("array<array<int>>").alias("links"),
        )
    )
    meetings = places.agg(F.sum("blocks")).first()[0] or 1
    edges = _edges(held.unionByName(asking), meetings, threshold)
    found = components(edges)
    members = join_by_key(found, nodes.select("node", "unit", "copies", "vec_id"), ["node"])
    sized = members.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / block).alias("parts"), F.min("vec_id").alias("least")
    )
    members = staged(join_by_key(members, sized, ["component"]))
    links = (
        _counts(spread(members, "component", "node", "parts", "pair"), threshold)
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    known = join_by_key(
        join_by_key(
            nodes.select("node", "copies", "vec_id"), members.select("node", "least"), ["node"], "left"
        ),
        links, ["node"], "left",
    ).select(
        "node",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
    )
    linked = join_by_key(rows.select("vec_id", "node"), known, ["node"]).drop("node")
    # the rest links with nothing
    alone = _unlinkable(vectors).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unlinkable(vectors: DataFrame) -> DataFrame:
    """The rows that ``units`` leaves out, by the same rules."""
    finite = F.forall(
        "embedding",
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast("double")), F.lit(False)
        ),
    )
    good = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & finite
        & F.exists("embedding", lambda x: x != 0)
    )
    return vectors.where(~F.coalesce(good, F.lit(False))).select("vec_id")
