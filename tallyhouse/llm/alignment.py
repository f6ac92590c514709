"""Cross-tokenizer alignment by lockstep merging.

Both tokenizers cut the same bytes, a space and the text. Where a token of A and one of B end
at one byte, both streams are cut; the tokens between two cuts are a group. The cuts are found
by merging the two sorted lists of token ends: one numpy state vector holds the A and B pointers of all
lanes of a slice, every step advances the pointer whose token ends first (both, and a
cut, where they end together), and finished lanes are compacted away. A lane is a document, or for a long
one a stretch of about ``LANE`` tokens that starts at a common end, so the number of steps
does not follow the longest document.

A pair of ids is linked in a document if the two stand in one group; how many documents of the corpus link
it is counted by Spark: each slice sends its distinct pairs with the number of its documents, the sums
are joined back to the slices' pairs, and each slice adds them up for its documents. Slices
are bounded by ``SLICE`` bytes (one document may be longer), and pairs are pre-aggregated in them, so neither
a pair that all documents share nor a long document fills a task.

Texts that are null or empty, or whose token bytes are not those of a space and the text (U+2581
in the text, for one), have no tokens: all counts are 0 and the groups are an empty string. Repeated rows
count as documents of their own and are all returned; a null id stays null. Other columns are left out,
so their names cannot clash. No rows give no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import bpe
from tallyhouse.llm import text as tx
from tallyhouse.llm.common import staged
from tallyhouse.operators.joins import join_by_key

SLICE = 3 << 20  # bytes of text that are aligned together
LANE = 256  # tokens of A in a lane
WIDE = 64  # links of a group up to which they are listed one by one


@functools.cache
def _pieces(path: str):
    """Processor of a sentencepiece model, and the bytes of each piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    parts = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            parts.append(bytes([int(piece[3:5], 16)]))
        else:
            parts.append(piece.replace("▁", " ").encode())
    return model, *_table(parts)


@functools.cache
def _byte_level(path: str):
    return _table(bpe.vocabulary(path).pieces)


def _table(parts) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.frombuffer(b"".join(parts), np.uint8),
        tx.offsets_of(np.array([len(p) for p in parts], np.int64)),
    )


def _encode_pieces(model, flat: np.ndarray, offsets: np.ndarray):
    """Ids of texts that have the space in front which the model adds, and each text's first id. No piece has a
    space behind another sign, so texts may be cut before each run of spaces, and every distinct part is encoded
    once."""
    blank = flat == 0x20
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    cut[offsets[:-1]] = True
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], len(flat)]
    codes, distinct = pd.factorize(tx.span_hashes(flat, starts, ends))
    where = np.empty(len(distinct), np.int64)
    where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    whole = flat.tobytes()
    parts = [whole[s + 1 : e].decode() for s, e in zip(starts[where], ends[where], strict=True)]
    alone = [model.piece_to_id("▁")]  # the model adds no space to an empty text
    listed = [ids or alone for ids in model.encode(parts, num_threads=1)]
    sizes = np.array([len(ids) for ids in listed], np.int64)
    ids = np.fromiter(chain.from_iterable(listed), np.int64, int(sizes.sum()))
    lengths = sizes[codes]
    first = tx.offsets_of(lengths)[np.searchsorted(starts, offsets)]
    return ids[tx.ragged(tx.offsets_of(sizes)[codes], lengths)], first


def _spelled(ids: np.ndarray, bounds: np.ndarray, flat: np.ndarray, offsets: np.ndarray):
    """Bytes of all tokens end to end, the end of each token, and where each document's bytes begin."""
    lengths = np.diff(offsets)[ids]
    ends = np.cumsum(lengths)
    return flat[tx.ragged(offsets[ids], lengths)], ends, np.r_[0, ends][bounds]


def _same(flat, offsets, want, want_offsets) -> np.ndarray:
    """Whether each document's bytes are those wanted."""
    sizes = np.diff(want_offsets)
    out = np.diff(offsets) == sizes
    lengths = np.where(out, sizes, 0)
    row = np.repeat(np.arange(len(out)), lengths)
    differs = flat[tx.ragged(offsets[:-1], lengths)] != want[tx.ragged(want_offsets[:-1], lengths)]
    out[row[differs]] = False
    return out


def _lanes(a_ends, a_first, b_ends, b_first, lane: int):
    """Pointers at which lanes begin and end: (A from, A to, B from, B to). A document is cut
    behind a token of A, one in ``lane``, that ends where one of B does too."""
    a_from, b_from = a_first[:-1], b_first[:-1]
    document = np.repeat(np.arange(len(a_from)), np.diff(a_first))
    inner = np.arange(len(a_ends)) - a_from[document]
    at = np.searchsorted(b_ends, a_ends)
    at[at == len(b_ends)] = 0
    both = np.flatnonzero(b_ends[at] == a_ends)
    # the first common end of each stretch of ``lane`` tokens; the document's own end comes by itself
    stretch = document[both] * ((len(a_ends) // lane) + 2) + inner[both] // lane
    cut = both[np.r_[True, stretch[1:] != stretch[:-1]]] if len(both) else both
    cut = cut[(inner[cut] >= lane) & (cut + 1 < a_first[document[cut] + 1])]
    has = np.diff(a_first) > 0
    starts = np.sort(np.r_[a_from[has], cut + 1])
    b_starts = np.sort(np.r_[b_from[has], at[cut] + 1])
    return starts, np.r_[starts[1:], len(a_ends)], b_starts, np.r_[b_starts[1:], len(b_ends)]


def merge(a_ends, a_first, b_ends, b_first, lane: int = LANE):
    """Groups of tokens between common ends, in order: first and one past the last index of A and of B.

    ``a_ends`` and ``b_ends`` are ascending over all documents; ``a_first`` and ``b_first`` are the indices of each
    document's first token (n + 1 long). Documents have tokens of both or of none."""
    i, i_last, j, j_last = _lanes(a_ends, a_first, b_ends, b_first, lane)
    i_open, j_open = i.copy(), j.copy()
    found = []
    while len(i):
        one, two = a_ends[i], b_ends[j]
        i = i + (one <= two)
        j = j + (two <= one)
        cut = one == two
        found.append((i_open[cut], i[cut], j_open[cut], j[cut]))
        i_open, j_open = np.where(cut, i, i_open), np.where(cut, j, j_open)
        live = i < i_last
        if not live.all():
            i, j, i_open, j_open, i_last = (v[live] for v in (i, j, i_open, j_open, i_last))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    groups = [np.concatenate(part) for part in zip(*found, strict=True)]
    order = np.argsort(groups[0])
    return tuple(g[order] for g in groups)


def links(a_ids, b_ids, groups, document, wide: int = WIDE):
    """(document, A id, B id, times) of linked occurrences; a pair may come several times. Wide groups are listed by
    distinct ids, so that their links are counted and not written out."""
    low, high, b_low, b_high = groups
    n, m = high - low, b_high - b_low
    small = n * m <= wide
    g = np.repeat(np.flatnonzero(small), (n * m)[small])
    inner = tx.ragged(np.zeros(int(small.sum()), np.int64), (n * m)[small])
    a = a_ids[low[g] + inner // m[g]]
    b = b_ids[b_low[g] + inner % m[g]]
    out = [(document[g], a, b, np.ones(len(g), np.int64))]
    for w in np.flatnonzero(~small):
        x, nx = np.unique(a_ids[low[w] : high[w]], return_counts=True)
        y, ny = np.unique(b_ids[b_low[w] : b_high[w]], return_counts=True)
        size = len(x) * len(y)
        out.append(
            (np.full(size, document[w]), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(nx, ny).ravel())
        )
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def _joined_groups(a_ids, b_ids, groups, a_first, b_first) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    low, high, b_low, b_high = groups
    of_a = np.repeat(np.arange(len(low)), high - low)
    of_b = np.repeat(np.arange(len(low)), b_high - b_low)
    a_at = np.arange(len(a_ids)) + b_low[of_a]
    b_at = np.arange(len(b_ids)) + high[of_b]
    top = int(max(a_ids.max(initial=0), b_ids.max(initial=0))) + 1
    # texts of the ids with each sign behind them, shared by all of their places
    comma, bar, end = (np.array([f"{i}{sign}" for i in range(top)], object) for sign in ",|;")
    whole = np.empty(len(a_ids) + len(b_ids), object)
    whole[a_at], whole[b_at] = comma[a_ids], comma[b_ids]
    whole[a_at[high - 1]], whole[b_at[b_high - 1]] = bar[a_ids[high - 1]], end[b_ids[b_high - 1]]
    bounds = (a_first + b_first).tolist()
    return ["".join(whole[s:e])[:-1] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


def align(column: pa.Array, path_a: str, path_b: str):
    """Tokens and groups of a column of texts: (A ids, first A token of each document, B ids, first B token,
    groups); documents without tokens have none of both."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    spaced = pc.binary_join_element_wise(space, column, nothing)
    want, want_offsets = tx.utf8(spaced)
    encoded = bpe.encode(spaced, path_a, special=False)
    a_ids, a_first = encoded.document_ids()
    del encoded
    model, b_flat, b_offsets = _pieces(path_b)
    b_ids, b_first = _encode_pieces(model, want, want_offsets)
    a_bytes, a_ends, a_starts = _spelled(a_ids, a_first, *_byte_level(path_a))
    b_bytes, b_ends, b_starts = _spelled(b_ids, b_first, b_flat, b_offsets)
    kept = _same(a_bytes, a_starts, want, want_offsets) & _same(b_bytes, b_starts, want, want_offsets)
    kept &= np.diff(want_offsets) > 1
    # ends within the document, moved to where it begins among the texts
    for_a, for_b = np.repeat(kept, np.diff(a_first)), np.repeat(kept, np.diff(b_first))
    move_a = np.repeat(want_offsets[:-1] - a_starts[:-1], np.diff(a_first))
    move_b = np.repeat(want_offsets[:-1] - b_starts[:-1], np.diff(b_first))
    a_ends, b_ends = (a_ends + move_a)[for_a], (b_ends + move_b)[for_b]
    a_first = tx.offsets_of(np.where(kept, np.diff(a_first), 0))
    b_first = tx.offsets_of(np.where(kept, np.diff(b_first), 0))
    groups = merge(a_ends, a_first, b_ends, b_first)
    return a_ids[for_a].astype(np.int64), a_first, b_ids[for_b], b_first, groups


_SCHEMA = (
    "slice string, {id} {kind}, n_a long, n_b long, n_groups long, n_links long, groups {text}, "
    "codes array<int>, times array<long>, a array<int>, b array<int>, documents array<int>"
)


def _rows(batch: pa.RecordBatch, name: str, path_a: str, path_b: str, id_column: str, hashed: bool):
    """Rows of a slice: its documents with the pairs they link (as codes), and one row of the slice's pairs."""
    n = batch.num_rows
    a_ids, a_first, b_ids, b_first, groups = align(batch.column("text"), path_a, path_b)
    document = np.searchsorted(a_first, groups[0], side="right") - 1
    doc, a, b, times = links(a_ids, b_ids, groups, document)
    codes, pairs = pd.factorize(a << 32 | b)
    order = np.lexsort((codes, doc))
    doc, codes, times = doc[order], codes[order], times[order]
    begin = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (codes[1:] != codes[:-1])][: len(doc)])
    doc, codes = doc[begin], codes[begin]
    times = np.add.reduceat(times, begin) if len(begin) else times[:0]
    shares = np.bincount(codes, minlength=len(pairs))
    totals = np.bincount(doc, weights=times, minlength=n).astype(np.int64)
    joined = _joined_groups(a_ids, b_ids, groups, a_first, b_first)
    if hashed:
        joined = [hashlib.sha256(j.encode()).hexdigest() if j else "" for j in joined]
    bounds = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    n_groups = np.bincount(document, minlength=n)
    ids = batch.column(id_column)
    for low in range(0, n, 256):
        high = min(n, low + 256)
        part = slice(bounds[low], bounds[high])
        offsets = pa.array(bounds[low : high + 1] - bounds[low], pa.int32())
        none = pa.nulls(high - low, pa.list_(pa.int32()))
        yield {
            "slice": pa.array([name] * (high - low)),
            id_column: ids.slice(low, high - low),
            "n_a": pa.array(np.diff(a_first)[low:high]),
            "n_b": pa.array(np.diff(b_first)[low:high]),
            "n_groups": pa.array(n_groups[low:high]),
            "n_links": pa.array(totals[low:high]),
            "groups": pa.array(joined[low:high], pa.string()),
            "codes": pa.ListArray.from_arrays(offsets, pa.array(codes[part].astype(np.int32))),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times[part])),
            "a": none,
            "b": none,
            "documents": none,
        }
    if len(pairs):
        whole = pa.array([0, len(pairs)], pa.int32())
        out = {"slice": pa.array([name]), id_column: pa.nulls(1, ids.type)}
        out |= {c: pa.nulls(1, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}
        out |= {"groups": pa.nulls(1, pa.string()), "codes": pa.nulls(1, pa.list_(pa.int32()))}
        out["times"] = pa.nulls(1, pa.list_(pa.int64()))
        for c, values in (("a", pairs >> 32), ("b", pairs & 0xFFFFFFFF), ("documents", shares)):
            out[c] = pa.ListArray.from_arrays(whole, pa.array(values.astype(np.int32)))
        yield out


def linked(
    docs: DataFrame, path_a: str, path_b: str, *, id_column: str = "doc_id", hashed: bool = False
) -> DataFrame:
    """One row (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per document. ``groups`` lists the
    ids of each group, or is their SHA-256 (``hashed``). ``n_best`` counts the links whose pair is linked in as many
    documents as the most frequent pair of the same A id, ``count_sum`` adds those document counts over
    all links."""
    source = docs.select(id_column, "text")
    kind = source.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in tx.slices(batches, SLICE):
            for row in _rows(batch, f"{part}-{n}", path_a, path_b, id_column, hashed):
                yield pa.RecordBatch.from_pydict(row)
            n += 1

    rows = staged(source.mapInArrow(cut, _SCHEMA.format(id=id_column, kind=kind, text="string")))
    pairs = rows.where("documents is not null").select(
        "slice", F.posexplode(F.arrays_zip("a", "b", "documents")).alias("code", "pair")
    )
    pairs = pairs.select("slice", "code", "pair.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("documents").alias("n"))
    # at most as many rows of one A id as B has ids
    best = F.col("n") == F.max("n").over(Window.partitionBy("a"))
    known = join_by_key(pairs, counts.withColumn("best", best), ["a", "b"])

    def add(key, left: pa.Table, right: pa.Table) -> pa.Table:
        code = right.column("code").to_numpy()
        n = np.zeros(len(code), np.int64)
        top = np.zeros(len(code), bool)
        n[code], top[code] = right.column("n").to_numpy(), right.column("best").to_numpy()
        lists = left.column("codes").combine_chunks()
        codes = lists.flatten().to_numpy()
        times = left.column("times").combine_chunks().flatten().to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(sizes)), sizes)
        sums = [np.zeros(len(sizes), np.int64) for _ in range(2)]
        np.add.at(sums[0], row, np.where(top[codes], times, 0))
        np.add.at(sums[1], row, times * n[codes])
        kept = left.select([id_column, "n_a", "n_b", "n_groups", "n_links"])
        kept = kept.append_column("n_best", pa.array(sums[0]))
        kept = kept.append_column("count_sum", pa.array(sums[1]))
        return kept.append_column("groups", left.column("groups"))

    documents = rows.where("documents is null").drop("a", "b", "documents")
    return (
        documents.groupBy("slice")
        .cogroup(known.select(F.col("slice").alias("of"), "code", "n", "best").groupBy("of"))
        .applyInArrow(
            add,
            f"{id_column} {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
            "count_sum long, groups string",
        )
    )
