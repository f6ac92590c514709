"""Substring dedup by relative Lempel-Ziv parsing against content-cut reference blocks.

The symbols that are parsed are windows: the 64-bit hash of ``window`` words stands for the window's first word, so a match of
m symbols is one of m + ``window`` - 1 words, and every match is long enough. The blocks are cut by content: of each
window the leftmost of its least hashed 8-word anchors is taken, so equal windows have equal anchors wherever they
stand, and block a holds, for every place in the corpus with anchor a, the windows around it. A document is dealt, run by run, to every block
that can hold one of its windows.

Each block is indexed: places are refined into classes of equal strings of 1, 2, 3... symbols until no string of that length
stands twice, which gives each place its longest match elsewhere in the block and where that is. Then all runs are
parsed greedily against the block: a place with a match becomes a factor (start, length, source, source start) and
the parse goes on behind it, a place without one is a literal. The window behind a factor crosses its end and is looked up
itself, so nothing that repeats across a factor's boundary is missed: a word is covered by factors exactly if
some window over it starts elsewhere as well (up to collisions of 64-bit hashes).

Blocks of anchors that occur once hold no duplicates and are dropped after counting. A
block of more than ``block`` places is cut into parts; each part parses against itself, and passes on the windows that it could not
match and one row for each that it could, which are settled in a second round. So no task holds a whole hot block, and nothing is dropped.

Words are runs of anything but space and \\t..\\r. Null text has none. Rows with equal id and
text are places of their own, so both lose their windows. Other columns are kept, whatever their names; the added
ones are ``n_words`` and ``n_removed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.common import plain, row_key, staged, whole_groups
from tallyhouse.operators.joins import join_by_key

WINDOW = 35
ANCHOR = 8
BLOCK = 8192
PIECE = 2 << 20
KEY, SPANS = "_rlz_key", "_rlz_spans"


def anchored_windows(column: pa.Array, window: int, anchor: int):
    """Runs of windows with the same anchor: row, anchor hash, first window (as a word of
    the row) and number of windows; and, for ``window_hashes``, the words' hashes and the
    index of each row's first word."""
    flat, offsets = tx.utf8(column)
    starts, ends, first = tx.words(flat, offsets)
    hashes = tx.span_hashes(flat, starts, ends)
    n = len(hashes) - anchor + 1
    width = window - anchor + 1
    if n < width:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none, hashes, first
    at = np.arange(n)
    grams = tx.span_hashes(hashes, at, at + anchor)
    least, span = at, 1  # leftmost least gram among the next ``span``
    while span < width:
        step = min(span, width - span)
        one, two = least[:-step], least[step:]
        least = np.where(grams[two] < grams[one], two, one)
        span += step
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    where = np.flatnonzero(row[: len(least)] == row[window - 1 :][: len(least)])
    chosen = least[where]
    new = np.ones(len(where), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (where[1:] != where[:-1] + 1)
    begin = np.flatnonzero(new)
    counts = np.diff(np.r_[begin, len(where)])
    rows = row[where[begin]]
    return rows, grams[chosen[begin]], where[begin] - first[rows], counts, hashes, first


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, key) for every run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            rows, grams, *_ = anchored_windows(batch.column("text"), window, anchor)
            keys = batch.column(KEY).to_numpy()[rows]
            yield pa.RecordBatch.from_pydict(
                {"anchor": pa.array(grams.view(np.int64)), KEY: pa.array(keys)}
            )

    return docs.select(KEY, "text").mapInArrow(run, f"anchor long, {KEY} long")


def _windows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, part, parts, key, start, hashes) of the runs whose anchors are in the
    row's ``repeated`` list, which is sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, PIECE):
            rows, grams, first_window, counts, hashes, first = anchored_windows(
                batch.column("text"), window, anchor
            )
            grams = grams.view(np.int64)
            lists = batch.column("repeated")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            named = flat.field("anchor").to_numpy()
            parts = flat.field("parts").to_numpy()
            pick = np.full(len(rows), -1)
            ends = np.cumsum(sizes)
            bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                low, high = ends[i] - sizes[i], ends[i]
                at = low + np.searchsorted(named[low:high], grams[a:b])
                at[at == high] = low
                pick[a:b] = np.where(named[at] == grams[a:b], at, -1)
            kept = pick >= 0
            rows, counts, first_window = rows[kept], counts[kept], first_window[kept]
            grams, parts = grams[kept], parts[pick[kept]]
            begin = first[rows] + first_window
            starts = tx.ragged(begin, counts)
            found = tx.span_hashes(hashes, starts, starts + window).view(np.int64)
            offsets = pa.array(tx.offsets_of(counts).astype(np.int32))
            keys = batch.column(KEY).to_numpy()[rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": pa.array(grams),
                    "part": pa.array(keys % parts),
                    "parts": pa.array(parts),
                    KEY: pa.array(keys),
                    "start": pa.array(first_window),
                    "hashes": pa.ListArray.from_arrays(offsets, pa.array(found)),
                }
            )

    return docs.select(KEY, "text", "repeated").mapInArrow(
        run,
        f"anchor long, part long, parts long, {KEY} long, start long, hashes array<long>",
    )


def longest_matches(symbols: np.ndarray, block: np.ndarray, left: np.ndarray):
    """For each place the length of the longest string from it that stands elsewhere in its block too (0: none), and
    one place where it does. ``left``: symbols from the place to the end of its run, itself included."""
    length = np.zeros(len(symbols), np.int64)
    source = np.full(len(symbols), -1)
    at = np.arange(len(symbols))
    key = tx.mix(block.astype(np.int64).view(np.uint64).copy()) + symbols.view(np.uint64)
    n = 0
    while len(at):
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        first = np.r_[True, key[1:] != key[:-1]]
        several = ~(first & np.r_[first[1:], True])
        at, first = at[several], first[several]
        if not len(at):
            break
        n += 1
        length[at] = n
        # the place before it in its class, for the first one the place behind it
        source[at] = np.where(first, np.r_[at[1:], 0], np.r_[0, at[:-1]])
        kind = np.cumsum(first)
        more = left[at] > n
        at, kind = at[more], kind[more]
        key = tx.mix(kind.astype(np.uint64)) + symbols.view(np.uint64)[at + n]
    return length, source


def parse(length: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places at which the factors of a greedy parse begin; all runs are parsed together."""
    found = []
    at = starts
    while len(at):
        some = length[at]
        found.append(at[some > 0])
        at = at + np.maximum(some, 1)
        live = at < ends
        at, ends = at[live], ends[live]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _factors(windows: DataFrame, window: int) -> DataFrame:
    """Parse every block. Rows: (key, start, end, source, source_start) of factors in words; (key, start,
    end, hash) of windows that are single in a part; (null key, hash) of repeated ones there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "anchor_part"):
            batch = table.combine_chunks().to_batches()[0]
            lists = batch.column("hashes")
            sizes = np.diff(lists.offsets.to_numpy())
            hashes = lists.flatten().to_numpy()
            keys, starts, parts, blocks = (
                batch.column(c).to_numpy() for c in (KEY, "start", "parts", "anchor_part")
            )
            row = np.repeat(np.arange(len(sizes)), sizes)
            ends = np.cumsum(sizes)
            word = tx.ragged(starts, sizes)
            length, source = longest_matches(hashes, blocks[row], ends[row] - np.arange(len(row)))
            begin = parse(length, (ends - sizes)[sizes > 0], ends[sizes > 0])
            open_ = parts[row] > 1
            single = np.flatnonzero(open_ & (length == 0))
            known = np.unique(hashes[open_ & (length > 0)])
            n, m = len(begin), len(single)
            none = np.zeros(len(known), np.int64)
            first = np.r_[word[begin], word[single], none]
            count = np.r_[length[begin], np.ones(m + len(known), np.int64)]
            is_factor = np.r_[np.ones(n, bool), np.zeros(m + len(known), bool)]
            has_key = np.r_[np.ones(n + m, bool), none.astype(bool)]
            rest = np.zeros(m + len(known), np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    KEY: pa.array(np.r_[keys[row[begin]], keys[row[single]], none], mask=~has_key),
                    "start": pa.array(first),
                    "end": pa.array(first + count + (window - 1)),
                    "hash": pa.array(
                        np.r_[np.zeros(n, np.int64), hashes[single], known], mask=is_factor
                    ),
                    "source": pa.array(np.r_[keys[row[source[begin]]], rest], mask=~is_factor),
                    "source_start": pa.array(np.r_[word[source[begin]], rest], mask=~is_factor),
                }
            )

    group = F.xxhash64("anchor", "part")
    return (
        windows.withColumn("anchor_part", group)
        .repartition("anchor_part")
        .sortWithinPartitions("anchor_part")
        .select("anchor_part", "parts", KEY, "start", "hashes")
        .mapInArrow(
            run, f"{KEY} long, start long, end long, hash long, source long, source_start long"
        )
    )


def factors(
    keyed: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK
) -> DataFrame:
    """Rows of the parse of documents with a ``KEY``: (key, start, end, source, source_start) of factors, and the
    windows that parts of large blocks leave open (with a ``hash``)."""
    # The join is on a hash of the anchor, so that Spark deals both sides for it and can split
    # a hot one; it stands for the anchor on the large side.
    mixed = F.xxhash64("anchor").alias("mix")
    anchors = _anchors(keyed, window, anchor)
    counted = (
        anchors.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(mixed, "anchor", F.ceil(F.col("n") / block).alias("parts"))
    )
    named = (
        anchors.select(mixed, KEY)
        .join(counted, "mix")
        .groupBy(KEY)
        .agg(F.sort_array(F.collect_set(F.struct("anchor", "parts"))).alias("repeated"))
    )
    found = _windows(keyed.select(KEY, "text").join(named, KEY), window, anchor)
    return staged(_factors(found, window))


def repeated_spans(
    keyed: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK
) -> DataFrame:
    """(key, spans) for documents with a ``KEY``: word ranges of windows that start elsewhere too."""
    rows = factors(keyed, window=window, anchor=anchor, block=block)
    open_rows = rows.where("hash is not null")
    settled = (
        open_rows.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.col(KEY).isNull()).alias("known"))
        .where("n > 1 or known")
        .select("hash")
    )
    more = join_by_key(open_rows.where(F.col(KEY).isNotNull()), settled, ["hash"], "left_semi")
    spans = rows.where("hash is null").select(KEY, "start", "end")
    return (
        spans.unionByName(more.select(KEY, "start", "end"))
        .groupBy(KEY)
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )


def remove_repeats(
    docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK
) -> DataFrame:
    """The documents with every word removed that a repeated window covers; kept words are
    joined by one space. Adds ``n_words`` and ``n_removed``, in place of columns of that name."""
    docs = docs.drop("n_words", "n_removed")
    names, docs = docs.columns, plain(docs, "doc_id", "text")
    keyed = row_key(docs, KEY)
    spans = repeated_spans(keyed, window=window, anchor=anchor, block=block)
    joined = keyed.join(spans.withColumnRenamed("spans", SPANS), KEY, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            total, removed, kept = [], [], []
            for text, spans in zip(texts, batch.column(SPANS).to_pylist(), strict=True):
                words = (text or "").encode().split()
                total.append(len(words))
                if spans:
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, [s["start"] for s in spans], 1)
                    np.add.at(cover, [s["end"] for s in spans], -1)
                    keep = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
                    removed.append(len(words) - len(keep))
                    words = [words[i] for i in keep]
                else:
                    removed.append(0)
                kept.append(b" ".join(words).decode())
            out = batch.drop_columns([SPANS])
            out = out.set_column(
                out.schema.get_field_index("text"), "text", pa.array(kept, pa.string())
            )
            yield out.append_column("n_words", pa.array(total, pa.int64())).append_column(
                "n_removed", pa.array(removed, pa.int64())
            )

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    kept = joined.select(*docs.columns, SPANS).mapInArrow(
        run, f"{columns}, n_words long, n_removed long"
    )
    return kept.toDF(*names, "n_words", "n_removed")
