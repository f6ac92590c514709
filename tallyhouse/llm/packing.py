"""Sum-of-squares online packing of token ids into sequences.

Each document is tokenized, closed with ``end_id`` and placed at once: whole windows are
cut off its front, the rest goes to the fill level that leaves the smallest sum of squared
counts of partially filled windows. ``counts[level]`` is that level array; placing a rest
of size s on level h takes one window from h and adds one to h + s (a full window leaves
the array), so the change of the sum is read off the array for all levels at once.

Every task packs its own partition, with memory for its open windows only. When it ends
(or has ``MOST_OPEN`` of them) the fullest open windows are filled with pieces cut from
the emptiest, so that at most one sequence per task is not full; that one is padded by
the consumer. Sequence ids carry the task's partition number, so they are unique without
a shuffle. A retried task packs alike as long as its rows come in the same order, as they do
from files; write a shuffled input first.

Null text counts as empty (one id, ``end_id``), null ids and repeated rows are kept, and
columns other than the id and the text are left out, but for those named in ``keep``, which each piece has
from its document. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyhouse.llm import bpe
from tallyhouse.llm import text as tx

WINDOW = 2048
MOST_OPEN = 8192


class Packer:
    """Open windows of one task by fill level. A piece is (document, start, ids)."""

    def __init__(self, window: int, most_open: int = MOST_OPEN):
        self.window, self.most_open = window, most_open
        self.counts = np.zeros(window, np.int64)  # [level]; level 0 stays 0
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open = 0

    def place(self, key, ids: np.ndarray) -> Iterator[list]:
        """Yield the windows that this document fills, as lists of pieces."""
        start, size = 0, len(ids)
        while size - start >= self.window:
            yield [(key, start, ids[start : start + self.window])]
            start += self.window
        rest = size - start
        if not rest:
            return
        piece = (key, start, ids[start:].copy())
        level = self.best_level(rest)
        held = self.open[level].pop() if level else []
        held.append(piece)
        if level:
            self.counts[level] -= 1
            self.n_open -= 1
        if level + rest == self.window:
            yield held
            return
        self.open[level + rest].append(held)
        self.counts[level + rest] += 1
        self.n_open += 1
        if self.n_open >= self.most_open:
            yield from self.flush(final=False)

    def best_level(self, size: int) -> int:
        """The level, 0 for a new window, with the smallest sum of squares after it;
        the fullest of equals."""
        fits = self.window - size
        change = 2 - 2 * self.counts[: fits + 1]
        change[:fits] += 2 * self.counts[size : self.window]
        change[fits] -= 1  # the window is full and leaves
        change[1:][self.counts[1 : fits + 1] == 0] = np.iinfo(np.int64).max
        change[0] -= 1
        return fits - int(np.argmin(change[::-1]))

    def flush(self, final: bool = True) -> Iterator[list]:
        """Fill the fullest open windows with pieces cut from the emptiest."""
        held = [w for windows in self.open for w in windows]  # emptiest first
        levels = [level for level, windows in enumerate(self.open) for _ in windows]
        self.open = [[] for _ in range(self.window)]
        self.counts[:] = 0
        self.n_open = 0
        low, high = 0, len(held) - 1
        while low < high:
            need = self.window - levels[high]
            key, start, ids = held[low].pop()
            if len(ids) > need:
                keep = len(ids) - need
                held[low].append((key, start, ids[:keep]))
                held[high].append((key, start + keep, ids[keep:]))
                moved = need
            else:
                held[high].append((key, start, ids))
                moved = len(ids)
            levels[low] -= moved
            levels[high] += moved
            if levels[high] == self.window:
                yield held[high]
                high -= 1
            if low <= high and not levels[low]:
                low += 1
        if low == high and levels[low]:
            if final:
                yield held[low]
            else:
                self.open[levels[low]].append(held[low])
                self.counts[levels[low]] += 1
                self.n_open = 1


def pack(
    docs: DataFrame,
    path: str,
    *,
    window: int = WINDOW,
    end_id: int = 1,
    most_open: int = MOST_OPEN,
    id_column: str = "doc_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Pieces (id, start, length, ids, doc_tokens, sequence_id, offset, ``keep``): ``ids`` holds
    the piece as little-endian unsigned 32-bit numbers, ``start`` its place in the
    document, ``offset`` its place in the sequence. Each id of each document is in
    exactly one piece."""
    source = docs.select(id_column, "text", *keep)
    kind = source.schema[id_column].dataType.simpleString()
    kept_kinds = "".join(f", {name} {source.schema[name].dataType.simpleString()}" for name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, most_open)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        names = [id_column, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", *keep]
        types = [None, pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * 3 + [None] * len(keep)

        def emit(windows):
            nonlocal sequence, held
            for pieces in windows:
                at = 0
                for (key, total, kept), start, ids in pieces:
                    rows.append((key, start, len(ids), ids.tobytes(), total, sequence, at, *kept))
                    at += len(ids)
                held += at
                sequence += 1

        for batch in tx.slices(batches, bpe.SLICE):
            types[0] = batch.schema.field(id_column).type
            types[7:] = [batch.schema.field(name).type for name in keep]
            ids, bounds = bpe.encode(batch.column("text"), path).document_ids()
            keys = batch.column(id_column).to_pylist()
            held_over = list(zip(*[batch.column(name).to_pylist() for name in keep], strict=True)) or [()] * len(keys)
            places = zip(keys, held_over, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
            for key, kept, a, b in places:
                one = np.empty(b - a + 1, "<u4")
                one[:-1] = ids[a:b]
                one[-1] = end_id
                emit(packer.place((key, len(one), kept), one))
                if held > 1 << 20:
                    yield out()
                    rows.clear()
                    held = 0
        emit(packer.flush())
        if rows:
            yield out()

    return source.mapInArrow(
        run,
        f"{id_column} {kind}, start long, length long, ids binary, doc_tokens long, "
        f"sequence_id long, offset long{kept_kinds}",
    )
