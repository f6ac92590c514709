"""Array views of text inside tasks: code points, words and their hashes.

Python workers get Arrow batches; these helpers turn a string column into flat numpy
arrays (UTF-8 bytes or code points with document offsets), so that cutting, hashing and
comparing words costs a few array passes and no Python object per word.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# Unicode White_Space.
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029]
SPACES += [0x202F, 0x205F, 0x3000]
_BASE = 0x9E3779B97F4A7C13  # odd, so powers can be inverted modulo 2**64


def slices(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text"):
    """The batches again, cut evenly so that none holds much more than ``limit`` bytes
    of text (one row may)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        parts = max(1, -(-int(ends[-1]) // limit))
        cuts = np.searchsorted(ends, ends[-1] * np.arange(1, parts) / parts) + 1
        cuts = np.unique(np.r_[0, np.minimum(cuts, batch.num_rows), batch.num_rows])
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(start, end - start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and the offset of each row (n + 1 long).
    Null counts as empty."""
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    column = pc.fill_null(column, "") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)
    offsets = offsets[column.offset :]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def code_points(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes with byte offsets as code points with code point offsets."""
    points = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if len(points) == len(flat):
        return points, offsets
    return points, np.searchsorted(np.flatnonzero((flat & 0xC0) != 0x80), offsets)


@functools.cache
def classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    table = np.zeros(0x110000, np.uint8)
    initial = "".join(unicodedata.category(chr(i))[0] for i in range(0x110000))
    kinds = np.frombuffer(initial.encode(), np.uint8)
    table[kinds == ord("L")] = LETTER
    table[kinds == ord("N")] = NUMBER
    table[SPACES] = SPACE
    return table


@functools.cache
def lower() -> np.ndarray:
    """Lower case of every code point by itself, where that is one code point."""
    table = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        if not 0xD800 <= i < 0xE000 and len(low := chr(i).lower()) == 1:
            table[i] = ord(low)
    return table


def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values; in place."""
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2**64."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.full(size, np.uint64(base))
            out[0] = 1
            tables.append(np.cumprod(out, dtype=np.uint64))
        have = _powers[0] = (tables[0], tables[1])
    return have


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``values[start:end]``; the same content hashes alike
    wherever it stands. ``values``: bytes, code points or 64-bit hashes; ``starts``
    ascending."""
    out = np.empty(len(starts), np.uint64)
    step = 1 << 19  # stay in cache
    low = 0
    while low < len(starts):
        base = int(starts[low])
        high = max(low + 1, int(np.searchsorted(starts, base + step)))
        top = int(ends[low:high].max(initial=base))
        part = values[base:top]
        if part.dtype == np.uint8:
            part = _byte_values()[part]
        elif part.dtype != np.uint64:
            part = _point_values()[part]
        up, down = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        s, e = starts[low:high] - base, ends[low:high] - base
        h = (sums[e] - sums[s]) * down[s]
        h += (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        out[low:high] = mix(h)
        low = high
    return out


@functools.cache
def _point_values() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.cache
def _blank() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def words(flat: np.ndarray, offsets: np.ndarray):
    """Runs of anything but space and \\t..\\r in UTF-8 bytes: starts and ends, and the
    index of each document's first word (n + 1 long)."""
    inner = np.zeros(len(flat) + 2, np.int8)
    inner[1:-1] = ~_blank()[flat]
    change = np.diff(inner)
    # a document's edge cuts a run
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(flat))]
    joined = np.unique(edges[(inner[edges] == 1) & (inner[edges + 1] == 1)])
    starts = np.flatnonzero(change == 1)
    ends = np.flatnonzero(change == -1)
    if len(joined):
        starts = np.sort(np.r_[starts, joined])
        ends = np.sort(np.r_[ends, joined])
    return starts, ends, np.searchsorted(starts, offsets)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of each span, end to end."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
