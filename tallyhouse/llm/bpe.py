"""BPE encoding and decoding with a pair occurrence index.

A slice of a partition is cut into words by array passes over its code points. Each
distinct word is encoded once, all of them together: the index maps every adjacent
pair that has a merge rank to all positions where it stands, the active ranks are
applied in ascending order, and only the lists of pairs beside a merge are updated. In
ascending order that equals merging word by word, because a merge rank is always above
the ranks that made its parts.

Vocabulary files are those of the ``tokenizers`` library (byte-level BPE); their path is
a parameter. Two ways of cutting words are known, and told apart by the file's own
settings: with word ends (lower case, NFC, white space dropped) and without.

Nulls count as empty texts; an empty text has no ids. Special tokens of the file inside a
text become their ids, as the library does by default.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyhouse.llm import text as tx

SLICE = 4 << 20  # bytes of text that are encoded together; about 100 MB of arrays


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters for themselves, code points from 256 for the rest."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    word_ends: bool
    first: np.ndarray  # id of each byte
    last: np.ndarray  # id of each byte at a word's end
    pair_keys: np.ndarray  # left id << 32 | right id, ascending
    pair_ranks: np.ndarray  # rank of each key
    merges: np.ndarray  # left, right and new id of each rank
    pieces: tuple[bytes, ...]  # text of each id
    special: dict[str, int]


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model = found["model"]
    ids, end = model["vocab"], model["end_of_word_suffix"] or ""
    signs = byte_characters()
    of_sign = {sign: byte for byte, sign in enumerate(signs)}
    pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int64)
    keys = merges[:, 0] << 32 | merges[:, 1]
    order = np.argsort(keys)
    special = {t["content"]: t["id"] for t in found["added_tokens"]}
    pieces = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for sign, i in ids.items():
        bare = sign.removesuffix(end) if end else sign
        if all(c in of_sign for c in bare):
            pieces[i] = bytes(of_sign[c] for c in bare)
    for sign, i in special.items():
        pieces[i] = sign.encode()
    return Vocabulary(
        bool(end),
        np.array([ids[s] for s in signs], np.int32),
        np.array([ids[s + end] for s in signs], np.int32),
        keys[order],
        order.astype(np.int32),
        merges.astype(np.int32),
        tuple(pieces),
        special,
    )


def _contractions(points, cut, doc_start) -> None:
    """Join an apostrophe that starts a token to s, t, m, d, re, ve or ll behind it."""
    n = len(points)
    at = np.flatnonzero((points[: n - 1] == ord("'")) & cut[: n - 1])
    at = at[~doc_start[at + 1]]
    one = points[at + 1]
    beyond = np.minimum(at + 2, n - 1)
    two = np.where((at + 2 < n) & ~doc_start[beyond], points[beyond], 0)
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        double |= (one == ord(a)) & (two == ord(b))
    for found, length in ((single, 2), (double, 3)):
        here = at[found]
        cut[here + 1] = False
        here = here[here + length < n]
        cut[here + length] = True


def cut_words(points: np.ndarray, offsets: np.ndarray, word_ends: bool):
    """Starts and ends of the tokens that are merged separately, and the index of each
    document's first one."""
    n = len(points)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    kind = tx.classes()[points]
    doc_start = np.zeros(n + 1, bool)
    doc_start[offsets] = True
    cut = np.empty(n, bool)
    cut[0] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut |= doc_start[:n]
    if word_ends:
        cut |= kind == tx.NUMBER
        _contractions(points, cut, doc_start)
    else:
        blank = points == 0x20
        glued = np.zeros(n, bool)
        glued[1:] = blank[:-1] & ~doc_start[1:n]
        free = cut & ~glued
        _contractions(points, free, doc_start)
        changed = free != (cut & ~glued)
        cut[changed] = free[changed]
        # the last white space before a token is cut off, and is its first sign if blank
        final = np.flatnonzero((kind[:-1] == tx.SPACE) & (kind[1:] != tx.SPACE))
        final = final[~doc_start[final + 1]]
        cut[final] = True
        cut[final[blank[final]] + 1] = False
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], n]
    if word_ends:
        inside = kind[starts] != tx.SPACE
        starts, ends = starts[inside], ends[inside]
    return starts, ends, np.searchsorted(starts, offsets)


def _ranks(vocab: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Merge rank of each pair of ids, -1 where there is none."""
    keys = left.astype(np.int64) << 32 | right
    at = np.searchsorted(vocab.pair_keys, keys)
    at[at == len(vocab.pair_keys)] = 0
    return np.where(vocab.pair_keys[at] == keys, vocab.pair_ranks[at], -1)


def merge_all(vocab: Vocabulary, flat: np.ndarray, offsets: np.ndarray):
    """Encode words given as bytes end to end. Returns ids end to end and their offsets."""
    n = len(flat)
    ids = vocab.first[flat]
    ids[offsets[1:] - 1] = vocab.last[flat[offsets[1:] - 1]]
    after = np.arange(1, n + 1, dtype=np.int32)
    after[offsets[1:] - 1] = -1
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[offsets[:-1]] = -1

    index: dict[int, list[np.ndarray]] = defaultdict(list)
    active: list[int] = []

    def note(ranks: np.ndarray, positions: np.ndarray) -> None:
        """Add positions to the lists of their pairs."""
        found = ranks >= 0
        ranks, positions = ranks[found], positions[found]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        starts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        for rank, part in zip(
            ranks[starts].tolist(), np.split(positions, starts[1:]), strict=True
        ):
            if rank not in index:
                heapq.heappush(active, rank)
            index[rank].append(part)

    at = np.flatnonzero(after >= 0).astype(np.int32)
    note(_ranks(vocab, ids[at], ids[at + 1]), at)
    merges = vocab.merges.tolist()
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        left, right, new = merges[rank]
        follow = after[at]
        at = at[(ids[at] == left) & (follow >= 0) & (ids[follow] == right)]
        if not len(at):
            continue
        if left == right:  # in a run, every other position from the left
            at = np.unique(at)
            linked = np.r_[False, after[at[:-1]] == at[1:]]
            run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        gone = after[at]
        beyond = after[gone]
        ids[at] = new
        ids[gone] = -1
        after[at] = beyond
        has = beyond >= 0
        before[beyond[has]] = at[has]
        fore = before[at]
        fore = fore[(fore >= 0) & (ids[fore] != new)]
        ahead = at[has]
        pairs = np.concatenate([ahead, fore])
        note(_ranks(vocab, ids[pairs], ids[after[pairs]]), pairs)

    kept = ids >= 0
    counts = np.add.reduceat(kept, offsets[:-1], dtype=np.int64) if len(offsets) > 1 else kept[:0]
    return ids[kept], tx.offsets_of(counts)


@dataclass
class Encoded:
    """Words of all documents as codes of distinct words, and those words' ids."""

    codes: np.ndarray
    first: np.ndarray  # index of each document's first word, n + 1 long
    ids: np.ndarray
    offsets: np.ndarray

    def document_ids(self):
        """Ids of all documents end to end, and the offset of each document."""
        lengths = np.diff(self.offsets)[self.codes]
        ends = tx.offsets_of(lengths)
        return self.ids[tx.ragged(self.offsets[self.codes], lengths)], ends[self.first]


def _normal(points: np.ndarray, offsets: np.ndarray):
    """NFC, then lower case of each code point by itself."""
    whole = points.tobytes().decode("utf-32-le")
    if not whole.isascii() and (
        "İ" in whole or not unicodedata.is_normalized("NFC", whole)
    ):
        parts = [
            unicodedata.normalize("NFC", whole[a:b]).replace("İ", "i̇")
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        offsets = tx.offsets_of(np.array([len(p) for p in parts], np.int64))
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
    return tx.lower()[points], offsets


def encode(column: pa.Array, path: str, special: bool = True) -> Encoded:
    """Encode a column of texts; bounded by the column's size. Without ``special`` the strings of
    special tokens are plain text."""
    vocab = vocabulary(path)
    owner, marks = None, None
    pattern = "|".join(map(re.escape, vocab.special))
    if special and vocab.special and pc.any(pc.match_substring_regex(column, pattern)).as_py():
        parts, owner, marks = [], [], []
        for row, value in enumerate(column.to_pylist()):
            found = re.split(f"({pattern})", value or "")
            parts += found[::2]
            owner += [row] * len(found[::2])
            marks += [vocab.special[s] for s in found[1::2]] + [-1]
        rows, column = len(column), pa.array(parts, pa.large_string())
    points, offsets = tx.code_points(*tx.utf8(column))
    if vocab.word_ends:
        points, offsets = _normal(points, offsets)
    starts, ends, first = cut_words(points, offsets, vocab.word_ends)
    codes, distinct = pd.factorize(tx.span_hashes(points, starts, ends))
    where = np.empty(len(distinct), np.int64)
    where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    lengths = (ends - starts)[where]
    inner = points[tx.ragged(starts[where], lengths)]
    sizes = 1 + (inner >= 0x80) + (inner >= 0x800) + (inner >= 0x10000)
    word_offsets = tx.offsets_of(sizes)[tx.offsets_of(lengths)]
    flat = np.frombuffer(inner.tobytes().decode("utf-32-le").encode(), np.uint8)
    ids, id_offsets = merge_all(vocab, flat, word_offsets)
    if owner is not None:
        special = np.array(sorted(set(marks) - {-1}), np.int64)
        marks = np.array(marks)
        add = np.flatnonzero(marks >= 0)
        codes = np.insert(
            codes, first[add + 1], len(distinct) + np.searchsorted(special, marks[add])
        )
        shifted = first + np.r_[0, np.cumsum(marks >= 0)]
        first = shifted[np.searchsorted(np.array(owner), np.arange(rows + 1))]
        ids = np.r_[ids, special.astype(ids.dtype)]
        id_offsets = np.r_[id_offsets, id_offsets[-1] + np.arange(1, len(special) + 1)]
    return Encoded(codes, first, ids, id_offsets)


def round_trip(docs: DataFrame, path: str, *, id_column: str = "doc_id") -> DataFrame:
    """Encode every text and decode the ids again: one row (id, n_tokens, ids, decoded)
    per document, ``ids`` as decimal numbers joined by commas. Documents are kept as they
    come: repeated rows give repeated rows, a null id stays null, other columns are left out."""
    source = docs.select(id_column, "text")
    kind = source.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, SLICE):
            yield from _strings(batch, path, id_column)

    return source.mapInArrow(run, f"{id_column} {kind}, n_tokens long, ids string, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document's round trip; the
    strings of ``round_trip`` are hashed where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, SLICE):
            yield from _strings(batch, path, "doc_id", hashed=True)

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
        "ids_sha256 string, decoded_sha256 string",
    )


def _strings(batch: pa.RecordBatch, path: str, id_column: str, hashed: bool = False):
    vocab = vocabulary(path)
    found = encode(batch.column("text"), path)
    bounds = found.offsets.tolist()
    listed = found.ids.tolist()
    numbers = [str(i) for i in range(len(vocab.pieces))]
    words = [listed[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    decimal = np.array([",".join([numbers[i] for i in w]) for w in words] or [""], object)
    pieces = vocab.pieces
    decoded = np.array([b"".join([pieces[i] for i in w]) for w in words] or [b""], object)
    sizes = np.diff(found.offsets)
    step, n = 512, batch.num_rows
    for low in range(0, n, step):
        high = min(n, low + step)
        counts, ids, texts = [], [], []
        for a, b in zip(found.first[low:high], found.first[low + 1 : high + 1], strict=True):
            codes = found.codes[a:b]
            counts.append(int(sizes[codes].sum()))
            one = ",".join(decimal[codes].tolist())
            two = b"".join(decoded[codes].tolist()).decode("utf-8", "replace")
            if hashed:
                one = hashlib.sha256(one.encode()).hexdigest()
                two = hashlib.sha256(two.encode()).hexdigest()
            ids.append(one)
            texts.append(two)
        names = ("ids_sha256", "decoded_sha256") if hashed else ("ids", "decoded")
        yield pa.RecordBatch.from_pydict(
            {
                id_column: batch.column(id_column).slice(low, high - low),
                "n_tokens": pa.array(counts, pa.int64()),
                names[0]: pa.array(ids, pa.string()),
                names[1]: pa.array(texts, pa.string()),
            }
        )
