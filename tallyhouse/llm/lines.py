"""Line dedup by pairwise alignment.

Documents with the same lines in the same order are one here: all but the first of them lose all of their lines, and only
the first is compared with others. Documents that overlap are found through shared rare lines: a line in at most
``rare`` different documents links each of them with every earlier one, so these alignments are complete. ``rare=None``
takes every line for rare: the exact mode, in which every two documents that share a line are aligned and nothing below
applies. Its links grow with the square of the documents of a line, so it is for tables in which no line is in very many.

Of a frequent line every document is linked with the one before it (in the order of id) that has it too, so a line
in n documents gives n - 1 links. Such a link counts if the line is long (``LONG`` characters), and all links of a document
count if half of its lines stand in earlier documents, in one or in several.

Other frequent lines count in pairs: a frequent line and any other repeated line of a document
are linked, as one, with the document before it that has both. So a frequent line is aligned
wherever one earlier document shares it and a second line. A pair is taken in its order and
without order, since an alignment needs the order. Documents with the same sequence of repeated
lines, each once, are linked through the sequence, and only the first of them lists its pairs. Their
number grows with the frequent lines of a document times its repeated lines, not with the
documents that share a line.

The documents of a counted link are aligned with patience diff: equal lines at both ends,
then lines that are unique on both sides and in the same order (a longest increasing
sequence), then the gaps between them in the same way. Runs of aligned lines with at least one
line that is not blank are common blocks, and they are deleted from the later document.
Frequent lines in otherwise different documents stay.

A line, pair or sequence in many documents is cut into groups of ``group`` by a hash of the document; the
first of each group is linked with the first document of all. So no window holds more than
a group, and copies of one text still meet in all of their lines.

Null and empty texts have no lines. Rows of equal id and text are one document here: they
get the same result. Rows of equal id and different texts are ordered by a hash of the
text; null ids come first. Other columns are kept, ``n_lines`` and ``n_removed`` are added.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import plain, row_key, staged
from tallyhouse.operators.joins import join_by_key

RARE = 16
LONG = 100
GROUP = 8192
KEY, GONE, LINES = "_line_key", "_line_gone", "_line_split"


def split_lines(text: str) -> Column:
    lines = F.split(F.col(text), "\n", -1)
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, lines).otherwise(
        F.array().cast("array<string>")
    )


def line_hashes(lines: Column) -> Column:
    """Hash of each line, odd for lines of ``LONG`` characters and more; blank lines have 0."""

    def one(line: Column) -> Column:
        even = F.xxhash64(line).bitwiseAND(F.lit(-2))
        return even.bitwiseOR((F.length(line) >= LONG).cast("long"))

    return F.transform(
        lines,
        lambda line: F.when(F.translate(line, " \t\r", "") == "", F.lit(0).cast("long")).otherwise(
            one(line)
        ),
    )


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (i, j), sorted by i, with increasing j."""
    tails: list[int] = []
    heads: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back.append(heads[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            heads.append(n)
        else:
            tails[at], heads[at] = j, n
    out, n = [], heads[-1] if heads else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _unique(lines: list[int], low: int, high: int) -> dict[int, int]:
    """Place of each line, without blanks, that stands once in the range."""
    places: dict[int, int] = {}
    for i in range(low, high):
        places[lines[i]] = -1 if lines[i] in places else i
    places.pop(0, None)
    return {line: i for line, i in places.items() if i >= 0}


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (i, j) with a[i] == b[j], both increasing."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, n, j, m = work.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append((n, m))
        if i == n or j == m:
            continue
        left, right = _unique(a, i, n), _unique(b, j, m)
        common = sorted((left[x], right[x]) for x in left.keys() & right.keys())
        anchors = _increasing(common)
        if not anchors:
            continue
        out += anchors
        for x, y in [*anchors, (n, m)]:
            work.append((i, x, j, y))
            i, j = x + 1, y + 1
    return sorted(out)


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Lines of b in aligned common blocks that are not all blank."""
    out: list[int] = []
    block: list[tuple[int, int]] = []
    for pair in [*patience(a, b), (-2, -2)]:
        if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
            if any(b[j] for _, j in block):
                out += [j for _, j in block]
            block = []
        block.append(pair)
    return out


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, KEY, line, ...) whose line is in several documents, with the number
    of these and the least of them."""
    seen = (
        rows.groupBy("line")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(F.col("doc_id"), F.col(KEY))).alias("least"),
        )
        .where("n > 1")
    )
    return join_by_key(rows, seen, ["line"])


def _sequences_and_pairs(shared: DataFrame, rare: int) -> DataFrame:
    """Rows (KEY, doc_id, size, line), where ``line`` stands for all repeated lines of a document
    or for a frequent and another one."""
    line = F.struct("at", (F.col("n") > rare).alias("frequent"), "line")
    # a line that stands twice may be left out of an alignment
    alone = F.when(F.max("again"), F.col(KEY)).otherwise(0)
    sequences = (
        shared.groupBy(KEY, "doc_id", "size")
        .agg(
            F.sort_array(F.collect_list(line)).alias("own"),
            F.max("n").alias("most"),
            alone.alias("alone"),
        )
        .where((F.col("most") > rare) & (F.size("own") > 1))
        .select(KEY, "doc_id", "size", F.xxhash64("own.line", "alone").alias("line"), "own")
    )
    first = sequences.groupBy("line").agg(F.min(F.struct("doc_id", KEY, "size", "own")).alias("first"))
    pairs = (
        first.select("first.*")
        .select(KEY, "doc_id", "size", "own", F.explode("own").alias("x"))
        .select(KEY, "doc_id", "size", "x", F.explode("own").alias("y"))
        .where("x.at < y.at and (x.frequent or y.frequent)")
    )
    low, high = F.least("x.line", "y.line"), F.greatest("x.line", "y.line")
    both = F.array(F.xxhash64("x.line", "y.line"), F.xxhash64(F.lit("any order"), low, high))
    return sequences.drop("own").unionByName(
        pairs.select(KEY, "doc_id", "size", F.explode(both).alias("line"))
    )


def _all_pairs(shared: DataFrame) -> DataFrame:
    """Links of each document with every earlier one that has the line."""
    members = shared.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("doc_id", KEY))).alias("m"))
    later = members.select("m", F.posexplode("m").alias("at", "own")).where("at > 0")
    pairs = later.select("own", F.explode(F.slice("m", F.lit(1), F.col("at"))).alias("other"))
    return pairs.select(
        F.col(f"own.{KEY}").alias("later"), F.col(f"other.{KEY}").alias("earlier")
    ).distinct()


def overlaps(hashed: DataFrame, *, rare: int | None = RARE, group: int = GROUP) -> DataFrame:
    """Links (later, earlier) that count, from rows (doc_id, KEY, hashes) of different line sequences."""
    full = F.array_remove("hashes", 0)
    lines = (
        hashed.select(KEY, "doc_id", F.size(full).alias("all"), F.array_distinct(full).alias("own"))
        .dropDuplicates([KEY])
        .select(
            KEY,
            "doc_id",
            F.size("own").alias("size"),
            (F.col("all") > F.size("own")).alias("again"),
            F.posexplode("own").alias("at", "line"),
        )
    )
    shared = staged(_shared(lines))
    if rare is None:
        return _all_pairs(shared)
    complete = _all_pairs(shared.where(F.col("n") <= rare))
    counts = F.col("line").bitwiseAND(F.lit(1)) == 1
    units = shared.drop("at", "again").withColumns({"single": F.lit(1), "counts": counts}).unionByName(
        _shared(_sequences_and_pairs(shared, rare)).withColumns(
            {"single": F.lit(0), "counts": F.lit(True)}
        )
    )
    parted = units.withColumn("part", F.pmod(F.xxhash64(KEY), F.ceil(F.col("n") / group)))
    order = W.partitionBy("single", "line", "part").orderBy("doc_id", KEY)
    links = (
        parted.withColumn("earlier", F.coalesce(F.lag(KEY).over(order), F.col(f"least.{KEY}")))
        .where(F.col("earlier") != F.col(KEY))
        .groupBy(F.col(KEY).alias("later"), "earlier", "size")
        .agg(F.sum("single").alias("common"), F.max("counts").alias("counts"))
    )
    # a line gives a document at most one link, so the sum is over different lines
    covered = F.sum("common").over(W.partitionBy("later"))
    counted = links.withColumn("copied", covered * 2 >= F.col("size")).where(
        F.col("counts") | F.col("copied")
    )
    return counted.select("later", "earlier").unionByName(complete).distinct()


def _first_of_each(hashed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first document of each line sequence, and (KEY, earlier) of the others."""
    blank = F.size(F.array_remove("hashes", 0)) == 0  # of its own
    named = hashed.dropDuplicates([KEY]).withColumns(
        {
            "one": F.when(blank, F.col(KEY)).otherwise(F.xxhash64("hashes")),
            "two": F.when(blank, F.lit(0)).otherwise(F.xxhash64(F.lit(1), "hashes")),
        }
    )
    first = named.groupBy("one", "two").agg(F.min(F.struct("doc_id", KEY)).alias("first"))
    led = staged(
        join_by_key(named, first, ["one", "two"]).select(
            "doc_id", KEY, "hashes", F.col(f"first.{KEY}").alias("earlier")
        )
    )
    return led.where(F.col(KEY) == F.col("earlier")).drop("earlier"), led.where(F.col(KEY) != F.col("earlier"))


def remove_common_lines(docs: DataFrame, *, rare: int | None = RARE, group: int = GROUP) -> DataFrame:
    """The documents without lines that are aligned with an earlier document. Adds
    ``n_lines`` and ``n_removed``, in place of columns of that name; a text that loses all of
    its lines becomes empty."""
    docs = docs.drop("n_lines", "n_removed")
    names, docs = docs.columns, plain(docs, "doc_id", "text")
    keyed = row_key(docs, KEY)
    hashed = staged(
        keyed.select("doc_id", KEY, line_hashes(split_lines("text")).alias("hashes"))
    )
    arrays, copies = _first_of_each(hashed)
    links = overlaps(arrays, rare=rare, group=group)
    arrays = arrays.select(KEY, "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(
                batch.column("before").to_pylist(), batch.column("after").to_pylist(), strict=True
            )
            yield pa.RecordBatch.from_pydict(
                {
                    KEY: batch.column(KEY),
                    "gone": pa.array([common_lines(a, b) for a, b in pairs], pa.list_(pa.int32())),
                }
            )

    sides = join_by_key(
        join_by_key(
            links.withColumnRenamed("later", KEY),
            arrays.withColumnRenamed("hashes", "after"),
            [KEY],
        ),
        arrays.withColumnRenamed("hashes", "before"),
        {"earlier": KEY},
    )
    every = F.when(F.size("hashes") > 0, F.sequence(F.lit(0), F.size("hashes") - 1))
    gone = (
        sides.select(KEY, "after", "before")
        .mapInArrow(run, f"{KEY} long, gone array<int>")
        .where(F.size("gone") > 0)
        .unionByName(copies.select(KEY, every.alias("gone")))
        .groupBy(KEY)
        .agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias(GONE))
    )
    joined = keyed.join(gone, KEY, "left").withColumn(LINES, split_lines("text"))
    kept = F.when(F.col(GONE).isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(LINES, lambda _, i: ~F.array_contains(F.col(GONE), i)), "\n")
    )
    return joined.select(
        *[kept.alias("text") if c == "text" else c for c in docs.columns],
        F.size(LINES).cast("long").alias("n_lines"),
        F.coalesce(F.size(GONE), F.lit(0)).cast("long").alias("n_removed"),
    ).toDF(*names, "n_lines", "n_removed")
