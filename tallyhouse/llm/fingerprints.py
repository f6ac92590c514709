"""Document fingerprints: bottom-k sketches of shingle hashes, by SQL functions only.

A shingle is a run of five words; at a document's start it is shorter, so that a text of
n words has n shingles and short texts have some too. The sketch is the ascending array of
the k smallest distinct 64-bit hashes. Sketches of parts merge into the sketch of the whole
(of its parts' shingles), and give estimates of resemblance, containment and the number of
distinct shingles; below k shingles these are exact.

Null and empty texts have an empty sketch; two empty sketches resemble each other fully,
an empty and another one not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 64
WORDS = 5
HEAD = 32
BLANK = r"[ \t\n\x0B\f\r]+"


def with_sketch(df: DataFrame, text: str, name: str, *, k: int = K) -> DataFrame:
    """Add the sketch of a text column. In steps, since a column that a lambda names is
    evaluated once, an expression for every element."""
    hashes, padded = f"_h_{name}", f"_p_{name}"
    words = F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")
    ahead = F.array(*[F.lit(0).cast("long")] * (WORDS - 1))
    return (
        df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn(padded, F.concat(ahead, hashes))
        .withColumn(
            name,
            F.transform(
                hashes,
                lambda h, i: F.xxhash64(*[F.col(padded)[i + j] for j in range(WORDS - 1)], h),
            ),
        )
        .withColumn(name, F.slice(F.sort_array(F.array_distinct(name)), 1, k))
        .drop(hashes, padded)
    )


def merged(a: Column | str, b: Column | str, *, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column | str, b: Column | str, *, k: int = K) -> Column:
    """Estimated share of common shingles among the shingles of both."""
    both = merged(a, b, k=k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))


def distinct_shingles(a: Column | str, *, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = F.element_at(a, -1) / F.lit(2.0**64) + 0.5
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column | str, b: Column | str, *, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that are in ``b``."""
    found = resemblance(a, b, k=k) * distinct_shingles(merged(a, b, k=k), k=k)
    share = found / distinct_shingles(a, k=k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def as_text(sketch: Column | str) -> Column:
    """16 hexadecimal digits per hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


ORDER = ["o_known", "o_id", "o_head", "o_key"]


def _bucket(bounds: list, lo: int, hi: int) -> Column:
    """Index of the last of ``bounds[lo..hi]`` that is not above the row's order: log(n) comparisons."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi + 1) // 2
    types = ["boolean", "long", "string", "binary"]
    bound = F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(bounds[mid], types, ORDER, strict=True)])
    return F.when(F.struct(*ORDER) >= bound, _bucket(bounds, mid, hi)).otherwise(_bucket(bounds, lo, mid - 1))


def with_next(docs: DataFrame, *, rows: int = 1 << 18, k: int = K) -> DataFrame:
    """(doc_id, text, sketch, next) of documents (doc_id, text, ...): ``next`` holds text and sketch of the document with the next
    larger id (after the last: the first one's). Rows of equal id follow each other in the order of the first ``HEAD``
    characters of their texts, then of a hash; null ids come first. Equal rows follow each other.

    The bounds of buckets come from the distinct (id, beginning, hash) by range, at most about ``rows`` to a bucket
    whatever the ids are and however often one occurs, and reach the rows as a comparison tree. So texts are shuffled once,
    to their bucket, where each is followed by the next; the last of a bucket by the first of the next bucket, which is
    looked up once per bucket. Sketches are made where they are needed.
    """
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), "text")
    keyed = docs.select(
        "doc_id",
        "text",
        F.col("doc_id").isNotNull().alias("o_known"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("o_id"),
        F.coalesce(F.substring("text", 1, HEAD), F.lit("")).alias("o_head"),
        F.coalesce(F.unhex(F.md5(name)), F.unhex(F.lit(""))).alias("o_key"),
    )
    spark = docs.sparkSession
    buckets = max(1, -(-docs.count() // rows), spark.sparkContext.defaultParallelism)
    light = keyed.select(*ORDER).distinct().repartitionByRange(buckets, *ORDER)
    # the first of each non-empty bucket, one row per bucket
    firsts = light.groupBy(F.spark_partition_id().alias("b")).agg(F.min(F.struct(*ORDER)).alias("f"))
    bounds = [tuple(r.f) for r in sorted(firsts.collect(), key=lambda r: r.b)]
    if not bounds:
        bounds = [(False, 0, "", b"")]
    m = len(bounds)
    placed = keyed.withColumn("bucket", _bucket(bounds, 0, m - 1))
    types = ["boolean", "long", "string", "binary", "int"]
    heads = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip((*b, (i - 1) % m), types, [*ORDER, "prev"])])
                    for i, b in enumerate(bounds)
                ]
            )
        )
    )
    # the text of each bucket's first row, for the last row of the bucket before it
    ahead = (
        placed.join(F.broadcast(heads), ORDER)
        .groupBy("prev")
        .agg(F.first("text").alias("ahead"))
    )
    by = W.partitionBy("bucket").orderBy(*ORDER)
    # a lead of the text itself, so that it is not copied before the shuffle; the marker is never null
    linked = placed.withColumn("after", F.lead("text").over(by)).withColumn("last", F.lead("o_known").over(by).isNull())
    pairs = linked.join(F.broadcast(ahead), F.col("bucket") == F.col("prev"), "left").select(
        "doc_id",
        "text",
        F.when(F.col("last"), F.col("ahead")).otherwise(F.col("after")).alias("next_text"),
    )
    both = with_sketch(with_sketch(pairs, "text", "sketch", k=k), "next_text", "next_sketch", k=k)
    following = F.struct(F.col("next_text").alias("text"), F.col("next_sketch").alias("sketch"))
    return both.select("doc_id", "text", "sketch", following.alias("next"))


def fingerprints(docs: DataFrame, *, k: int = K) -> DataFrame:
    """(doc_id, text, sketch) of every document."""
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_sketch(source, "text", "sketch", k=k)
