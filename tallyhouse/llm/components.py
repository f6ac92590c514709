"""Connected components of a large graph, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import discard, staged_at
from tallyhouse.operators.joins import join_by_key


def _stars(edges: DataFrame) -> DataFrame:
    """One round of large stars, then small stars, over (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        join_by_key(both, least, ["u"])
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    small = join_by_key(large, down, ["u"])
    return (
        small.where("v != m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(down.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v): the smallest node that can be
    reached. Rounds of alternating stars until nothing changes; each round is written to the
    shared folder, where it replaces the one before, and only a count and a checksum come to the driver."""
    ordered = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    (current, path), before = staged_at(ordered.distinct()), None
    while True:
        seen = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == before or not seen[0]:
            break
        before = seen
        used = path
        current, path = staged_at(_stars(current))
        discard(edges.sparkSession, used)
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def spread(df: DataFrame, group: str, member: str, parts: str, name: str) -> DataFrame:
    """Cut each ``group`` into ``parts`` blocks (a column) by a hash of ``member``, and give every row
    to each pair of blocks that holds its own. Adds ``name``, the id of the pair, and
    ``block``, 0 or 1: its side of the pair. Every two members of a group share at least one pair;
    pairs of a block with itself have block 0 only."""
    own = F.pmod(F.xxhash64(member), F.col(parts))
    pairs = df.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))
    )
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return (
        pairs.withColumn(name, F.xxhash64(group, low, high))
        .withColumn("block", F.when(F.col("_own") == low, 0).otherwise(1))
        .withColumn("crossed", F.col("_own") != F.col("_other"))
        .drop("_own", "_other")
    )
