"""A corpus pipeline over ``documents``: known languages, no aligned common lines, one
document of each near-duplicate class, no repeated passages, packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its
result is written as Parquet and read again. All but the last return the columns of
``documents``. Null texts are unknown languages and go in the first stage; empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import jaccard, langid, lines, packing, substrings
from tallyhouse.llm.common import discard, ship, staged_at, table, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages of the corpus and name that of each text, where its ``lang`` is missing or contradicted;
    texts without a letter or without text go."""
    ship(spark)
    return langid.keep_known(docs.select(*COLUMNS), langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete lines aligned with an earlier document; documents that lose all lines go."""
    ship(spark)
    rows = lines.remove_common_lines(docs.select(*COLUMNS))
    return _documents(rows.where("n_removed < n_lines or n_lines = 0"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies."""
    ship(spark)
    return jaccard.one_per_class(docs.select(*COLUMNS), threshold=0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of 35 words and more that stand elsewhere too; documents that lose all
    words go."""
    ship(spark)
    rows = substrings.remove_repeats(docs.select(*COLUMNS), window=35)
    return _documents(rows.where("n_removed < n_words or n_words = 0"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with the language that the first stage found for their document."""
    ship(spark)
    pieces = packing.pack(docs, tokenizer("word_bpe_49k.json"), window=2048, end_id=1, keep=["lang"])
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "lang",
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

# Kernels, min-hashes and tokenizers are beyond SQL; tests/llm compares each stage with a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, written = staged_at(stage(spark, docs, sf_dir))
        if read:
            discard(spark, read)
        read = written
    return STAGES[-1][1](spark, docs, sf_dir)
