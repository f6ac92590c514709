"""What the queries of this subpackage share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers also look for this package where the driver has it, for sessions
    that were started without a PYTHONPATH."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        path = os.pathsep.join([*filter(None, known), _ROOT])
        spark.sparkContext.environment["PYTHONPATH"] = path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where unset;
    both are shared by all executors."""
    root = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    )
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: computed once, and safe
    from the loss of executors."""
    return staged_at(df)[0]


def staged_at(df: DataFrame) -> tuple[DataFrame, str]:
    """As ``staged``, and the folder, for those who know when it is no longer read."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def row_key(docs: DataFrame, name: str) -> DataFrame:
    """Add a 64-bit key of id and text; only equal rows share one."""
    return docs.withColumn(name, F.xxhash64(F.col("doc_id"), F.lit("|"), F.col("text")))


def plain(docs: DataFrame, *used: str) -> DataFrame:
    """The documents with all columns but ``used`` named by their place, so that no name can clash or needs quotes."""
    return docs.toDF(*[c if c in used else f"_kept_{i}" for i, c in enumerate(docs.columns)])


def map_kept(df: DataFrame, run, added: str) -> DataFrame:
    """``mapInArrow`` that keeps all columns in their order, whatever their names, and adds some."""
    plain = [f"_column_{i}" if set(c) & set(".`") else c for i, c in enumerate(df.columns)]
    kept = ", ".join(
        f"`{c}` {f.dataType.simpleString()}" for c, f in zip(plain, df.schema, strict=True)
    )
    mapped = df.toDF(*plain).mapInArrow(run, f"{kept}, {added}")
    return mapped.toDF(*df.columns, *mapped.columns[len(plain) :])


def whole_groups(batches: Iterator[pa.RecordBatch], column: str, least: int = 20_000):
    """Tables of about ``least`` rows that hold whole groups, from batches sorted by
    ``column`` (equal values side by side)."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < least:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])
        if last == 0 and len(held) == 1:
            continue  # the group goes on
        if last == 0:
            before = held[-2].column(column)[-1].as_py()
            if before == keys[0]:
                continue
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, last)])
        held = [batch.slice(last)]
        n = held[0].num_rows
    if held:
        yield pa.Table.from_batches(held)
