"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """First row of each key under ``order`` (name a total order, newest first).

    The rank filter sits directly on the window, so Spark keeps one row per key
    and map task before it shuffles; a hot key does not reach one task whole.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(by))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct non-NULL values of a key (combined map-side before the shuffle)."""
    return df.select(*keys).dropna(subset=list(keys)).distinct()
