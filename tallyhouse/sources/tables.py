"""Catalog tables and views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def is_bootstrap(spark: SparkSession, table: str) -> bool:
    """True when ``table`` is missing or has no row."""
    return not spark.catalog.tableExists(table) or spark.table(table).isEmpty()


def table_or_default(spark: SparkSession, table: str, default: DataFrame) -> DataFrame:
    """``table``, or ``default`` when the table is missing or empty."""
    return default if is_bootstrap(spark, table) else spark.table(table)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Temporary views for ad-hoc ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
