"""Text drops: one record per line in ``value``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str, with_source: bool = False) -> DataFrame:
    """Lines of a file, directory or glob; ``source_file`` on request."""
    lines = spark.read.text(path)
    if with_source:
        return lines.selectExpr("value", "_metadata.file_path AS source_file")
    return lines


def drop_path(root: str, name: str, day: dt.date | str) -> str:
    """Folder of one day's drop: ``root/name/name_YYYY-MM-DD``."""
    return f"{root.rstrip('/')}/{name}/{name}_{day}"


def read_drop(spark: SparkSession, root: str, name: str, day: dt.date | str) -> DataFrame:
    """Lines of one day's drop only."""
    return read_lines(spark, drop_path(root, name, day))
