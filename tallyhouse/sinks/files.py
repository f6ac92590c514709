"""File sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_lines(
    df: DataFrame, path: str, n_files: int | None = None, compression: str | None = None
) -> None:
    """Text files of the ``value`` column, replacing ``path``.

    ``n_files`` limits the number of files, and with it the number of tasks. ``compression`` is a codec of
    Spark's text files; a file of most of them is read by one task.
    """
    out = df.select("value")
    out = out.coalesce(n_files) if n_files else out
    out.write.mode("overwrite").option("compression", compression or "none").text(path)


def write_partitioned(df: DataFrame, ts: str, path: str, mode: str = "overwrite") -> None:
    """Parquet in ``year=/month=`` folders.

    The rebalance hint gathers each month into few files and lets adaptive
    execution split a month that is too large for one task.
    """
    day = F.to_date(ts)
    dated = df.withColumns({"year": F.year(day), "month": F.month(day)})
    (
        dated.hint("rebalance", "year", "month")
        .write.mode(mode)
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_by_outcome(tagged: DataFrame, message: str, path: str, mode: str = "overwrite") -> None:
    """One pass over ``tagged``: rows without ``message`` go to ``outcome=valid``,
    the others to ``outcome=error``."""
    outcome = F.when(F.col(message).isNull(), "valid").otherwise("error")
    tagged.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").parquet(path)


def read_outcome(spark, path: str, outcome: str) -> DataFrame:
    """``valid`` or ``error`` rows; other folders are not read."""
    return spark.read.parquet(path).filter(F.col("outcome") == outcome).drop("outcome")


def snapshot(df: DataFrame, path: str, day: dt.date | str) -> None:
    """Compressed copy in ``snapshot_date=day``; a second run replaces that day only."""
    (
        df.withColumn("snapshot_date", F.lit(str(day)).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def retain_recent(
    df: DataFrame, day_col: str, as_of: dt.date | str | Column, days: int = 7
) -> DataFrame:
    """Rows at most ``days`` days old; on a snapshot folder this prunes partitions."""
    today = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    return df.filter(F.col(day_col) >= F.date_sub(today, days))



def expire_snapshots(
    spark: SparkSession, path: str, as_of: dt.date | str, days: int = 7, column: str = "snapshot_date"
) -> list[str]:
    """Delete the snapshot folders that are more than ``days`` days old; returns their days.

    A folder is first renamed to a hidden name, one step of the file system after which no reader sees it, and
    then deleted. A stop between the two leaves a hidden folder, which the next run deletes; a stop
    anywhere loses no valid day. Only folder names are listed.
    """
    last = dt.date.fromisoformat(str(as_of)) - dt.timedelta(days=days)
    place = spark._jvm.org.apache.hadoop.fs.Path
    root = place(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    expired = []
    for status in system.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"_expired-{column}="):
            system.delete(status.getPath(), True)
            continue
        if not name.startswith(f"{column}="):
            continue
        try:
            day = dt.date.fromisoformat(name.partition("=")[2])
        except ValueError:  # rows without a day
            continue
        if day < last:
            hidden = place(root, f"_expired-{name}")
            if not system.rename(status.getPath(), hidden):
                raise OSError(f"{name} could not be renamed")
            system.delete(hidden, True)
            expired.append(day.isoformat())
    return sorted(expired)
