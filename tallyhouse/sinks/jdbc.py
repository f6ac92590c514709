"""JDBC sink: a plain write, and one that is staged and moved in one transaction."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "stage_row"


def jdbc_options(
    props: Mapping[str, str], batch_size: int = 10_000, connections: int = 16
) -> dict[str, str]:
    """Connection properties plus: keep the table's keys and defaults on overwrite,
    send rows in batches, bound the number of parallel connections."""
    return {
        "truncate": "true",
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **{key: str(value) for key, value in props.items()},
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    props: Mapping[str, str],
    mode: str = "overwrite",
    **sizes: int,
) -> None:
    df.write.jdbc(url, table, mode=mode, properties=jdbc_options(props, **sizes))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def move_statements(
    table: str, stage: str, columns: Sequence[str], keys: Sequence[str] | None
) -> list[str]:
    """SQL that moves the staged rows into ``table``: all of it replaced (no ``keys``), or rows of the
    same keys. NULL keys are equal. ``DISTINCT`` over the row's number drops what a repeated task sent again."""
    listed = ", ".join(map(_quoted, columns))
    remove = f"DELETE FROM {table}"
    if keys:
        same = " AND ".join(
            f"(s.{k} = {table}.{k} OR (s.{k} IS NULL AND {table}.{k} IS NULL))" for k in map(_quoted, keys)
        )
        remove += f" WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {same})"
    return [
        remove,
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM "
        f"(SELECT DISTINCT {listed}, {_quoted(ROW)} FROM {stage}) t",
    ]


def move_staged(
    connection, table: str, stage: str, columns: Sequence[str], rows: int, keys: Sequence[str] | None = None
) -> None:
    """Run :func:`move_statements` as one transaction over an open JDBC connection, which is closed. Nothing is
    moved unless the stage holds exactly ``rows`` different rows; the stage is dropped afterwards."""
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            found = statement.executeQuery(f"SELECT COUNT(DISTINCT {_quoted(ROW)}) FROM {stage}")
            found.next()
            held = found.getLong(1)
            if held != rows:
                raise RuntimeError(f"{stage} holds {held} rows instead of {rows}")
            for text in move_statements(table, stage, columns, keys):
                statement.executeUpdate(text)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        statement.executeUpdate(f"DROP TABLE {stage}")
        connection.commit()
    finally:
        connection.close()


def connect(spark: SparkSession, url: str, props: Mapping[str, str]):
    """A JDBC connection of the driver, for statements only; rows go from the executors."""
    jvm = spark._jvm
    if "driver" in props:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(props["driver"])
    given = jvm.java.util.Properties()
    for key, value in props.items():
        given.setProperty(key, str(value))
    return jvm.java.sql.DriverManager.getConnection(url, given)


def write_jdbc_once(
    df: DataFrame,
    url: str,
    table: str,
    props: Mapping[str, str],
    folder: str,
    keys: Sequence[str] | None = None,
    write: Callable[..., None] = write_jdbc,
    open_connection: Callable = connect,
    **sizes: int,
) -> int:
    """Replace the rows of ``table``, or upsert those of ``keys``, so that tasks that run again double nothing and a
    stop leaves the old table. Returns the number of rows.

    The rows are numbered and written to ``folder``, which all executors share, so a repeated task sends
    the same rows with the same numbers. They go to ``<table>_stage`` in parallel and are moved from there by
    one transaction of the database. One row per key is expected. One writer at a time.
    """
    spark = df.sparkSession
    numbered = df.withColumn(ROW, F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(numbered.schema).parquet(folder)
    n, stage = rows.count(), f"{table}_stage"
    write(rows, url, stage, {**props, "truncate": "false"}, mode="overwrite", **sizes)
    move_staged(open_connection(spark, url, props), table, stage, df.columns, n, keys)
    return n
