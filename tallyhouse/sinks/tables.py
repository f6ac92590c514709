"""Catalog table sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.upsert import held_partitions, key_hash, upsert


def create_table(spark, table: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Empty Parquet table with ``schema`` unless it exists; the columns of ``partition_by`` come last."""
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema).write.format("parquet")
        (empty.partitionBy(*partition_by) if partition_by else empty).saveAsTable(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    """Inserts go by position, so name the columns in the table's own order."""
    return df.select(*df.sparkSession.table(table).columns)


def append(df: DataFrame, table: str) -> None:
    _in_table_order(df, table).write.insertInto(table)


def overwrite(df: DataFrame, table: str) -> None:
    """Replace the rows of ``table`` with ``df``, which must not read ``table``."""
    _in_table_order(df, table).write.insertInto(table, overwrite=True)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``df`` has rows for; ``df`` must not read ``table``."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        overwrite(df, table)
    finally:
        spark.conf.set(mode, before)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows that are no longer read."""
    _delete(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def replace_table(df: DataFrame, table: str) -> None:
    """Replace ``table`` by ``df`` even when ``df`` reads it.

    The new rows are written beside the old ones and the table is pointed at them in one
    step of the catalog; then the old files are deleted, if as many rows are read back as were written.
    Until that step the table is the old one, after it the new one: a stop at any point leaves no more than
    unused files, and readers always find a table. A partitioned table keeps its partitions: its new rows are
    staged and swapped in, see :func:`finish_swap`. Nothing passes through the driver.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    if parts:
        finish_swap(spark, table)
        old = spark.table(table).select(*parts).distinct()
        _stage_swap(_in_table_order(df, table), table, parts, [row.asDict() for row in old.collect()])
        finish_swap(spark, table)
        return
    old = _location(spark, table).rstrip("/")
    fresh = f"{old.partition('__v_')[0]}__v_{uuid.uuid4().hex}"
    written = Observation()
    counted = _in_table_order(df, table).observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.parquet(fresh)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)
    if spark.table(table).count() != written.get["n"]:
        raise RuntimeError(f"{table} does not hold what was written; the old files are in {old}")
    _delete(spark, old)


def _stage(spark: SparkSession, table: str) -> str:
    """The folder beside the table in which its next rows wait."""
    return f"{_location(spark, table).rstrip('/').partition('__v_')[0]}__swap"


def _stage_swap(
    rows: DataFrame, table: str, parts: Sequence[str], touched: Sequence[dict]
) -> None:
    """Write all rows of the ``touched`` partitions beside the table, then the list of these that are empty
    from now on. The list is the last step: with it the swap will be done, without it it never was."""
    spark = rows.sparkSession
    stage = _stage(spark, table)
    gathered = rows.hint("rebalance", *parts)
    gathered.write.mode("overwrite").partitionBy(*parts).parquet(f"{stage}/rows")
    filled = spark.read.schema(rows.schema).parquet(f"{stage}/rows").select(*parts).distinct().collect()
    held = [row.asDict() for row in filled]
    gone = [p for p in touched if p not in held]
    schema = rows.select(*parts).schema
    emptied = spark.createDataFrame([tuple(p[c] for c in parts) for p in gone], schema)
    emptied.coalesce(1).write.mode("overwrite").parquet(f"{stage}/emptied")


def _list_partitions(parts: DataFrame, path: str) -> list[dict]:
    """The distinct ``parts``, written as the last step of a stage of new rows."""
    found = parts.distinct().collect()
    listed = parts.sparkSession.createDataFrame([tuple(row) for row in found], parts.schema)
    listed.coalesce(1).write.mode("overwrite").parquet(path)
    return [row.asDict() for row in found]


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files of a partitioned folder into the same partitions of another one of its file system. Their
    names are unique, so after a stop only those that were not moved are still there to be moved."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    root = place(source)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    root = system.makeQualified(root).toString().rstrip("/") + "/"
    found, listed = [], system.listFiles(place(source), True)
    while listed.hasNext():
        path = listed.next().getPath()
        if not path.getName().startswith(("_", ".")):
            found.append((path, place(place(target), path.toString().removeprefix(root))))
    for folder in {to.getParent().toString() for _, to in found}:
        system.mkdirs(place(folder))
    for path, to in found:
        if not system.rename(path, to):
            raise OSError(f"{path.toString()} could not be moved")


def _spec(row: dict, kinds: dict) -> str:
    return ", ".join(f"`{c}` = {_literal(row[c], kind)}" for c, kind in kinds.items())


def _finish_insert(spark: SparkSession, table: str) -> bool:
    """Move staged rows that replace none into the table; False when there are none."""
    stage = _stage(spark, table)
    if not path_exists(spark, f"{stage}/inserted/_SUCCESS"):
        return False
    schema = spark.table(table).schema
    kinds = {c: schema[c].dataType for c in partition_columns(spark, table)}
    _move_files(spark, f"{stage}/fresh", _location(spark, table))
    listed = spark.read.schema(T.StructType([schema[c] for c in kinds])).parquet(f"{stage}/inserted")
    specs = [f"PARTITION ({_spec(row.asDict(), kinds)})" for row in listed.collect()]
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs)}")
    spark.catalog.refreshTable(table)
    _delete(spark, stage)
    return True


def finish_swap(spark: SparkSession, table: str) -> bool:
    """Do a staged swap of partitions, or the rest of it after a stop; False when there is none. Staged rows that
    replace none are moved into their partitions instead.

    Staged partitions replace those of the table one by one (dynamic partition overwrite), those that lost all of
    their rows are dropped, and the stage is deleted. Doing it again changes nothing, so after a stop anywhere the
    next call, here or at the next write, completes it. Untouched partitions keep their files.
    """
    if _finish_insert(spark, table):
        return True
    stage = _stage(spark, table)
    if not path_exists(spark, f"{stage}/emptied/_SUCCESS"):
        if path_exists(spark, stage):
            _delete(spark, stage)
        return False
    parts = partition_columns(spark, table)
    schema = spark.table(table).schema
    rows = spark.read.schema(schema).parquet(f"{stage}/rows")
    overwrite_partitions(rows, table)
    kinds = {c: schema[c].dataType for c in parts}
    for row in spark.read.schema(T.StructType([schema[c] for c in parts])).parquet(f"{stage}/emptied").collect():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(row.asDict(), kinds)})")
    spark.catalog.refreshTable(table)
    _delete(spark, stage)
    return True


def _literal(value, kind: T.DataType) -> str:
    """A partition value as the catalog reads it."""
    if value is None:
        return "NULL"
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"{'DATE' if isinstance(kind, T.DateType) else ''}'{text}'"


def _in_partitions(parts: Sequence[dict]) -> Column:
    """Whether a row is in one of the partitions, as a test that prunes them."""
    tests = [
        reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in p.items()]) for p in parts
    ]
    return reduce(Column.__or__, tests, F.lit(False))


def _all_new(fresh: DataFrame, target: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no key of ``fresh`` is repeated or in ``target``. Hashes of the keys are counted, so unequal keys of
    one hash may deny it, which costs time only."""
    key, zero, one = key_hash(keys).alias("_key"), F.lit(0), F.lit(1)
    both = fresh.select(key, one.alias("_new"), zero.alias("_old")).unionByName(
        target.select(key, zero.alias("_new"), one.alias("_old"))
    )
    sums = both.groupBy("_key").agg(F.sum("_new").alias("_new"), F.max("_old").alias("_old"))
    return sums.where((F.col("_new") > 1) | ((F.col("_new") > 0) & (F.col("_old") > 0))).isEmpty()


def upsert_table(df: DataFrame, table: str, keys: Sequence[str], gather: bool = True) -> None:
    """Insert ``df`` into ``table``, replacing rows of the same key (NULLs are equal); a second run of the
    same rows changes nothing.

    Of a partitioned table only the partitions that hold an updated key, or get one, are read and rewritten.
    Where a partition column is no key, the keys of the table are read to find them. Rows whose keys are all new
    are written once, beside the table, and their files moved into it: nothing is rewritten.
    ``gather=False`` keeps the rows in their tasks, for callers that have few large ones; otherwise the rows of a
    partition are brought together first.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    target = spark.table(table)
    order = [F.desc(name) for name in sorted(set(target.columns) - set(keys))]
    if not parts:
        replace_table(upsert(target, df, keys, order), table)
        return
    finish_swap(spark, table)
    target = spark.table(table)
    # written once: it is read several times, and may read the table
    path = f"{_stage(spark, table)}/fresh"
    rows = df.select(*target.columns)
    rows = rows.hint("rebalance", *parts) if gather else rows
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*parts).parquet(path)
    fresh = spark.read.schema(target.schema).parquet(path)
    filled = [row.asDict() for row in fresh.select(*parts).distinct().collect()]
    pruned = set(parts) <= set(keys)
    if filled and _all_new(fresh, target.where(_in_partitions(filled)) if pruned else target, keys):
        _list_partitions(fresh.select(*parts), f"{_stage(spark, table)}/inserted")
        finish_swap(spark, table)
        return
    touched = fresh.select(*parts).distinct()
    if not pruned:
        touched = touched.union(held_partitions(target, fresh, keys, parts)).distinct()
    touched = [row.asDict() for row in touched.collect()]
    if touched:
        rows = upsert(target.where(_in_partitions(touched)), fresh, keys, order)
        _stage_swap(rows, table, parts, touched)
    finish_swap(spark, table)


def write_if_any(df: DataFrame, sink: Callable[[DataFrame], None], stage: str) -> bool:
    """Run ``sink`` only when ``df`` has a row; False when it had none.

    The rows are written to ``stage``, a folder all executors share, and both the test and
    the sink read them there, so ``df`` is computed once.
    """
    df.write.mode("overwrite").parquet(stage)
    staged = df.sparkSession.read.schema(df.schema).parquet(stage)
    if staged.isEmpty():
        return False
    sink(staged)
    return True
