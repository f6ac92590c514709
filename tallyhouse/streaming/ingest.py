"""Load each dropped file once.

The stream's checkpoint remembers finished files and the file sink commits each
batch once, so a re-run, also after a failure, adds only new files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators.parse import REASON


def ingest_new(
    spark: SparkSession,
    src: str,
    tag: Callable[[DataFrame], DataFrame],
    dst: str,
    checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Append the lines of unseen files in ``src`` to ``dst`` and stop.

    ``tag`` is one of the ``operators.parse.tag_*`` functions. Usable rows land in
    ``dst/outcome=valid``, rejects in ``dst/outcome=error``, from one pass.
    ``max_files`` bounds the files of one batch.
    """
    reader = spark.readStream.schema(schemas.LINES).format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    outcome = F.when(F.col(REASON).isNull(), "valid").otherwise("error")
    query = (
        tag(reader.load(src))
        .withColumn("outcome", outcome)
        .writeStream.format("parquet")
        .partitionBy("outcome")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(dst)
    )
    query.awaitTermination()


def ingest_table(
    spark: SparkSession,
    src: str,
    tag: Callable[[DataFrame], DataFrame],
    table: str,
    store: str,
    max_files: int | None = None,
) -> None:
    """:func:`ingest_new` into ``store``, with ``table`` as a view of the usable rows and
    ``table``_rejects of the others. What was loaded before is not read; equal lines of
    different files are all kept."""
    data = f"{store.rstrip('/')}/data"
    ingest_new(spark, src, tag, data, f"{store.rstrip('/')}/progress", max_files)
    columns = [c for c in tag(spark.createDataFrame([], schemas.LINES)).columns if c != REASON]
    usable = ", ".join(c for c in columns if c != "value" and not c.startswith("_"))
    for name, wanted, outcome in (
        (table, usable, "valid"), (f"{table}_rejects", f"value, {REASON}", "error"),
    ):
        spark.sql(
            f"CREATE OR REPLACE VIEW {name} AS "
            f"SELECT {wanted} FROM parquet.`{data}` WHERE outcome = '{outcome}'"
        )


def new_rows(batch: DataFrame, loaded: DataFrame, key: Sequence[str]) -> DataFrame:
    """Batch form: rows whose natural key is not in ``loaded`` yet (NULLs equal)."""
    seen = loaded.select(*[F.col(name).alias(f"_{name}") for name in key]).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in key]
    condition = same[0]
    for test in same[1:]:
        condition = condition & test
    return batch.join(seen, condition, "left_anti")
