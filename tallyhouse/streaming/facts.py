"""The fact as a stream of drops: each new file is priced and added once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import parse
from tallyhouse.plans import jobs


def load_fact_stream(
    spark: SparkSession,
    src: str,
    products: DataFrame,
    countries: DataFrame,
    fact: str,
    errors: str,
    store: str,
    as_of: jobs.AsOf = None,
    max_files: int | None = None,
    **options,
) -> None:
    """Load the files of ``src`` that were not loaded yet into ``fact`` and ``errors``, and stop.

    The checkpoint below ``store`` numbers the batches and remembers their files, so old files are not read again, and a
    batch that is replayed after a stop has the same lines and number as before;
    ``jobs.load_fact_increment`` adds it once.
    """
    store = store.rstrip("/")

    def load(lines: DataFrame, batch_id: int) -> None:
        tagged = parse.tag_transactions(lines, as_of)
        usable = tagged.filter(F.col(parse.REASON).isNull()).select(*schemas.TRANSACTIONS.names)
        jobs.load_fact_increment(
            usable, batch_id, products, countries, fact, errors, store, as_of, **options
        )

    reader = spark.readStream.schema(schemas.LINES).format("text")
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    (
        reader.load(src)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{store}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    # the stream works in a session of its own; this one may know files that were replaced
    for table in (fact, errors):
        spark.catalog.refreshTable(table)
