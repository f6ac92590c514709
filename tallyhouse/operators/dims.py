"""Gold dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.fixed_values import DEFAULT_CURRENCY
from tallyhouse.operators.dedup import distinct_keys
from tallyhouse.operators.parse import REASON, tag_countries
from tallyhouse.operators.scd import scd0_latest, scd2_intervals


def dim_products(history: DataFrame, currency: str = DEFAULT_CURRENCY) -> DataFrame:
    """Product versions with their validity interval."""
    return (
        scd2_intervals(history)
        .withColumn("currency", F.lit(currency))
        .select(*schemas.DIM_PRODUCTS.names)
    )


def dim_countries(
    lines: DataFrame, newest_first: Sequence[Column | str] | None = None
) -> DataFrame:
    """Country lines to the overwrite dimension: one row per country_id.

    ``newest_first`` orders the lines of one country by their own columns, e.g. a
    load day next to ``value``; without it the name decides.
    """
    rows = tag_countries(lines).filter(F.col(REASON).isNull())
    order = list(newest_first or []) + [F.desc("country_name")]
    return scd0_latest(rows, "country_id", order).select(*schemas.DIM_COUNTRIES.names)


def dim_customers(tx: DataFrame) -> DataFrame:
    """Distinct customers."""
    return distinct_keys(
        tx.select(F.col("customer_id").cast("string").alias("customer_id")), "customer_id"
    )
