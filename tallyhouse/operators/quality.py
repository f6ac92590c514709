"""Reference checks: tag, split, quarantine, recover.

Each rule is a left join to the distinct keys of a dimension.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.codes import standardise_ids
from tallyhouse.functions.dates import audit_time
from tallyhouse.functions.fixed_values import (
    INVALID_DATE,
    MISSING_COUNTRY,
    MISSING_PRICE,
    MISSING_PRODUCT,
    SENTINEL_DATE,
)
from tallyhouse.functions.texts import from_payload, to_payload
from tallyhouse.operators.dedup import distinct_keys
from tallyhouse.operators.joins import join_by_key

ERROR, DATE_FLAG = "error_message", "is_date_error"


@dataclass(frozen=True)
class ForeignKey:
    """``column`` of the rows must exist as ``dim_key`` in ``dim``."""

    dim: DataFrame
    column: str
    message: str
    dim_key: str | None = None


@dataclass(frozen=True)
class Check:
    """Rows for which ``broken`` holds fail; a NULL test does not."""

    broken: Callable[[DataFrame], Column]
    message: str


Rule = ForeignKey | Check


class Split(NamedTuple):
    valid: DataFrame
    errors: DataFrame


def country_rule(countries: DataFrame) -> ForeignKey:
    return ForeignKey(countries, "country_id", MISSING_COUNTRY)


def _bad_date(df: DataFrame) -> Column:
    date = F.col("invoice_date")
    bad = date.isNull() | (date == F.lit(SENTINEL_DATE).cast("timestamp_ntz"))
    return bad | F.col(DATE_FLAG) if DATE_FLAG in df.columns else bad


def date_rule() -> Check:
    """The invoice date could be read: no flag, no stand-in date, not NULL."""
    return Check(_bad_date, INVALID_DATE)


def product_rule(products: DataFrame) -> ForeignKey:
    return ForeignKey(products, "stock_code", MISSING_PRODUCT)


def _keys(rule: ForeignKey) -> DataFrame:
    name = rule.dim_key or rule.column
    keys = standardise_ids(rule.dim.select(F.col(name).alias(rule.column)), [rule.column])
    return distinct_keys(keys, rule.column)


def validate_fk(df: DataFrame, dim: DataFrame, key: str) -> Split:
    """Rows whose ``key`` exists in ``dim`` (semi join) and the others (anti join)."""
    keys = distinct_keys(dim, key)
    return Split(
        join_by_key(df, keys, [key], "left_semi"), join_by_key(df, keys, [key], "left_anti")
    )


def tag_errors(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows with the message of the first failed rule (NULL = valid)."""
    tagged, marks = df, []
    for i, rule in enumerate(rules):
        if isinstance(rule, Check):
            marks.append(F.when(rule.broken(df), F.lit(rule.message)))
            continue
        mark = f"_found_{i}"
        keys = _keys(rule).withColumn(mark, F.lit(True))
        tagged = join_by_key(tagged, keys, [rule.column], "left")
        marks.append(F.when(F.col(mark).isNull(), F.lit(rule.message)))
    return tagged.select(*df.columns, F.coalesce(*marks).alias(ERROR))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> Split:
    """Valid rows, and failing rows with their message.

    The outputs are lazy and do not cache the input. To write both from one pass,
    write :func:`tag_errors` with ``sinks.files.write_by_outcome``.
    """
    tagged = tag_errors(df, rules)
    return Split(
        tagged.filter(F.col(ERROR).isNull()).drop(ERROR),
        tagged.filter(F.col(ERROR).isNotNull()),
    )


def error_rows(
    failed: DataFrame, as_of: dt.datetime | Column | None = None, retry_count: Column | int = 0
) -> DataFrame:
    """Failed rows in the shape of the error table."""
    retries = retry_count if isinstance(retry_count, Column) else F.lit(retry_count)
    flag = F.col(DATE_FLAG) if DATE_FLAG in failed.columns else F.lit(None).cast("boolean")
    return failed.withColumns(
        {
            "quantity": F.col("quantity").cast("int"),
            "retry_count": retries.cast("int"),
            "ingestion_timestamp": audit_time(as_of),
            DATE_FLAG: F.coalesce(flag, F.lit(False)),
        }
    ).select(*schemas.TRANSACTIONS_ERROR.names)


PAYLOAD_FIELDS = (
    "invoice_no", "stock_code", "customer_id", "quantity",
    "invoice_date", "country_id", "region_code",
)


def error_payloads(errors: DataFrame, source_file: Column | None = None) -> DataFrame:
    """Errors as JSON payload records: error_id, payload, message, attempts."""
    source = F.lit(None).cast("string") if source_file is None else source_file
    return errors.withColumn("payload", to_payload(PAYLOAD_FIELDS)).select(
        F.sha2("payload", 256).alias("error_id"),
        "payload",
        ERROR,
        source.alias("source_file"),
        F.col("retry_count").alias("attempts"),
        "ingestion_timestamp",
    )


def replayed(payloads: DataFrame) -> DataFrame:
    """Quarantined rows read back from their payload records, ready for ``facts.recover``;
    ``attempts`` becomes their retry count."""
    record = from_payload(F.col("payload"), PAYLOAD_FIELDS)
    kinds = {f.name: f.dataType for f in schemas.TRANSACTIONS_ERROR}
    return payloads.withColumn("_record", record).select(
        *[F.col(f"_record.{name}").cast(kinds[name]).alias(name) for name in PAYLOAD_FIELDS],
        ERROR,
        F.col("attempts").alias("retry_count"),
        "ingestion_timestamp",
    )


class Fixable(NamedTuple):
    fixable: DataFrame
    waiting: DataFrame


def split_fixable(
    errors: DataFrame, new_countries: DataFrame | None, new_prices: DataFrame | None
) -> Fixable:
    """Quarantined lines that what has arrived since can have mended, and those that still wait.

    A line without its country is worth another look if that country is among ``new_countries``, one without a
    price if ``new_prices`` has one for its product from its day or before. Lines with another message have to be
    corrected themselves and wait. A line whose first fault was mended may then show its next one, so a line that waits
    for a price is looked at again when its country comes.
    """
    tagged, tests = errors, []
    if new_countries is not None:
        keys = distinct_keys(new_countries, "country_id").withColumn("_arrived", F.lit(True))
        tagged = join_by_key(tagged, keys, ["country_id"], "left")
        tests.append((F.col(ERROR) == MISSING_COUNTRY) & F.col("_arrived").isNotNull())
    if new_prices is not None:
        first = new_prices.groupBy("stock_code").agg(F.min("price_date").alias("_since"))
        tagged = join_by_key(tagged, first, ["stock_code"], "left")
        tests.append((F.col(ERROR) == MISSING_PRICE) & (F.col("_since") <= F.to_date("invoice_date")))
    known = reduce(Column.__or__, [F.coalesce(test, F.lit(False)) for test in tests], F.lit(False))
    tagged = tagged.withColumn("_known", known)
    return Fixable(
        tagged.where("_known").select(*errors.columns), tagged.where("NOT _known").select(*errors.columns)
    )
