"""Fact build and recovery of quarantined rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.codes import standardise_ids, txn_key
from tallyhouse.functions.dates import audit_time
from tallyhouse.functions.fixed_values import DEFAULT_CURRENCY, MISSING_PRICE
from tallyhouse.operators.asof import asof_join, one_match_per_key
from tallyhouse.operators.joins import join_by_key
from tallyhouse.operators.quality import (
    DATE_FLAG,
    ERROR,
    Rule,
    country_rule,
    date_rule,
    error_rows,
    tag_errors,
)

IDS = ["invoice_no", "stock_code", "customer_id", "country_id", "region_code"]

# Columns that tell two lines of one invoice apart as far as the model can.
LINE_COLUMNS = ("invoice_no", "invoice_date", "stock_code", "customer_id", "quantity")


# With the country, which decides the outcome, and a number for equal lines.
UNIQUE_COLUMNS = (*LINE_COLUMNS, "country_id", "region_code", "line_no")


DERIVED = ("total_amount", "currency", "ingestion_timestamp")


class FactLoad:
    """Outputs of :func:`build_fact`; each is planned when it is asked for."""

    def __init__(
        self,
        tagged: DataFrame,
        price: Callable[[DataFrame, str], DataFrame],
        measure: Callable[[DataFrame], DataFrame],
        as_of: dt.datetime | Column | None,
    ):
        self._tagged, self._price, self._measure, self._as_of = tagged, price, measure, as_of

    @property
    def _valid(self) -> DataFrame:
        return self._tagged.filter(F.col(ERROR).isNull()).drop(ERROR)

    @cached_property
    def fact(self) -> DataFrame:
        return self._measure(self._price(self._valid, "inner"))

    @cached_property
    def lines(self) -> DataFrame:
        """The transactions that have a fact row, without its price: valid, and with a price at or before
        the invoice day. Each key's first price decides that."""
        return self._price(self._valid, "left_semi")

    @cached_property
    def errors(self) -> DataFrame:
        return error_rows(self._tagged.filter(F.col(ERROR).isNotNull()), self._as_of)

    @cached_property
    def unpriced(self) -> DataFrame:
        lost = self._price(self._valid, "left_anti")
        return error_rows(lost.withColumn(ERROR, F.lit(MISSING_PRICE)), self._as_of)


class Recovery(NamedTuple):
    fixed: DataFrame
    still_broken: DataFrame


def standardise(tx: DataFrame) -> DataFrame:
    """String ids and INT quantity."""
    return standardise_ids(tx, IDS).withColumn("quantity", F.col("quantity").cast("int"))


def _priced(
    rows: DataFrame,
    products: DataFrame,
    how: str,
    day: Column | None = None,
    **options,
) -> DataFrame:
    """``rows`` with product_id, unit_price and price_date in effect on their day."""
    prices = standardise_ids(
        products.select("stock_code", "product_id", "unit_price", "price_date"),
        ["stock_code", "product_id"],
    )
    day = F.to_date("invoice_date") if day is None else day
    return asof_join(rows, prices, "stock_code", day, "price_date", how, **options)


def _with_price(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Rows whose product has a price at or before their day."""
    first = (
        standardise_ids(products.select("stock_code", "price_date"), ["stock_code"])
        .groupBy("stock_code")
        .agg(F.min("price_date").alias("_first_price"))
    )
    begun = F.col("_first_price") <= F.to_date("invoice_date")
    return join_by_key(rows, first, ["stock_code"], "left_semi", begun)


def _measures(
    priced: DataFrame,
    as_of: dt.datetime | Column | None,
    currency: str,
    key_style: str,
    key_columns: Sequence[str],
    extra: Sequence[str] = (),
) -> DataFrame:
    price = F.coalesce(F.col("unit_price"), F.lit(0.0)).cast("double")
    return priced.select(
        "*",
        txn_key(key_style, key_columns).alias("transaction_id"),
        price.alias("_price"),
        (F.col("quantity") * price).alias("total_amount"),
        F.lit(currency).alias("currency"),
    ).withColumns(
        {"unit_price": F.col("_price"), "ingestion_timestamp": audit_time(as_of)}
    ).select(*schemas.FACT_TRANSACTIONS.names, *extra)


def build_fact(
    tx: DataFrame,
    products: DataFrame,
    countries: DataFrame,
    as_of: dt.datetime | Column | None = None,
    currency: str = DEFAULT_CURRENCY,
    key_style: str = "concat",
    key_columns: Sequence[str] = ("invoice_no", "invoice_date"),
    collapse_on: Sequence[str] | None = None,
    rules: Sequence[Rule] | None = None,
    **asof_options,
) -> FactLoad:
    """Standardise, check references, price as of the invoice day, add measures.

    Every input line ends in exactly one output: ``fact``, ``errors`` (a failed
    rule; by default the date and the country are checked) or ``unpriced`` (valid, but no
    price at or before the invoice day), unless ``collapse_on`` names columns whose
    repeated lines collapse to the one with the latest price. ``asof_options`` are
    the strategy and bucket of ``asof_join``.
    """
    rules = [date_rule(), country_rule(countries)] if rules is None else rules

    def price(rows: DataFrame, how: str) -> DataFrame:
        if how == "left_semi":
            return _with_price(rows, products)
        priced = _priced(rows, products, how, **asof_options)
        if collapse_on and how == "inner":
            return one_match_per_key(priced, collapse_on, "price_date")
        return priced

    def measure(priced: DataFrame) -> DataFrame:
        return _measures(priced, as_of, currency, key_style, key_columns)

    return FactLoad(tag_errors(standardise(tx), rules), price, measure, as_of)


def tag_fact(
    tx: DataFrame,
    products: DataFrame,
    countries: DataFrame,
    as_of: dt.datetime | Column | None = None,
    currency: str = DEFAULT_CURRENCY,
    key_style: str = "concat",
    key_columns: Sequence[str] = ("invoice_no", "invoice_date"),
    rules: Sequence[Rule] | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
    apart: bool = False,
    **asof_options,
) -> DataFrame:
    """:func:`build_fact` as one DataFrame: fact columns, stock_code, error_message.

    Meant for ``sinks.files.write_by_outcome``, which writes the fact and the
    quarantine from a single pass over the transactions. ``store`` gets the :func:`priced_lines` and returns them,
    stored, with all columns of the key; ``apart`` is theirs.
    """
    priced = priced_lines(tx, products, countries, rules, apart, **asof_options)
    return measured(store(priced) if store else priced, as_of, currency, key_style, key_columns)


def priced_lines(
    tx: DataFrame,
    products: DataFrame,
    countries: DataFrame,
    rules: Sequence[Rule] | None = None,
    apart: bool = False,
    number: Callable[[DataFrame], DataFrame] | None = None,
    **asof_options,
) -> DataFrame:
    """The first half of :func:`tag_fact`: lines with error_message and, where they are valid, the version in
    effect. They have neither the key nor what follows from other columns, so they are the form to store
    between; :func:`measured` adds the rest.

    ``apart`` leaves lines that break a rule out of the as-of join, for a second reading of ``tx``. ``number`` adds
    the columns that only valid lines need, such as their line number, and goes with ``apart``.
    """
    rules = [date_rule(), country_rule(countries)] if rules is None else rules
    tagged = tag_errors(standardise(tx), rules)
    if not apart:
        return _with_version(tagged, products, **asof_options)
    valid = tagged.filter(F.col(ERROR).isNull())
    priced = _with_version(number(valid) if number else valid, products, **asof_options)
    return priced.unionByName(tagged.filter(F.col(ERROR).isNotNull()), allowMissingColumns=True)


def measured(
    priced: DataFrame,
    as_of: dt.datetime | Column | None = None,
    currency: str = DEFAULT_CURRENCY,
    key_style: str = "concat",
    key_columns: Sequence[str] = ("invoice_no", "invoice_date"),
    extra: Sequence[str] = (),
) -> DataFrame:
    """The second half of :func:`tag_fact`: keys and measures of :func:`priced_lines`."""
    flag = [c for c in (DATE_FLAG,) if c in priced.columns]
    return _measures(
        priced, as_of, currency, key_style, key_columns, ["stock_code", ERROR, *flag, *extra]
    )


def compact(fact: DataFrame) -> DataFrame:
    """Fact rows with hashed keys in their shortest form, for a shuffle: the hash as bytes, and without the columns that
    follow from others. :func:`expanded` brings them back."""
    return fact.withColumn("transaction_id", F.unhex("transaction_id")).drop(*DERIVED)


def expanded(
    rows: DataFrame, as_of: dt.datetime | Column | None = None, currency: str = DEFAULT_CURRENCY
) -> DataFrame:
    """The fact rows of :func:`compact`."""
    return rows.withColumns(
        {
            "transaction_id": F.lower(F.hex("transaction_id")),
            "total_amount": F.col("quantity") * F.col("unit_price"),
            "currency": F.lit(currency),
            "ingestion_timestamp": audit_time(as_of),
        }
    ).select(*schemas.FACT_TRANSACTIONS.names)


def _with_version(tagged: DataFrame, products: DataFrame, **asof_options) -> DataFrame:
    """Price the rows without an error and mark those that find none."""
    day = F.when(F.col(ERROR).isNull(), F.to_date("invoice_date"))
    return _priced(tagged, products, "left", day, **asof_options).withColumn(
        ERROR,
        F.coalesce(ERROR, F.when(F.col("price_date").isNull(), F.lit(MISSING_PRICE))),
    )


def line_hash() -> Column:
    """Hash of the columns that make two lines equal; equal lines share it."""
    return F.xxhash64(*UNIQUE_COLUMNS[:-1])


def repeated_lines(tx: DataFrame) -> DataFrame:
    """(_line): hashes of the lines that stand more than once, for :func:`with_line_number`."""
    counts = tx.groupBy(line_hash().alias("_line")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where("_n > 1").select("_line")


def with_line_number(
    tx: DataFrame, before: DataFrame | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """Add ``line_no``: equal lines of an invoice are counted, so that a key over
    ``UNIQUE_COLUMNS`` keeps each of them, and gives it the same key in every run.

    Only hashes are counted over all lines. Lines whose hash stands once are done; the others are grouped into
    distinct rows with a count, so that a line that repeats a million times is one row until it is numbered.
    ``before`` (_line, n): how many equal lines earlier loads have numbered, by :func:`line_hash`.
    ``repeated`` is :func:`repeated_lines`, or more hashes than that, stored: where few lines are repeated, Spark then knows
    it before it shuffles all of them.
    """
    lines = tx.withColumn("_line", line_hash())
    repeated = repeated_lines(tx) if repeated is None else repeated
    once = join_by_key(lines, repeated, ["_line"], "left_anti").withColumn("line_no", F.lit(1))
    rest = sorted(set(tx.columns) - set(UNIQUE_COLUMNS))
    in_order = Window.partitionBy(*UNIQUE_COLUMNS[:-1]).orderBy(*rest)
    upto = F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbers = F.sequence(F.col("_upto") - F.col("_n") + 1, F.col("_upto"))
    again = (
        join_by_key(lines, repeated, ["_line"], "left_semi")
        .groupBy(*lines.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", upto)
        .select(*lines.columns, F.explode(numbers).alias("line_no"))
        .withColumn("line_no", F.col("line_no").cast("int"))
    )
    numbered = once.unionByName(again)
    if before is not None:
        held = before.select("_line", F.col("n").alias("_held"))
        numbered = join_by_key(numbered, held, ["_line"], "left").withColumn(
            "line_no", F.col("line_no") + F.coalesce("_held", F.lit(0)).cast("int")
        )
    return numbered.select(*tx.columns, "line_no")


def tag_recover(
    errors: DataFrame,
    countries: DataFrame,
    products: DataFrame,
    as_of: dt.datetime | Column | None = None,
    currency: str = DEFAULT_CURRENCY,
    key_style: str = "concat",
    key_columns: Sequence[str] = ("invoice_no", "invoice_date"),
    rules: Sequence[Rule] | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
    prune: bool = True,
    **asof_options,
) -> DataFrame:
    """Quarantined rows re-checked against newer dimensions and priced, in one pass: fact
    columns, stock_code, the error that now applies (NULL: recovered) and retry_count,
    which is one higher. ``store`` is that of :func:`tag_fact`. ``prune`` leaves prices of other products out before
    they are ordered, for a shuffle of all prices; it does not pay where most products have a quarantined row."""
    rules = [date_rule(), country_rule(countries)] if rules is None else rules
    retries = F.coalesce(F.col("retry_count"), F.lit(0)) + 1
    again = errors.withColumn("retry_count", retries).withColumnRenamed(ERROR, "_old_error")
    if prune:
        wanted = standardise_ids(errors.select("stock_code"), ["stock_code"]).distinct()
        products = join_by_key(products, wanted, ["stock_code"], "left_semi")
    priced = _with_version(tag_errors(again, rules), products, **asof_options)
    priced = store(priced) if store else priced
    return measured(priced, as_of, currency, key_style, key_columns, ["retry_count"])


def recovered(tagged: DataFrame, as_of: dt.datetime | Column | None = None) -> Recovery:
    """The two outputs of :func:`tag_recover`, or of its staged rows."""
    return Recovery(
        fixed=tagged.filter(F.col(ERROR).isNull()).select(*schemas.FACT_TRANSACTIONS.names),
        still_broken=error_rows(
            tagged.filter(F.col(ERROR).isNotNull()), as_of, F.col("retry_count")
        ),
    )


def recover(
    errors: DataFrame,
    countries: DataFrame,
    products: DataFrame,
    as_of: dt.datetime | Column | None = None,
    **options,
) -> Recovery:
    """Re-check quarantined rows against newer dimensions.

    Rows that pass and find a price become fact rows; all others stay with the
    message that now applies and ``retry_count`` one higher. No row is lost. To write
    both from one pass, stage :func:`tag_recover` and split it by :func:`recovered`.
    """
    return recovered(tag_recover(errors, countries, products, as_of, **options), as_of)
