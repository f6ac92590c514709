"""Delimited lines -> typed rows, with every unusable line kept as a reject.

A ``tag_*`` function returns one DataFrame holding all non-blank lines plus
``reject_reason`` (NULL = usable), so a single pass can feed both outputs.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.codes import continent_of, split_geo, version_key
from tallyhouse.functions.dates import audit_time, parse_date_any, try_parse_date

REASON = "reject_reason"


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def parse_lines(lines: DataFrame, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Split ``value`` into trimmed string columns; missing fields are NULL.

    Blank lines are dropped. There is no quoting: every separator splits. The
    original line stays in ``value``. The split runs inside a one-element explode,
    which the optimizer leaves in place; as a plain column it would be copied into
    every later expression and filter that uses a field.
    """
    fields = F.split("value", re.escape(sep))
    has_text = (F.size("_fields") > 1) | F.col("_fields")[0].rlike(r"\S")
    return (
        lines.select("*", F.explode(F.array(fields)).alias("_fields"))
        .filter(has_text)
        .withColumns({n: F.trim(F.get("_fields", F.lit(i))) for i, n in enumerate(names)})
        .drop("_fields")
    )


def _first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """Text of the first rule that fires; a NULL test does not fire."""
    return F.coalesce(*[F.when(broken, F.lit(text)) for broken, text in rules])


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


_INTEGER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _try_number(name: str, shape: str, kind: str) -> Column:
    """Cast, NULL where it fails; white space around the number does not count. Text of
    another shape is not tried: the cast refuses it by an exception, which costs far more
    than the test."""
    text = F.btrim(F.col(name), F.lit(" \t\n\x0b\f\r"))
    return F.when(text.rlike(shape), text.try_cast(kind))


def _try_whole(name: str) -> Column:
    """An INT; a fraction is cut off, as a cast of text does outside ANSI mode."""
    text = F.btrim(F.col(name), F.lit(" \t\n\x0b\f\r"))
    whole = F.substring_index(text, ".", 1)
    return F.when(
        text.rlike(_INTEGER),
        F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int")),
    )


def split_tagged(tagged: DataFrame, columns: Sequence[str]) -> Parsed:
    """Usable rows and rejected lines of a tagged DataFrame."""
    return Parsed(
        rows=tagged.filter(F.col(REASON).isNull()).select(*columns),
        rejects=tagged.filter(F.col(REASON).isNotNull()).select("value", REASON),
    )


def tag_transactions(
    lines: DataFrame, as_of: dt.datetime | Column | None = None
) -> DataFrame:
    fields = ["invoice_no", "stock_code", "_qty", "_date", "customer_id", "_geo"]
    raw = parse_lines(lines, fields)
    country, region = split_geo(F.col("_geo"))
    date, bad_date = parse_date_any(F.col("_date"))
    return raw.select(
        "value",
        "invoice_no",
        "stock_code",
        _try_whole("_qty").alias("quantity"),
        date.alias("invoice_date"),
        "customer_id",
        country.alias("country_id"),
        region.alias("region_code"),
        audit_time(as_of).alias("ingestion_timestamp"),
        bad_date.alias("is_date_error"),
        F.coalesce(F.col("_geo").contains("-"), F.lit(False)).alias("_has_region"),
    ).withColumn(
        REASON,
        _first_reason(
            [
                (_blank("invoice_no") | _blank("stock_code"), "key"),
                (F.col("quantity").isNull(), "quantity"),
                (~F.col("_has_region"), "region"),
            ]
        ),
    )


def parse_transactions(
    lines: DataFrame, as_of: dt.datetime | Column | None = None
) -> Parsed:
    """Transaction drop: unparsable quantity or missing region is a reject. A quantity may
    have a fraction, which is cut off, and white space around it.

    An unparsable date is not: it becomes the sentinel with ``is_date_error``.
    """
    return split_tagged(tag_transactions(lines, as_of), schemas.TRANSACTIONS.names)


def tag_products(lines: DataFrame) -> DataFrame:
    raw = parse_lines(lines, ["stock_code", "description", "_price", "_date"])
    price = _try_number("_price", _DECIMAL, "double")
    return raw.select(
        "value",
        "stock_code",
        "description",
        price.alias("unit_price"),
        try_parse_date(F.col("_date")).alias("price_date"),
    ).select(
        "value",
        version_key("stock_code", "price_date").alias("product_id"),
        "stock_code",
        "description",
        "unit_price",
        "price_date",
    ).withColumn(
        REASON,
        _first_reason(
            [
                (_blank("stock_code"), "key"),
                (F.col("unit_price").isNull(), "price"),
                (F.col("price_date").isNull(), "date"),
            ]
        ),
    )


def parse_products(lines: DataFrame) -> Parsed:
    """Product drop: a line without key, numeric price or ISO date is a reject."""
    return split_tagged(tag_products(lines), schemas.PRODUCTS.names)


def tag_countries(lines: DataFrame) -> DataFrame:
    raw = parse_lines(lines, ["country_id", "country_name"])
    return raw.withColumn("continent", continent_of(F.col("country_id"))).withColumn(
        REASON,
        _first_reason([(_blank("country_id"), "key"), (_blank("country_name"), "name")]),
    )


def parse_countries(lines: DataFrame) -> Parsed:
    """Country drop, with the continent derived from the code prefix."""
    return split_tagged(tag_countries(lines), schemas.COUNTRIES.names)
