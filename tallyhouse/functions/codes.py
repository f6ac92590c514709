"""Code derivation and keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.fixed_values import CONTINENTS, UNKNOWN_CONTINENT


def label_of(code: Column, labels: Mapping[str, str]) -> Column:
    """``code`` looked up in a fixed map, NULL when it is not there."""
    entries = [F.lit(text) for item in labels.items() for text in item]
    return F.try_element_at(F.create_map(*entries), code)


def continent_of(country_id: Column) -> Column:
    """Continent label of a country code, from its first two characters."""
    label = label_of(F.substring(country_id, 1, 2), CONTINENTS)
    return F.coalesce(label, F.lit(UNKNOWN_CONTINENT))


def split_geo(geo: Column) -> tuple[Column, Column]:
    """``country-region`` -> (first four characters, last character)."""
    return F.substring(geo, 1, 4), F.substring(geo, -1, 1)


def version_key(*parts: str) -> Column:
    """Key of one product version, e.g. ``stock_code-price_date``."""
    return F.concat_ws("-", *[F.col(part).cast("string") for part in parts])


def txn_key(
    style: str = "concat",
    columns: Sequence[str] = ("invoice_no", "invoice_date"),
) -> Column:
    """Transaction key: readable ``concat`` form or its ``sha256`` hash.

    Use ``sha256`` over columns that identify a line where the key must be unique.
    """
    text = F.concat_ws("-", *[F.col(name).cast("string") for name in columns])
    if style == "concat":
        return text
    if style == "sha256":
        return F.sha2(text, 256)
    raise ValueError(f"unknown key style: {style}")


def standardise_ids(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Cast id columns to string so that "12345" and "A12345" share a type."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})
