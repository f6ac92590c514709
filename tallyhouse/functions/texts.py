"""Rows as text: delimited lines, JSON payloads, fixed-width alert lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.fixed_values import (
    ALERT_COLUMNS,
    ALERT_HEADER_FORMAT,
    ALERT_LINE_FORMAT,
    ALERT_RULE_WIDTH,
)


def to_lines(df: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """One delimited ``value`` per row; NULL fields stay as empty positions."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def to_payload(columns: Sequence[str]) -> Column:
    """JSON text of the named columns; every value as text, NULLs kept."""
    record = F.struct(*[F.col(name).cast("string").alias(name) for name in columns])
    return F.to_json(record, {"ignoreNullFields": "false"})


def from_payload(payload: Column, columns: Sequence[str]) -> Column:
    """Struct of strings read back from :func:`to_payload`."""
    return F.from_json(payload, ", ".join(f"`{name}` string" for name in columns))


def alert_line() -> Column:
    """Fixed-width report line of one flagged order."""
    return F.format_string(
        ALERT_LINE_FORMAT,
        F.col("invoice_no").cast("string"),
        F.col("customer_id").cast("string"),
        F.col("stock_code").cast("string"),
        F.col("quantity").cast("string"),
        F.col("median_qty").cast("double"),
        F.col("median_stddev").cast("double"),
    )


def alert_header() -> str:
    """Column titles and rule printed above the alert lines."""
    return ALERT_HEADER_FORMAT % ALERT_COLUMNS + "\n" + "-" * ALERT_RULE_WIDTH
