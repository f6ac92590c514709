"""Date parsing and calendar attributes, independent of the session time zone."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.fixed_values import DATE_FORMATS, SENTINEL_DATE

# Fixed-width numeric fields of a date pattern.
_FIELDS = ("yyyy", "MM", "dd", "HH", "mm", "ss")


def try_parse_timestamp(text: Column, fmt: str) -> Column:
    """``text`` as timestamp without time zone, NULL when it does not match ``fmt``.

    A pattern of fixed-width numbers is checked by its shape and its fields are
    put in ISO order for a cast. This needs no zoned timestamp, so a daylight
    saving gap of the session zone cannot move a value, and text of another format
    costs one regular expression instead of a parser exception per row.
    """
    shape, start = re.escape(fmt), {}
    for field in _FIELDS:
        if field in fmt:
            start[field] = fmt.index(field) + 1
            shape = shape.replace(field, rf"\d{{{len(field)}}}")
    plain = re.sub(r"\\d\{\d\}", "", shape)
    if not {"yyyy", "MM", "dd"} <= start.keys() or re.search("[A-Za-z]", plain):
        return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    part = {
        field: F.substring(text, start[field], len(field)) if field in start else F.lit("00")
        for field in _FIELDS
    }
    if fmt.startswith("yyyy-MM-dd"):
        iso = text
    else:
        day = F.concat_ws("-", part["yyyy"], part["MM"], part["dd"])
        clock = F.concat_ws(":", part["HH"], part["mm"], part["ss"])
        iso = F.concat_ws(" ", day, clock) if "HH" in start else day
    return F.when(text.rlike(f"^{shape}$"), iso.try_cast("timestamp_ntz"))


def try_parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """``text`` as date, NULL when it does not match ``fmt``."""
    return F.to_date(try_parse_timestamp(text, fmt))


def parse_date_any(
    text: Column,
    formats: Sequence[str] = DATE_FORMATS,
    sentinel: str = SENTINEL_DATE,
) -> tuple[Column, Column]:
    """First format that fits wins: ``(timestamp or sentinel, is_date_error)``."""
    parsed = F.coalesce(*[try_parse_timestamp(text, fmt) for fmt in formats])
    return F.coalesce(parsed, F.lit(sentinel).cast("timestamp_ntz")), parsed.isNull()


def time_attributes(ts: Column) -> list[Column]:
    """Year, quarter, month, day, day_of_week (Sunday = 1) and is_weekend."""
    day = F.to_date(ts)
    weekday = F.dayofweek(day)
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        weekday.isin(1, 7).alias("is_weekend"),
    ]


def audit_time(as_of: dt.datetime | Column | None) -> Column:
    """The audit timestamp of a run; pass ``as_of`` to make results repeatable."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)
