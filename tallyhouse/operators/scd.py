"""Slowly changing dimensions: overwrite (type 0) and versioned history (type 2).

A history holds one row per (key, time). Times are dates, so the windows below
see at most one row per calendar day and key, however hot the key is in the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.codes import version_key
from tallyhouse.operators.dedup import latest_per_key
from tallyhouse.operators.joins import join_by_key


def scd0_latest(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Overwrite dimension: the latest row of each key replaces all others."""
    return latest_per_key(df, [key] if isinstance(key, str) else key, order)


def _tie_break(df: DataFrame, *first: str) -> list[str]:
    """Remaining columns in name order: makes any ordering over ``df`` total."""
    return [name for name in sorted(df.columns) if name not in first]


def _newest(df: DataFrame, key: str, time: str, value: str) -> DataFrame:
    order = [F.desc(time), F.desc(value)]
    order += [F.desc(name) for name in _tie_break(df, key, time, value)]
    return latest_per_key(df, [key], order)


def _one_per_time(df: DataFrame, key: str, time: str, value: str) -> DataFrame:
    order = [F.desc(value)] + [F.desc(n) for n in _tie_break(df, key, time, value)]
    return latest_per_key(df, [key, time], order)


def _with_version_id(df: DataFrame, key: str, time: str, version_id: str) -> DataFrame:
    rest = [name for name in df.columns if name != version_id]
    return df.select(version_key(key, time).alias(version_id), *rest)


def scd2_changes(
    batch: DataFrame,
    history: DataFrame | None = None,
    key: str = "stock_code",
    value: str = "unit_price",
    time: str = "price_date",
    version_id: str = "product_id",
    late_policy: str = "latest",
) -> DataFrame:
    """Versions to append to ``history``: new keys and changed values.

    ``late_policy="latest"`` keeps the newest batch row per key and compares it
    with the newest version. ``"merge"`` looks at every batch row and compares it
    with the version in effect just before it, so late rows are judged by their
    own date. Without history both keep every dated version, ``"merge"`` without those
    that repeat the value before them. A version that the history holds already is
    never returned, so a batch may be run again. Rows whose value or time is NULL
    cannot become a version; :func:`scd2_rejects` returns them.
    """
    usable = batch.filter(F.col(value).isNotNull() & F.col(time).isNotNull())
    if late_policy not in ("latest", "merge"):
        raise ValueError(f"unknown late policy: {late_policy}")
    if late_policy == "merge":
        fresh = _one_per_time(usable, key, time, value)
        changes = _changes_by_time(fresh, history, key, value, time)
    elif history is None:
        changes = _one_per_time(usable, key, time, value)
    else:
        fresh = _newest(usable, key, time, value)
        changes = _changes_to_latest(fresh, history, key, value, time)
    if history is not None:
        held = history.select(key, time, value).dropna().distinct()
        changes = join_by_key(changes, held, [key, time, value], "left_anti")
    return _with_version_id(changes, key, time, version_id)


def scd2_rejects(batch: DataFrame, value: str = "unit_price", time: str = "price_date") -> DataFrame:
    """Batch rows that cannot become a version."""
    return batch.filter(F.col(value).isNull() | F.col(time).isNull())


def _changes_to_latest(
    fresh: DataFrame, history: DataFrame, key: str, value: str, time: str
) -> DataFrame:
    latest = _newest(history.select(key, time, value), key, time, value).select(
        key, F.col(value).alias("_latest"), F.lit(True).alias("_known")
    )
    changed = F.col("_known").isNull() | ~F.col(value).eqNullSafe(F.col("_latest"))
    return fresh.join(latest, key, "left").filter(changed).select(*fresh.columns)


def _changes_by_time(
    fresh: DataFrame, history: DataFrame | None, key: str, value: str, time: str
) -> DataFrame:
    rows = fresh.withColumn("_from_batch", F.lit(True))
    if history is not None:
        known = history.select(key, time, value).join(
            fresh.select(key).distinct(), key, "left_semi"
        )
        rows = rows.unionByName(
            known.withColumn("_from_batch", F.lit(False)), allowMissingColumns=True
        )
    # On the same day the history row sorts first: the batch row corrects it.
    by = Window.partitionBy(key).orderBy(time, "_from_batch", value)
    first = F.row_number().over(by) == 1
    same = F.col(value).eqNullSafe(F.lag(value).over(by))
    return (
        rows.withColumn("_keep", first | ~same)
        .filter(F.col("_from_batch") & F.col("_keep"))
        .select(*fresh.columns)
    )


def scd2_merge(
    batch: DataFrame,
    history: DataFrame,
    key: str = "stock_code",
    value: str = "unit_price",
    time: str = "price_date",
    version_id: str = "product_id",
) -> DataFrame:
    """Whole history after a batch that may hold late rows.

    A late version can make its successor redundant, so all versions of a key are
    ordered by time again and only real changes stay. A batch row replaces a
    history row of the same key and day. Running it twice changes nothing.

    Only keys of the batch are sorted. The history is split by them, and with as few of them as Spark broadcasts (it
    measures them) the versions of all other keys pass without a shuffle.
    """
    columns = [name for name in history.columns if name != version_id]
    usable = batch.filter(F.col(value).isNotNull() & F.col(time).isNotNull())
    touched = usable.select(F.col(key).alias("_touched")).distinct()
    same_key = F.col(key).eqNullSafe(F.col("_touched"))
    others = history.join(touched, same_key, "left_anti").select(*columns)
    history = history.join(touched, same_key, "left_semi")
    rows = history.select(*columns, F.lit(0).alias("_source")).unionByName(
        usable.select(*columns, F.lit(1).alias("_source"))
    )
    order = [F.desc("_source"), F.desc(value)]
    order += [F.desc(n) for n in _tie_break(rows, key, time, value, "_source")]
    per_day = latest_per_key(rows, [key, time], order)
    by = Window.partitionBy(key).orderBy(time)
    same = F.col(value).eqNullSafe(F.lag(value).over(by))
    changed = (F.row_number().over(by) == 1) | ~same
    kept = per_day.withColumn("_keep", changed).filter("_keep").select(*columns)
    return _with_version_id(kept.unionByName(others), key, time, version_id)


def scd2_intervals(
    history: DataFrame,
    key: str = "stock_code",
    time: str = "price_date",
    start: str = "effective_start_date",
    end: str = "effective_end_date",
) -> DataFrame:
    """History with ``[start, end)`` validity and ``is_current`` (end is NULL).

    Two versions on one day leave the earlier an empty interval, by column order.
    """
    by = Window.partitionBy(key).orderBy(time, *_tie_break(history, key, time))
    return (
        history.withColumn(end, F.lead(time).over(by))
        .withColumnRenamed(time, start)
        .withColumn("is_current", F.col(end).isNull())
    )
