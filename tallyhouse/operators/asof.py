"""As-of and validity joins.

The price in effect is the version whose ``[start, end)`` holds the row's time.
A plain key join would test every version of a key against every row of that key.

By default the versions of a key are packed: sorted arrays of ``CHUNK`` versions, one array for each column, and at most
``CHUNK`` of these in one row. Where a version holds until the next one starts, its end is left out. Rows meet that one row by an equi join on the key (its next one where a key has more versions
than fit) and search the two arrays, so a row is compared with 2 * ``CHUNK`` starts at most. The rows are read once and the
packed side follows from the versions alone: whatever their dates, nothing is repeated. Spark broadcasts a small
history and splits a hot key over many tasks.

With a ``bucket`` both sides also share a calendar bucket. A version stands in the bucket of its start;
each (key, bucket) that occurs among the rows also gets the one version that was in effect
when the bucket began. So the right side has as many rows as there are versions and
occurring buckets, however long a version holds, and a row meets only the versions of its
own bucket (32 at most for daily prices and monthly buckets). It is an ordinary equi join, so
Spark broadcasts a small history and splits a hot (key, bucket) over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import latest_per_key
from tallyhouse.operators.joins import common_type, join_by_key
from tallyhouse.operators.scd import scd2_intervals

_START, _END, _BUCKET = "_start", "_end", "_bucket"
CHUNK = 64


def _bucket_of(time: Column, width: str) -> Column:
    if width == "day":
        return F.unix_date(F.to_date(time))
    if width == "month":
        return F.year(time) * 12 + F.month(time)
    if width == "year":
        return F.year(time)
    raise ValueError(f"unknown bucket width: {width}")


def versions_by_bucket(rows: DataFrame, versions: DataFrame, on: str, bucket: str) -> DataFrame:
    """The versions (_key, _start, ...) with the bucket they are looked up in: that of their
    start, and for each (key, bucket) of ``rows`` the last version that started before it.

    The window sees the versions and the occurring buckets of a key, not its rows.
    """
    key = common_type(rows, on, versions, "_key")
    carried = [name for name in versions.columns if name != "_key"]
    version = F.struct(*[F.col(f"`{name}`") for name in carried])
    events = versions.select(
        F.col("_key").try_cast(key).alias("_key"),
        _bucket_of(F.col(_START), bucket).alias("_vbucket"),
        F.lit(1).alias("_side"),
        version.alias("_version"),
    )
    asked = (
        rows.select(F.col(f"`{on}`").try_cast(key).alias("_key"), F.col(_BUCKET).alias("_vbucket"))
        .dropna()
        .distinct()
        .withColumn("_side", F.lit(0))
        .withColumn("_version", F.lit(None).cast(events.schema["_version"].dataType))
    )
    by = Window.partitionBy("_key").orderBy("_vbucket", "_side", f"_version.{_START}")
    so_far = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        events.unionByName(asked)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
        .where(F.col("_version").isNotNull())
        .select("_key", "_vbucket", "_version.*")
    )


def packed_versions(versions: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Versions (_key, _start, ...) as rows (_key, _since, _until, _chunks): ``_chunks`` holds at most ``chunk`` structs of a
    first start and the versions from it on (an array for each column), at most ``chunk`` too, all in the order of their starts."""
    in_order = Window.partitionBy("_key").orderBy(_START)
    carried = [name for name in versions.columns if name not in ("_key", _START)]
    fields = [F.col(_START), *[F.col(f"`{name}`") for name in carried]]
    place = F.col("_place")
    held = F.col("_versions")
    arrays = F.struct(*[held.getField(name).alias(name) for name in (_START, *carried)])
    chunks = (
        versions.withColumn("_place", F.row_number().over(in_order) - 1)
        .groupBy("_key", F.floor(place / chunk**2).alias("_row"), F.floor(place / chunk).alias("_chunk"))
        .agg(F.sort_array(F.collect_list(F.struct(place, *fields))).alias("_versions"))
    )
    packed = chunks.groupBy("_key", "_row").agg(
        F.sort_array(
            F.collect_list(F.struct("_chunk", held[0][_START].alias("_since"), arrays.alias("_versions")))
        ).alias("_chunks")
    )
    since = F.col("_chunks")[0]["_since"]
    return packed.select(
        "_key",
        since.alias("_since"),
        F.lead(since).over(Window.partitionBy("_key").orderBy("_row")).alias("_until"),
        "_chunks",
    )


def _in_force(rows: DataFrame, versions: DataFrame, on: str) -> DataFrame:
    """``rows``, which have ``_at``, with the version that holds then as ``_version`` (NULL: none). Versions without an
    end hold until the next one starts."""
    within = (F.col("_since") <= F.col("_at")) & (
        F.col("_until").isNull() | (F.col("_at") < F.col("_until"))
    )
    met = join_by_key(rows, packed_versions(versions), {on: "_key"}, "left", within)
    chunk = F.try_element_at(F.filter("_chunks", lambda item: item["_since"] <= F.col("_at")), F.lit(-1))
    begun = F.size(F.filter(F.col("_held")[_START], lambda start: start <= F.col("_at")))
    names = [name for name in versions.columns if name != "_key"]
    at = [F.element_at(F.col("_held").getField(name), F.col("_n")).alias(name) for name in names]
    found = met.withColumn("_held", chunk["_versions"]).withColumn("_n", begun)
    found = found.withColumn("_version", F.when(F.col("_n") > 0, F.struct(*at))).drop("_held", "_n")
    if _END not in names:
        return found
    holds = F.col(f"_version.{_END}").isNull() | (F.col("_at") < F.col(f"_version.{_END}"))
    return found.withColumn("_version", F.when(holds, F.col("_version")))


def validity_join(
    left: DataFrame,
    intervals: DataFrame,
    on: str,
    at: Column | str,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
    how: str = "inner",
    bucket: str | None = None,
    gapless: bool = False,
) -> DataFrame:
    """Join each left row to the interval row of its key that holds at time ``at``:
    ``start <= at AND (end IS NULL OR at < end)``. Intervals of a key must not overlap,
    as those of ``scd2_intervals`` don't.

    ``how`` is ``inner``, ``left`` (unmatched rows get NULLs) or ``left_anti``. With ``bucket`` (``day``,
    ``month`` or ``year``) versions are looked up by calendar bucket; rows are then read twice. With ``gapless`` every
    interval ends where the next one of its key starts; ends are then neither shuffled nor returned.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    at = F.col(at) if isinstance(at, str) else at
    carried = [name for name in intervals.columns if name not in (on, start, end)]
    versions = intervals.filter(
        F.col(on).isNotNull()
        & F.col(start).isNotNull()
        & (F.col(end).isNull() | (F.col(start) < F.col(end)))
    ).select(
        F.col(on).alias("_key"), F.col(start).alias(_START), F.col(end).alias(_END), *carried
    )
    ends = [] if gapless else [end]
    if bucket is None:
        versions = versions.drop(_END) if gapless else versions
        known = _in_force(left.withColumn("_at", at), versions, on)
        if how == "left_anti":
            return known.where(F.col("_version").isNull()).select(*left.columns)
        known = known.where(F.col("_version").isNotNull()) if how == "inner" else known
        return known.select(
            *left.columns,
            *[F.col(f"_version.`{name}`").alias(name) for name in carried],
            F.col(f"_version.{_START}").alias(start),
            *[F.col(f"_version.{_END}").alias(name) for name in ends],
        )
    rows = left.withColumns({"_at": at, _BUCKET: _bucket_of(at, bucket)})
    holds = (F.col(_START) <= F.col("_at")) & (
        F.col(_END).isNull() | (F.col("_at") < F.col(_END))
    )
    placed = versions_by_bucket(rows, versions, on, bucket)
    joined = join_by_key(rows, placed, {on: "_key", _BUCKET: "_vbucket"}, how, holds)
    if how == "left_anti":
        return joined.select(*left.columns)
    return joined.select(
        *left.columns, *carried, F.col(_START).alias(start), *[F.col(_END).alias(name) for name in ends]
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_time: Column | str,
    right_time: str,
    how: str = "inner",
    strategy: str = "interval",
    key: Sequence[str] | None = None,
    bucket: str | None = None,
) -> DataFrame:
    """Latest right row with ``right_time <= left_time`` per key (inclusive).

    ``interval`` turns the right side into validity intervals. ``points`` resolves each distinct (key, left_time) once and joins
    the answer back; it pays off when many rows share a key and a day.

    ``how`` is ``inner`` (rows without an earlier right row disappear), ``left``
    or ``left_anti`` (only those rows). ``bucket`` is that of :func:`validity_join`. With
    ``key`` one row per left key remains, the one with the latest match.
    """
    if strategy == "interval":
        intervals = scd2_intervals(right, on, right_time, right_time, "_until")
        joined = validity_join(
            left,
            intervals.drop("is_current"),
            on,
            left_time,
            right_time,
            "_until",
            how,
            bucket,
            gapless=True,
        )
    elif strategy == "points":
        joined = _asof_by_points(left, right, on, left_time, right_time, how)
    else:
        raise ValueError(f"unknown as-of strategy: {strategy}")
    return one_match_per_key(joined, key, right_time) if key else joined


def one_match_per_key(joined: DataFrame, key: Sequence[str], right_time: str) -> DataFrame:
    """Collapse repeated lines of a key to the one with the latest match."""
    rest = sorted(name for name in joined.columns if name not in (*key, right_time))
    order = [F.desc(right_time), *[F.desc(name) for name in rest]]
    return latest_per_key(joined, key, order)


def _asof_by_points(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_time: Column | str,
    right_time: str,
    how: str,
) -> DataFrame:
    at = F.col(left_time) if isinstance(left_time, str) else left_time
    # Sorted, so that two versions of one moment rank as in ``scd2_intervals``.
    carried = sorted(name for name in right.columns if name not in (on, right_time))
    rows = left.withColumn("_at", at)

    # Distinct points: a hot key shrinks to its distinct times before the window.
    points = (
        rows.select(F.col(on).alias("_key"), "_at")
        .dropna(subset=["_key", "_at"])
        .distinct()
        .withColumn("_match", F.lit(None).cast(_struct_type(right, right_time, carried)))
        .withColumn("_side", F.lit(1))
    )
    versions = right.filter(F.col(on).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(on).alias("_key"),
        F.col(right_time).alias("_at"),
        F.struct(right_time, *carried).alias("_match"),
        F.lit(0).alias("_side"),
    )
    by = (
        Window.partitionBy("_key")
        .orderBy("_at", "_side", "_match")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    resolved = (
        versions.unionByName(points)
        .withColumn("_match", F.last("_match", ignorenulls=True).over(by))
        .filter((F.col("_side") == 1) & F.col("_match").isNotNull())
        .select("_key", F.col("_at").alias("_point"), "_match")
    )
    joined = join_by_key(rows, resolved, {on: "_key", "_at": "_point"}, how)
    if how == "left_anti":
        return joined.select(*left.columns)
    return joined.select(
        *left.columns,
        *[F.col(f"_match.{name}").alias(name) for name in carried],
        F.col(f"_match.{right_time}").alias(right_time),
    )


def _struct_type(right: DataFrame, right_time: str, carried: Sequence[str]):
    return right.select(F.struct(right_time, *carried).alias("m")).schema["m"].dataType
