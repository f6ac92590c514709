"""Outlier orders: above ``median + k * sample standard deviation`` of their group."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.functions.dates import audit_time
from tallyhouse.functions.fixed_values import OUTLIER_FACTOR, STATUS_NEW, STATUS_RESOLVED
from tallyhouse.functions.texts import alert_line
from tallyhouse.operators.joins import join_by_key

MEDIAN, STDDEV, LIMIT = "median_qty", "stddev_qty", "median_stddev"


def group_baseline(
    df: DataFrame,
    group: str = "stock_code",
    value: str = "quantity",
    exact: bool = True,
    accuracy: int = 10_000,
) -> DataFrame:
    """Median and sample standard deviation of ``value`` per group.

    Exact for integers of up to 32 bits by counting each value first, for wider and
    other numbers, which may all differ, by narrowing to the middle of each group first; both
    shrink a hot group before its rows meet. ``exact=False`` uses ``percentile_approx`` with ``accuracy``.
    """
    if not exact:
        return df.groupBy(group).agg(
            F.percentile_approx(value, 0.5, accuracy).cast("double").alias(MEDIAN),
            F.stddev(value).alias(STDDEV),
        )
    kind = df.schema[value].dataType
    if isinstance(kind, T.IntegralType) and not isinstance(kind, T.LongType):
        return _counted_baseline(df, group, value)
    return _bracketed_baseline(df, group, value)


def _in_the_middle() -> Column:
    """Whether the sorted rows ``_upto - _count + 1 .. _upto`` of ``_n`` hold one of
    the two middle ranks (the same one when ``_n`` is odd)."""
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    before, upto = F.col("_upto") - F.col("_count"), F.col("_upto")
    return ((before < low) & (low <= upto)) | ((before < high) & (high <= upto))


def value_counts(df: DataFrame, group: str = "stock_code", value: str = "quantity") -> DataFrame:
    """How often each value stands in each group: the state from which baselines are made. It can be stored and
    added to, so that a new day never reads the days before it."""
    return df.groupBy(group, value).agg(F.count(value).alias("_count"))


def merge_counts(
    state: DataFrame, change: DataFrame, sign: int = 1, group: str = "stock_code", value: str = "quantity"
) -> DataFrame:
    """``state`` with the counts of ``change`` added, or taken away (``sign=-1``: cases that were opened;
    when they are resolved, add them). Values that are used up go; a group that lost all of them
    goes with them."""
    moved = change.withColumn("_count", F.col("_count") * sign)
    summed = state.unionByName(moved).groupBy(group, value).agg(F.sum("_count").alias("_count"))
    return summed.where((F.col("_count") != 0) | F.col(value).isNull())


def period_sketches(
    df: DataFrame, group: str = "stock_code", value: str = "quantity", time: str = "invoice_date",
    grain: str = "month",
) -> DataFrame:
    """One quantile sketch (KLL) of the values per group and period; sketches of other days or drops can be
    merged in. A sketch of up to 200 values is exact, beyond that a rank is off by about 1.3 %."""
    period = F.trunc(F.to_date(time), grain).alias("period")
    return (
        df.where(F.col(value).isNotNull() & F.col(time).isNotNull())
        .groupBy(group, period)
        .agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint")).alias("sketch"))
    )


def sliding_medians(sketches: DataFrame, periods: int, group: str = "stock_code") -> DataFrame:
    """Median of each group over the ``periods`` months up to each month for which one of them has values. Each sketch goes to the
    ``periods`` months it counts for, and is merged there: no value is read again."""
    ahead = F.explode(F.sequence(F.lit(0), F.lit(periods - 1))).alias("_ahead")
    merged = (
        sketches.select(group, "period", "sketch", ahead)
        .groupBy(group, F.add_months("period", F.col("_ahead")).alias("period"))
        .agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    )
    return merged.select(
        group,
        "period",
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5)).alias("median_qty"),
        F.kll_sketch_get_n_bigint("sketch").alias("n_lines"),
    )


def _counted_baseline(df: DataFrame, group: str, value: str) -> DataFrame:
    """Baseline from the count of each distinct value.

    Counting is combined map-side and spread by (group, value), so the window
    below sees the distinct values of a group, not its rows.
    """
    return counts_baseline(value_counts(df, group, value), group, value)


def counts_baseline(
    counts: DataFrame, group: str = "stock_code", value: str = "quantity"
) -> DataFrame:
    """Exact baseline from :func:`value_counts`."""
    v = F.col(value).cast("double")
    # One ordering for all sums, so that a partition is sorted once.
    ordered = Window.partitionBy(group).orderBy(value)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = counts.select(
        group,
        v.alias("_v"),
        "_count",
        F.sum("_count").over(whole).alias("_n"),
        (F.sum(v * F.col("_count")).over(whole) / F.nullif(F.sum("_count").over(whole), F.lit(0)))
        .alias("_mean"),
        F.sum("_count").over(ordered).alias("_upto"),
    )
    squares = F.sum(F.col("_count") * F.pow(F.col("_v") - F.col("_mean"), 2))
    spare = F.nullif(F.max("_n") - 1, F.lit(0))
    return placed.groupBy(group).agg(
        F.avg(F.when(_in_the_middle(), F.col("_v"))).alias(MEDIAN),
        F.sqrt(squares / spare).alias(STDDEV),
    )


def _bracketed_baseline(
    df: DataFrame, group: str, value: str, accuracy: int = 100_000
) -> DataFrame:
    """Baseline of values with any number of distinct numbers.

    Pass 1 brackets the middle of each group with approximate percentiles, five
    times wider than their error bound. Pass 2 counts rows below and above the
    bracket as two totals and keeps single values only inside it (a ten-thousandth
    of the group), then takes the middle by running count. A middle outside the
    bracket stops the job instead of giving a wrong answer.
    """
    half = 5.0 / accuracy
    rows = df.select(group, F.col(value).cast("double").alias("_v"))
    stats = (
        rows.groupBy(group)
        .agg(
            F.percentile_approx("_v", [0.5 - half, 0.5 + half], accuracy).alias("_bracket"),
            F.stddev("_v").alias(STDDEV),
            F.count("_v").alias("_n"),
        )
        .withColumnRenamed(group, "_g")
    )
    side = (
        F.when(F.col("_v") < F.col("_bracket")[0], -1)
        .when(F.col("_v") > F.col("_bracket")[1], 1)
        .otherwise(0)
    )
    counts = (
        rows.filter(F.col("_v").isNotNull())
        .join(stats, F.col(group).eqNullSafe(F.col("_g")))
        .select("_g", "_n", side.alias("_side"), "_v")
        .withColumn("_v", F.when(F.col("_side") == 0, F.col("_v")))
        .groupBy("_g", "_n", "_side", "_v")
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    inside = F.when(F.col("_side") == 0, F.col("_v")).otherwise(
        F.raise_error(F.lit("median outside its bracket")).cast("double")
    )
    ordered = Window.partitionBy("_g").orderBy("_side", "_v")
    medians = (
        counts.withColumn("_upto", F.sum("_count").over(ordered))
        .filter(_in_the_middle())
        .groupBy(F.col("_g").alias("_median_of"))
        .agg(F.avg(inside).alias(MEDIAN))
    )
    return stats.join(
        medians, F.col("_g").eqNullSafe(F.col("_median_of")), "left"
    ).select(F.col("_g").alias(group), MEDIAN, STDDEV)


def with_limits(
    df: DataFrame,
    group: str = "stock_code",
    value: str = "quantity",
    k: float = OUTLIER_FACTOR,
    exact: bool = True,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """Rows with the baseline of their group and the limit ``median + k * stddev``.

    A one-row group has no standard deviation; it counts as 0, so its row can
    never exceed the limit.
    """
    stats = group_baseline(df, group, value, exact) if baseline is None else baseline
    limit = F.col(MEDIAN) + F.lit(k) * F.coalesce(F.col(STDDEV), F.lit(0.0))
    return join_by_key(df, stats.withColumn(LIMIT, limit), [group])


def detect_anomalies(
    df: DataFrame,
    group: str = "stock_code",
    value: str = "quantity",
    k: float = OUTLIER_FACTOR,
    exact: bool = True,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """Rows strictly above the limit of their group, with baseline columns."""
    judged = with_limits(df, group, value, k, exact, baseline)
    return judged.filter(F.col(value) > F.col(LIMIT))


def anomaly_report(flagged: DataFrame) -> DataFrame:
    """The six columns of the alert."""
    return flagged.select(
        "invoice_no", "customer_id", "stock_code", "quantity", MEDIAN, LIMIT
    )


def alert_lines(flagged: DataFrame) -> DataFrame:
    """Fixed-width alert text, one ``line`` per flagged order."""
    return anomaly_report(flagged).select(alert_line().alias("line"))


def anomaly_records(
    flagged: DataFrame,
    as_of: dt.datetime | Column | None = None,
    order_id: str = "invoice_no",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Flagged orders in the shape of the anomaly table, status NEW.

    ``z_score`` is the distance from the median in standard deviations, NULL when
    the deviation is 0 or missing.
    """
    z = (F.col("quantity") - F.col(MEDIAN)) / F.nullif(F.col(STDDEV), F.lit(0.0))
    return flagged.select(
        F.col(order_id).cast("string").alias("order_id"),
        "stock_code",
        "quantity",
        F.col(MEDIAN).cast("double").alias("median_qty"),
        F.col(STDDEV).alias("std_deviation"),
        z.alias("z_score"),
        audit_time(as_of).alias("alert_timestamp"),
        F.lit(STATUS_NEW).alias("status"),
        *extra,
    ).select(*schemas.ANOMALIES.names, *extra)


CASE_KEY = ("order_id", "stock_code", "quantity")


def merge_records(known: DataFrame, found: DataFrame) -> DataFrame:
    """Known records as they are, with their status, and those found for the first time."""
    seen = known.select(*CASE_KEY).distinct()
    fresh = join_by_key(found, seen, list(CASE_KEY), "left_anti")
    return known.unionByName(fresh.select(*known.columns))


def refresh_baseline(
    df: DataFrame,
    anomalies: DataFrame,
    order_id: str = "invoice_no",
    group: str = "stock_code",
    value: str = "quantity",
    exact: bool = True,
) -> DataFrame:
    """Baseline over all orders except flagged ones that are not RESOLVED yet."""
    open_cases = (
        anomalies.filter(F.col("status") != STATUS_RESOLVED)
        .select("order_id", "stock_code", "quantity")
        .distinct()
    )
    same = {order_id: "order_id", group: "stock_code", value: "quantity"}
    rows = df.withColumn(order_id, F.col(order_id).cast("string"))
    counted = join_by_key(rows, open_cases, same, "left_anti")
    return group_baseline(counted, group, value, exact)


def drill_anomalies(
    records: DataFrame,
    product: str | None = None,
    start: str | None = None,
    end: str | None = None,
    min_z: float | None = None,
    time: str = "invoice_date",
) -> DataFrame:
    """Anomalies of a product, a half-open date range ``[start, end)``, a z-score floor."""
    tests = []
    if product is not None:
        tests.append(F.col("stock_code") == product)
    if start is not None:
        tests.append(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        tests.append(F.col(time) < F.lit(end).cast("timestamp_ntz"))
    if min_z is not None:
        tests.append(F.col("z_score") >= min_z)
    for test in tests:
        records = records.filter(test)
    return records
