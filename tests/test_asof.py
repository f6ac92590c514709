import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.operators.asof import _bucket_of, asof_join, validity_join, versions_by_bucket
from tallyhouse.operators.scd import scd2_intervals

PRICES = "stock_code string, unit_price double, price_date date"
TX = "id int, stock_code string, at timestamp_ntz"


def when(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def prices(spark, *data):
    return spark.createDataFrame([(s, p, when(d).date()) for s, p, d in data], PRICES)


def sales(spark, *data):
    return spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(data)], TX)


def joined(left, right, **options):
    found = asof_join(left, right, "stock_code", F.to_date("at"), "price_date", **options)
    return rows(found, "id", "unit_price")


STRATEGIES = ["interval", "points"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_latest_earlier_price(spark, strategy):
    right = prices(spark, ("s1", 1.0, 0), ("s1", 2.0, 2), ("s1", 3.0, 8))
    left = sales(spark, ("s1", when(4)), ("s2", when(4)))
    assert joined(left, right, strategy=strategy) == [(0, 2.0)]
    assert joined(left, right, strategy=strategy, how="left") == [(0, 2.0), (1, None)]
    anti = asof_join(
        left, right, "stock_code", F.to_date("at"), "price_date", "left_anti", strategy
    )
    assert rows(anti, "id") == [(1,)] and anti.columns == left.columns


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_the_same_day_matches(spark, strategy):
    left = sales(spark, ("s1", when(4, hour=23)), ("s1", when(3, hour=23)))
    assert joined(left, prices(spark, ("s1", 1.0, 4)), strategy=strategy) == [(0, 1.0)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_nulls_and_empty_sides(spark, strategy):
    right = prices(spark, ("s1", 1.0, 0), (None, 9.0, 0))
    left = sales(spark, (None, when(4)), ("s1", None))
    assert joined(left, right, strategy=strategy) == []
    assert joined(left, right, strategy=strategy, how="left") == [(0, None), (1, None)]
    assert joined(left, right.limit(0), strategy=strategy, how="left") == [(0, None), (1, None)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_ties_break_the_same_way(spark, strategy):
    right = prices(spark, ("s1", 5.0, 1), ("s1", 7.0, 1), ("s1", 6.0, 1))
    assert joined(sales(spark, ("s1", when(40))), right, strategy=strategy) == [(0, 7.0)]


@pytest.mark.parametrize("bucket", ["day", "month", "year"])
def test_random_history_equals_brute_force(spark, bucket):
    rng = random.Random(7)
    versions = {
        (rng.choice("abcd"), rng.randrange(900)): float(rng.randrange(100)) for _ in range(150)
    }
    sold = [(rng.choice("abcde"), when(rng.randrange(-50, 1300))) for _ in range(400)]
    expected = []
    for i, (key, t) in enumerate(sold):
        days = [d for (k, d) in versions if k == key and when(d).date() <= t.date()]
        expected.append((i, versions[key, max(days)] if days else None))
    expected.sort(key=repr)
    right = prices(spark, *[(k, p, d) for (k, d), p in versions.items()])
    left = sales(spark, *sold)
    assert joined(left, right, how="left", bucket=bucket) == expected
    assert joined(left, right, how="left", strategy="points") == expected
    assert joined(left, right, bucket=bucket) == [r for r in expected if r[1] is not None]


def test_moments_work_as_well_as_days(spark):
    right = spark.createDataFrame(
        [("s1", 1.0, when(0, 8)), ("s1", 2.0, when(0, 12))],
        "stock_code string, unit_price double, since timestamp_ntz",
    )
    left = sales(spark, ("s1", when(0, 11)), ("s1", when(0, 12)), ("s1", when(0, 7)))
    for options in ({"bucket": "day"}, {"strategy": "points"}):
        found = asof_join(left, right, "stock_code", "at", "since", **options)
        assert rows(found, "id", "unit_price") == [(0, 1.0), (1, 2.0)]


def test_repeated_lines_collapse_only_on_request(spark):
    right = prices(spark, ("s1", 1.0, 0), ("s1", 2.0, 5))
    left = sales(spark, ("s1", when(1)), ("s1", when(6)), ("s1", when(7)))
    assert len(joined(left, right)) == 3
    # The latest price wins, then the larger id-free columns, so id 2.
    assert joined(left, right, key=["stock_code"]) == [(2, 2.0)]


def test_a_hot_key_is_whole(spark):
    left = spark.range(30_000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
            "stock_code"
        ),
        F.lit(when(400)).cast("timestamp_ntz").alias("at"),
    )
    right = prices(spark, *[("hot", float(d), d) for d in range(0, 500)])
    for strategy in STRATEGIES:
        found = joined(left, right, strategy=strategy)
        assert len(found) == 10_000 and {price for _, price in found} == {400.0}


def test_a_small_history_is_broadcast_by_spark_itself(spark):
    right = prices(spark, ("s1", 1.0, 0), ("s1", 2.0, 40))
    left = sales(spark, ("s1", when(4)), ("s1", when(50)), ("s2", when(4)))
    found = asof_join(left, right, "stock_code", F.to_date("at"), "price_date")
    assert "ResolvedHint" not in found._jdf.queryExecution().analyzed().toString()
    assert rows(found, "id", "unit_price") == [(0, 1.0), (1, 2.0)]
    found = found.select("id")
    found.collect()
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bucket", ["day", "month", "year"])
def test_far_dates_repeat_nothing(spark, bucket):
    far = [("s1", 1.0, dt.date(1, 1, 1)), ("s1", 2.0, dt.date(9999, 12, 31))]
    far += [(f"p{i}", 1.0, dt.date(1990, 1, 1)) for i in range(50)]
    right = spark.createDataFrame(far, PRICES)
    left = sales(spark, *[("s1", when(d)) for d in range(0, 900, 7)], ("p3", when(3)))
    intervals = scd2_intervals(right, "stock_code", "price_date", "_start", "_end")
    versions = intervals.drop("is_current").withColumnRenamed("stock_code", "_key")
    asked = left.withColumn("_bucket", _bucket_of(F.col("at"), bucket))
    pairs = asked.select("stock_code", "_bucket").distinct().count()
    placed = versions_by_bucket(asked, versions, "stock_code", bucket)
    assert placed.count() <= len(far) + pairs
    assert {p for _, p in joined(left, right, bucket=bucket)} == {1.0}


def test_days_meet_moments(spark):
    right = spark.createDataFrame(
        [("s1", 1.0, when(0)), ("s1", 2.0, when(2))],
        "stock_code string, unit_price double, since timestamp_ntz",
    )
    left = sales(spark, ("s1", when(1, 5)), ("s1", when(2, 5)), ("s1", when(-1)))
    for strategy in STRATEGIES:
        found = asof_join(
            left, right, "stock_code", F.to_date("at"), "since", strategy=strategy
        )
        assert rows(found, "id", "unit_price") == [(0, 1.0), (1, 2.0)]


def test_validity_join_bounds(spark):
    intervals = scd2_intervals(prices(spark, ("s1", 1.0, 0), ("s1", 2.0, 5)))
    left = sales(spark, ("s1", when(0)), ("s1", when(4, 23)), ("s1", when(5)), ("s1", when(-1)))
    found = validity_join(left, intervals, "stock_code", F.to_date("at"))
    assert rows(found, "id", "unit_price") == [(0, 1.0), (1, 1.0), (2, 2.0)]
    with pytest.raises(ValueError):
        validity_join(left, intervals, "stock_code", "at", how="cross")
    with pytest.raises(ValueError):
        validity_join(left, intervals, "stock_code", "at", bucket="week")
    with pytest.raises(ValueError):
        asof_join(left, intervals, "stock_code", "at", "unit_price", strategy="other")
