"""Keys of different types are compared by value."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.operators import anomaly
from tallyhouse.operators.joins import join_by_key
from tallyhouse.operators.quality import validate_fk

DAY, MOMENT = dt.date(2024, 1, 5), dt.datetime(2024, 1, 5)
PAIRS = [
    ("int", 5, "bigint", 5),
    ("int", 5, "double", 5.0),
    ("bigint", 2**40, "decimal(20,2)", Decimal(2**40)),
    ("decimal(10,2)", Decimal("5.00"), "decimal(12,4)", Decimal("5.0000")),
    ("double", 0.0, "double", -0.0),
    ("float", 0.5, "double", 0.5),
    ("date", DAY, "timestamp_ntz", MOMENT),
    ("date", DAY, "timestamp", MOMENT),
    ("string", "5", "int", 5),
]


@pytest.mark.parametrize("left, a, right, b", PAIRS)
def test_equal_values_of_two_types_match(spark, left, a, right, b):
    for one, x, two, y in ((left, a, right, b), (right, b, left, a)):
        many = spark.createDataFrame([(1, x), (2, None)], f"id int, k {one}")
        keyed = spark.createDataFrame([(y, "found")], f"k {two}, v string")
        assert rows(join_by_key(many, keyed, ["k"]), "id", "v") == [(1, "found")]
        assert rows(join_by_key(many, keyed, ["k"], "left_anti"), "id") == [(2,)]
        assert join_by_key(many, keyed, ["k"]).schema["k"].dataType == many.schema["k"].dataType


def test_text_that_is_no_number_matches_nothing(spark):
    many = spark.createDataFrame([("5",), ("A5",)], "k string")
    keyed = spark.createDataFrame([(5,)], "k int")
    split = validate_fk(many, keyed, "k")
    assert rows(split.valid) == [("5",)] and rows(split.errors) == [("A5",)]


def test_condition_on_both_sides(spark):
    many = spark.createDataFrame([(1, 1), (1, 9)], "k int, t int")
    keyed = spark.createDataFrame([(1, 5)], "k int, since int")
    late = F.col("since") <= F.col("t")
    assert rows(join_by_key(many, keyed, ["k"], where=late)) == [(1, 9, 5)]
    assert rows(join_by_key(many, keyed, ["k"], "left", late)) == [(1, 1, None), (1, 9, 5)]


def test_open_cases_of_integer_records_leave_a_real_baseline(spark):
    df = spark.createDataFrame(
        [(f"o{i}", "c", "a", float(q), MOMENT) for i, q in enumerate([1] * 9 + [50])],
        "invoice_no string, customer_id string, stock_code string, quantity double, "
        "invoice_date timestamp_ntz",
    )
    records = anomaly.anomaly_records(anomaly.detect_anomalies(df), MOMENT)
    stored = records.withColumn("quantity", F.col("quantity").cast("int"))
    assert anomaly.refresh_baseline(df, stored).first().stddev_qty == 0.0
