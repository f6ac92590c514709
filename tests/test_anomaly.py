import datetime as dt
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import anomaly

AS_OF = dt.datetime(2024, 6, 1)
TX = "invoice_no string, customer_id string, stock_code string, quantity {}, invoice_date timestamp_ntz"


def orders(spark, groups, kind="int"):
    data = [
        (f"{g}{i}", "c", g, q, dt.datetime(2024, 1, 1 + i % 28))
        for g, values in groups.items()
        for i, q in enumerate(values)
    ]
    return spark.createDataFrame(data, TX.format(kind))


def test_one_row_group_is_never_flagged(spark):
    assert anomaly.detect_anomalies(orders(spark, {"a": [99]})).count() == 0


def test_outlier_is_flagged(spark):
    df = orders(spark, {"a": [1] * 9 + [50], "b": [1, 2, 3, 10], "c": [4, 4, 4]})
    flagged = anomaly.detect_anomalies(df)
    (row,) = flagged.collect()
    assert (row.stock_code, row.quantity, row.median_qty) == ("a", 50, 1.0)
    assert row.median_stddev == pytest.approx(1 + 2 * statistics.stdev([1] * 9 + [50]))
    assert anomaly.detect_anomalies(df, k=0.5).count() == 2


def _check_baseline(spark, groups, kind):
    found = {
        r.stock_code: (r.median_qty, r.stddev_qty)
        for r in anomaly.group_baseline(orders(spark, groups, kind)).collect()
    }
    assert found.keys() == groups.keys()
    for group, values in groups.items():
        numbers = [v for v in values if v is not None]
        median, deviation = found[group]
        if not numbers:
            assert (median, deviation) == (None, None)
            continue
        assert median == statistics.median(numbers)
        if len(numbers) == 1:
            assert deviation is None
        else:
            assert deviation == pytest.approx(statistics.stdev(numbers), abs=1e-9)


def test_whole_number_baseline_equals_brute_force(spark):
    rng = random.Random(3)
    groups = {f"g{n}": [rng.randrange(60) for _ in range(n)] for n in range(1, 12)}
    groups |= {"hot": [rng.randrange(-9, 90) for _ in range(5000)], "none": [None], "mix": [None, 4]}
    groups |= {"same": [7, 7, 7, 7]}
    _check_baseline(spark, groups, "int")


def test_real_number_baseline_equals_brute_force(spark):
    rng = random.Random(5)
    groups = {f"g{n}": [rng.random() for _ in range(n)] for n in range(1, 12)}
    groups |= {"hot": [rng.expovariate(1) for _ in range(20_001)]}
    groups |= {"even": [rng.gauss(0, 1e6) for _ in range(20_000)]}
    groups |= {"ties": [1.5] * 4000 + [rng.random() for _ in range(3999)]}
    groups |= {"none": [None], "mix": [None, 4.5]}
    _check_baseline(spark, groups, "double")


def test_approximate_baseline(spark):
    df = orders(spark, {"a": [1, 2, 3, 10]})
    assert anomaly.group_baseline(df, exact=False).first().median_qty == 2.0


def test_records_and_z_score(spark):
    df = orders(spark, {"a": [1] * 9 + [50]})
    flagged = anomaly.detect_anomalies(df)
    records = anomaly.anomaly_records(flagged, AS_OF)
    assert records.columns == schemas.ANOMALIES.names
    row = records.first()
    assert (row.order_id, row.status, row.alert_timestamp) == ("a9", "NEW", AS_OF)
    assert row.z_score == pytest.approx(49 / statistics.stdev([1] * 9 + [50]))
    flat = anomaly.with_limits(orders(spark, {"b": [3, 3]}))
    assert [r.z_score for r in anomaly.anomaly_records(flat, AS_OF).collect()] == [None, None]


def test_alert_line_is_fixed_width(spark):
    flagged = anomaly.detect_anomalies(orders(spark, {"a": [1] * 9 + [50]}))
    line = anomaly.alert_lines(flagged).first().line
    assert line.startswith("a9" + " " * 14 + "c" + " " * 15 + "a" + " " * 15 + "50" + " " * 9)
    assert line.rstrip().endswith("31.99")
    assert anomaly.anomaly_report(flagged).columns == [
        "invoice_no", "customer_id", "stock_code", "quantity", "median_qty", "median_stddev",
    ]


def test_only_resolved_orders_count_toward_the_baseline(spark):
    df = orders(spark, {"a": [1] * 9 + [50]})
    records = anomaly.anomaly_records(anomaly.detect_anomalies(df), AS_OF)
    assert anomaly.refresh_baseline(df, records).first().stddev_qty == 0.0
    resolved = records.withColumn("status", F.lit("RESOLVED"))
    refreshed = anomaly.refresh_baseline(df, resolved).first()
    assert refreshed.stddev_qty == pytest.approx(statistics.stdev([1] * 9 + [50]))


def test_drill_down(spark):
    df = orders(spark, {"a": [1] * 9 + [50], "b": [1] * 20 + [60]})
    records = anomaly.anomaly_records(
        anomaly.detect_anomalies(df), AS_OF, extra=["invoice_date"]
    )
    assert anomaly.drill_anomalies(records).count() == 2
    assert rows(anomaly.drill_anomalies(records, product="b"), "order_id") == [("b20",)]
    assert anomaly.drill_anomalies(records, start="2024-01-15").count() == 1
    assert anomaly.drill_anomalies(records, end="2024-01-21").count() == 1
    assert anomaly.drill_anomalies(records, min_z=4.0).count() == 1


def test_wide_integers_are_never_whole_in_one_window(spark):
    rng = random.Random(9)
    groups = {"hot": [rng.randrange(2**50) for _ in range(20_001)], "few": [3, 1, 2], "none": [None]}
    _check_wide(spark, groups)


def _check_wide(spark, groups):
    df = orders(spark, groups, "bigint")
    found = {r.stock_code: r.median_qty for r in anomaly.group_baseline(df).collect()}
    assert found == {
        g: statistics.median(n) if (n := [v for v in values if v is not None]) else None
        for g, values in groups.items()
    }
    plan = anomaly.group_baseline(df)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    assert windows and all("_side" in line for line in windows)


def test_records_keep_their_status(spark):
    df = orders(spark, {"a": [1] * 9 + [50, 60], "b": [1] * 20 + [60]})
    first = anomaly.anomaly_records(anomaly.detect_anomalies(df), AS_OF)
    known = first.withColumn(
        "status", F.when(F.col("quantity") == 60, "REVIEWED").otherwise("RESOLVED")
    )
    again = anomaly.detect_anomalies(df, baseline=anomaly.refresh_baseline(df, known))
    merged = anomaly.merge_records(known, anomaly.anomaly_records(again, AS_OF))
    status = dict(rows(merged, "order_id", "status"))
    assert {k: v for k, v in status.items() if v != "NEW"} == dict(rows(known, "order_id", "status"))
    assert status["b20"] == "REVIEWED" and merged.count() == len(status)
