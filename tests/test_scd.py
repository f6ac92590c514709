import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators import dims, scd
from tallyhouse.operators.dedup import latest_per_key
from tallyhouse.operators.upsert import upsert

PRODUCTS = "product_id string, stock_code string, unit_price double, price_date date"


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def prices(spark):
    def make(*data):
        full = [(f"{s}-2024-01-{d:02d}", s, p, day(d)) for s, p, d in data]
        return spark.createDataFrame(full, PRODUCTS)

    return make


def changes(df):
    return rows(df, "stock_code", "unit_price", "price_date")


def test_new_and_changed(prices):
    history = prices(("s1", 10.0, 1))
    batch = prices(("s1", 10.0, 2), ("s2", 5.0, 2), ("s1", 12.0, 2))
    found = changes(scd.scd2_changes(batch, history))
    assert found == [("s1", 12.0, day(2)), ("s2", 5.0, day(2))]


def test_unchanged_price_adds_nothing(prices):
    assert changes(scd.scd2_changes(prices(("s1", 10.0, 2)), prices(("s1", 10.0, 1)))) == []


def test_bootstrap_keeps_every_dated_price(prices):
    batch = prices(("s1", 10.0, 1), ("s1", 10.0, 2), ("s1", 11.0, 3), ("s1", 9.0, 3), ("s2", None, 1))
    assert changes(scd.scd2_changes(batch)) == [
        ("s1", 10.0, day(1)), ("s1", 10.0, day(2)), ("s1", 11.0, day(3)),
    ]
    assert changes(scd.scd2_changes(batch, late_policy="merge")) == [
        ("s1", 10.0, day(1)), ("s1", 11.0, day(3)),
    ]
    assert changes(scd.scd2_rejects(batch)) == [("s2", None, day(1))]


def test_null_latest_price_is_a_change_not_a_new_product(prices):
    history = prices(("s1", None, 1))
    assert changes(scd.scd2_changes(prices(("s1", 3.0, 2)), history)) == [("s1", 3.0, day(2))]


def test_late_row_by_policy(prices):
    history = prices(("s1", 10.0, 1), ("s1", 12.0, 5))
    late = prices(("s1", 10.0, 3))
    assert changes(scd.scd2_changes(late, history)) == [("s1", 10.0, day(3))]
    assert changes(scd.scd2_changes(late, history, late_policy="merge")) == []
    with pytest.raises(ValueError):
        scd.scd2_changes(late, history, late_policy="other")


def test_late_version_makes_its_successor_redundant(prices):
    history = prices(("s1", 10.0, 1), ("s1", 12.0, 5), ("s2", 1.0, 1))
    merged = scd.scd2_merge(prices(("s1", 12.0, 3)), history)
    assert changes(merged) == [("s1", 10.0, day(1)), ("s1", 12.0, day(3)), ("s2", 1.0, day(1))]


def _expected_merge(history, batch):
    by_key = {}
    for source in (history, batch):
        per_day = {}
        for s, p, d in source:
            per_day[(s, d)] = max(p, per_day.get((s, d), p))
        for (s, d), p in per_day.items():
            by_key.setdefault(s, {})[d] = p
    kept = []
    for s, versions in by_key.items():
        last = None
        for d in sorted(versions):
            if versions[d] != last:
                kept.append((s, versions[d], day(d)))
            last = versions[d]
    return sorted(kept, key=repr)


VERSION = st.tuples(
    st.sampled_from(["a", "b", "c"]), st.sampled_from([1.0, 2.0, 3.0]), st.integers(1, 9)
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(history=st.lists(VERSION, max_size=12), batch=st.lists(VERSION, max_size=12))
def test_merge_equals_brute_force_and_is_idempotent(prices, history, batch):
    merged = scd.scd2_merge(prices(*batch), prices(*history))
    expected = _expected_merge(history, batch)
    assert changes(merged) == expected
    again = scd.scd2_merge(prices(*batch), prices(*[(s, p, d.day) for s, p, d in expected]))
    assert changes(again) == expected


@pytest.mark.parametrize("policy", ["latest", "merge"])
def test_changes_run_twice_add_nothing(prices, policy):
    history = prices(("s1", 10.0, 1), ("s3", 7.0, 5), ("s4", 1.0, 1), ("s4", 2.0, 6))
    # s3 comes late with another price, s4 late and between two versions
    batch = prices(("s1", 12.0, 2), ("s2", 5.0, 2), ("s3", 8.0, 3), ("s4", 9.0, 4))
    for expected in (4, 0, 0):
        added = scd.scd2_changes(batch, history, late_policy=policy)
        assert len(changes(added)) == expected
        history = history.unionByName(added)


def test_intervals_do_not_overlap(prices):
    found = scd.scd2_intervals(prices(("s1", 1.0, 1), ("s1", 2.0, 4), ("s2", 3.0, 2)))
    assert rows(
        found, "stock_code", "effective_start_date", "effective_end_date", "is_current"
    ) == [
        ("s1", day(1), day(4), False),
        ("s1", day(4), None, True),
        ("s2", day(2), None, True),
    ]


def test_dim_products_has_the_declared_columns(prices):
    history = prices(("s1", 1.0, 1)).withColumn("description", F.lit("Laptop"))
    dim = dims.dim_products(history, "GBP")
    assert rows(dim) == [("s1-2024-01-01", "s1", "Laptop", 1.0, "GBP", day(1), None)]


def test_scd0_countries(spark):
    data = [("1101,Germany", 1), ("1101,Deutschland", 2), ("1102,France", 1), ("", 3)]
    lines = spark.createDataFrame(data, "value string, load_no int")
    found = dims.dim_countries(lines, [F.desc("load_no")])
    assert rows(found, "country_id", "country_name") == [
        ("1101", "Deutschland"), ("1102", "France"),
    ]
    assert dims.dim_countries(lines.select("value")).count() == 2


def test_customers(spark):
    tx = spark.createDataFrame([(1,), (1,), (2,), (None,)], "customer_id long")
    assert rows(dims.dim_customers(tx)) == [("1",), ("2",)]


def test_upsert_is_idempotent(spark):
    schema = "k string, v int, t int"
    target = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], schema)
    updates = spark.createDataFrame([("b", 3, 2), ("b", 4, 3), ("c", 5, 1)], schema)
    once = upsert(target, updates, ["k"], [F.desc("t")])
    expected = [("a", 1, 1), ("b", 4, 3), ("c", 5, 1)]
    assert rows(once) == expected
    assert rows(upsert(once, updates, ["k"], [F.desc("t")])) == expected


def test_latest_per_key_groups_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(latest_per_key(df, ["k"], [F.desc("v")])) == [("a", 3), (None, 2)]
