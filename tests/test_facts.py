import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import facts, quality
from tallyhouse.operators.anomaly import detect_anomalies
from tallyhouse.plans import reports

AS_OF = dt.datetime(2024, 6, 1)

# Fallback country ids of the transaction drops.
FALLBACK_IDS = ["1101", "1102", "1001", "1002", "5001", "1301", "1302", "3301", "4401", "6601"]


@pytest.fixture
def world(spark):
    tx = spark.createDataFrame(
        [
            (f"i{n}", "p1", 2, dt.datetime(2024, 1, 5), "c1", country, "3")
            for n, country in enumerate(FALLBACK_IDS)
        ]
        + [
            ("i10", "p9", 1, dt.datetime(2024, 1, 5), "c2", "1101", "1"),
            ("i11", "p1", 1, dt.datetime(1900, 1, 1), "c2", "1101", "1"),
            ("i12", "p1", 1, dt.datetime(2024, 1, 9), "c2", None, "1"),
            ("i13", "p1", 4, dt.datetime(2024, 1, 9), "c2", "1102", "1"),
            ("i13", "p1", 4, dt.datetime(2024, 1, 9), "c2", "1102", "1"),
        ],
        "invoice_no string, stock_code string, quantity int, invoice_date timestamp_ntz,"
        "customer_id string, country_id string, region_code string",
    )
    products = spark.createDataFrame(
        [
            ("p1-2024-01-01", "p1", "Laptop", 10.5, dt.date(2024, 1, 1)),
            ("p1-2024-01-08", "p1", "Laptop", 11.0, dt.date(2024, 1, 8)),
        ],
        schemas.PRODUCTS,
    )
    countries = spark.createDataFrame(
        [("1101", "Germany", "Europe"), ("1102", "France", "Europe"), ("1101", "Germany", "E")],
        schemas.COUNTRIES,
    )
    return tx, products, countries


def test_every_line_has_one_outcome(world):
    tx, products, countries = world
    load = facts.build_fact(tx, products, countries, AS_OF)
    assert (load.fact.count(), load.errors.count(), load.unpriced.count()) == (4, 10, 1)
    assert load.fact.columns == schemas.FACT_TRANSACTIONS.names
    assert load.errors.columns == schemas.TRANSACTIONS_ERROR.names
    messages = dict(rows(load.errors, "invoice_no", "error_message"))
    assert messages.pop("i11") == "Invalid Date"
    assert set(messages.values()) == {"Missing Country ID"}
    assert {r.error_message for r in load.unpriced.collect()} == {"Missing Price"}
    assert {r.retry_count for r in load.errors.collect()} == {0}


def test_fact_values(world):
    load = facts.build_fact(*world, AS_OF)
    row = load.fact.filter("invoice_no = 'i0'").first()
    assert row.transaction_id == "i0-2024-01-05 00:00:00"
    assert (row.product_id, row.unit_price, row.total_amount) == ("p1-2024-01-01", 10.5, 21.0)
    assert (row.currency, row.ingestion_timestamp) == ("$", AS_OF)
    assert {r.unit_price for r in load.fact.filter("invoice_no = 'i13'").collect()} == {11.0}


def test_strategies_agree(world):
    one = facts.build_fact(*world, AS_OF).fact
    two = facts.build_fact(*world, AS_OF, strategy="points").fact
    assert rows(one) == rows(two)


def test_flagged_and_missing_dates_are_invalid(world):
    tx, products, countries = world
    flagged = tx.withColumn("is_date_error", F.col("invoice_no") == "i0").withColumn(
        "invoice_date", F.when(F.col("invoice_no") != "i1", F.col("invoice_date"))
    )
    for failed in (
        facts.build_fact(flagged, products, countries, AS_OF).errors,
        quality.error_rows(
            facts.tag_fact(flagged, products, countries, AS_OF).filter("error_message IS NOT NULL"),
            AS_OF,
        ),
    ):
        bad = failed.filter("error_message = 'Invalid Date'")
        assert rows(bad, "invoice_no", "is_date_error") == [
            ("i0", True), ("i1", False), ("i11", False),
        ]
        again = facts.recover(failed, countries, products, AS_OF).still_broken
        assert again.filter("error_message = 'Invalid Date'").count() == 3


def test_equal_lines_have_keys_of_their_own(world):
    tx, products, countries = world
    keys = {"key_style": "sha256", "key_columns": facts.UNIQUE_COLUMNS}
    runs = [
        facts.tag_fact(facts.with_line_number(tx), products, countries, AS_OF, **keys)
        for _ in range(2)
    ]
    one, two = (rows(r, "transaction_id", "invoice_no") for r in runs)
    assert one == two and len({key for key, _ in one}) == tx.count()


def test_payloads_are_read_back(world):
    load = facts.build_fact(*world, AS_OF)
    errors = load.errors.filter("error_message = 'Missing Country ID'")
    back = quality.replayed(quality.error_payloads(errors))
    shared = [c for c in errors.columns if c in back.columns]
    assert rows(back, *shared) == rows(errors, *shared) and len(shared) == 10


def test_collapse_on_the_line_key(world):
    key = ["invoice_no", "stock_code", "customer_id"]
    fact = facts.build_fact(*world, AS_OF, collapse_on=key).fact
    assert fact.count() == 3


def test_one_pass_form_equals_the_outputs(world):
    tagged = facts.tag_fact(*world, AS_OF)
    load = facts.build_fact(*world, AS_OF)
    valid = tagged.filter("error_message IS NULL").select(*load.fact.columns)
    assert rows(valid) == rows(load.fact)
    failed = tagged.filter("error_message IS NOT NULL")
    expected = load.errors.unionByName(load.unpriced)
    assert rows(failed, "invoice_no", "stock_code", "error_message") == rows(
        expected, "invoice_no", "stock_code", "error_message"
    )


def test_rules_report_the_first_failure(world):
    tx, products, countries = world
    rules = [quality.country_rule(countries), quality.product_rule(products)]
    split = quality.split_valid(tx, rules)
    found = dict(rows(split.errors, "invoice_no", "error_message"))
    assert found["i10"] == "Missing Product" and found["i12"] == "Missing Country ID"
    assert split.valid.count() + split.errors.count() == tx.count()


def test_validate_fk_partitions_the_rows(world):
    tx, _, countries = world
    split = quality.validate_fk(tx, countries, "country_id")
    assert (split.valid.count(), split.errors.count()) == (6, 9)


def test_recovery_conserves_rows(world, spark):
    tx, products, countries = world
    load = facts.build_fact(tx, products, countries, AS_OF)
    quarantine = load.errors.unionByName(load.unpriced)
    newer = countries.unionByName(
        spark.createDataFrame([("5001", "USA", "x"), ("6601", "Peru", "y")], schemas.COUNTRIES)
    )
    result = facts.recover(quarantine, newer, products, AS_OF)
    assert rows(result.fixed, "invoice_no", "total_amount") == [("i4", 21.0), ("i9", 21.0)]
    assert result.fixed.count() + result.still_broken.count() == quarantine.count()
    assert {r.retry_count for r in result.still_broken.collect()} == {1}
    messages = dict(rows(result.still_broken, "invoice_no", "error_message"))
    assert messages["i10"] == "Missing Price" and messages["i2"] == "Missing Country ID"


def test_error_payloads(world):
    payload = quality.error_payloads(facts.build_fact(*world, AS_OF).errors).first()
    assert len(payload.error_id) == 64 and '"country_id":' in payload.payload


def test_reports(world, spark):
    tx, products, countries = world
    fact = facts.build_fact(tx, products, countries, AS_OF).fact
    by_country = rows(reports.revenue_by_country(fact, countries.dropDuplicates(["country_id"])))
    assert by_country == [("1101", "Germany", 21.0, 1, 1), ("1102", "France", 109.0, 3, 2)]
    assert rows(reports.sales_by_region(fact)) == [("1", 88.0, 8, 2), ("3", 42.0, 4, 2)]
    assert rows(reports.sales_by_region(fact, "continent")) == [("Europe", 130.0, 12, 4)]
    top = reports.top_products(fact, products, "revenue", 1).first()
    assert tuple(top) == ("p1", 130.0)  # both price versions together
    assert rows(reports.top_products(fact, products, "quantity", 5)) == [("p1", 12)]
    assert rows(reports.order_frequency(fact)) == [(1, 1), (2, 1)]
    assert rows(reports.cross_border(fact)) == [("c1", 2)]
    with pytest.raises(ValueError):
        reports.sales_by_region(fact, "planet")
    flagged = detect_anomalies(
        spark.createDataFrame(
            [("s", q, dt.datetime(2024, 1, q % 3 + 1)) for q in [1] * 9 + [50]],
            "stock_code string, quantity int, invoice_date timestamp_ntz",
        )
    )
    for grain, period in (("day", dt.date(2024, 1, 3)), ("month", dt.date(2024, 1, 1))):
        row = reports.anomaly_trend(flagged, grain=grain).first()
        assert (row.period, row.n_anomalies, row.max_quantity) == (period, 1, 50)
