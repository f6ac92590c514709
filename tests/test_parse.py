import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.codes import continent_of, txn_key, version_key
from tallyhouse.functions.dates import parse_date_any, time_attributes, try_parse_timestamp
from tallyhouse.functions.fixed_values import CONTINENTS
from tallyhouse.functions.texts import alert_header, from_payload, to_lines, to_payload
from tallyhouse.operators import parse

GOOD = "482913,10001,5,2024-01-05 10:30:00,51234,1101-3"


def test_good_transaction(lines):
    row = parse.parse_transactions(lines(GOOD), dt.datetime(2024, 6, 1)).rows.first()
    assert row.asDict() == {
        "invoice_no": "482913",
        "stock_code": "10001",
        "quantity": 5,
        "invoice_date": dt.datetime(2024, 1, 5, 10, 30),
        "customer_id": "51234",
        "country_id": "1101",
        "region_code": "3",
        "ingestion_timestamp": dt.datetime(2024, 6, 1),
        "is_date_error": False,
    }


def test_transaction_schema_matches_the_table(lines):
    parsed = parse.parse_transactions(lines(GOOD)).rows
    assert [(f.name, f.dataType) for f in parsed.schema] == [
        (f.name, f.dataType) for f in schemas.TRANSACTIONS
    ]


@pytest.mark.parametrize(
    "line, reason",
    [
        ("482914,10001,x,2024-01-05 10:30:00,51234,1101-3", "quantity"),
        ("482915,10001", "quantity"),
        ("482918,10001,2,2024-01-05 10:30:00,51234,1101", "region"),
        (",10001,2,2024-01-05 10:30:00,51234,1101-3", "key"),
        ("482919,10001,99999999999,2024-01-05 10:30:00,51234,1101-3", "quantity"),
        ("just text", "key"),
    ],
)
def test_rejects_keep_the_line(lines, line, reason):
    parsed = parse.parse_transactions(lines(line, GOOD))
    assert rows(parsed.rejects) == [(line, reason)]
    assert parsed.rows.count() == 1


def test_blank_lines_are_dropped(lines):
    parsed = parse.parse_transactions(lines("", "   ", "\t", GOOD))
    assert parsed.rows.count() == 1 and parsed.rejects.count() == 0


def test_fields_are_trimmed(lines):
    parsed = parse.parse_transactions(lines("  1 , A2 , 3 ,2024-01-05 , 9 , 1101-3  ")).rows
    assert rows(parsed, "invoice_no", "stock_code", "quantity", "country_id", "region_code") == [
        ("1", "A2", 3, "1101", "3")
    ]


@pytest.mark.parametrize(
    "text, expected, bad",
    [
        ("2024-01-05 10:30:00", dt.datetime(2024, 1, 5, 10, 30), False),
        ("2024-01-05", dt.datetime(2024, 1, 5), False),
        ("05/01/2024", dt.datetime(2024, 1, 5), False),
        ("01-05-2024", dt.datetime(2024, 1, 5), False),
        ("31/02/2024", dt.datetime(1900, 1, 1), True),
        ("2024-01-05 25:00:00", dt.datetime(1900, 1, 1), True),
        ("5/1/2024", dt.datetime(1900, 1, 1), True),
        ("garbage", dt.datetime(1900, 1, 1), True),
        ("", dt.datetime(1900, 1, 1), True),
        (None, dt.datetime(1900, 1, 1), True),
    ],
)
def test_date_formats(spark, text, expected, bad):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(*parse_date_any(F.col("t"))).first()) == (expected, bad)


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("10/03/2024 02:30",), ("2024-03-10 02:30:00",)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        parsed, _ = parse_date_any(F.col("t"), ["dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss"])
        assert rows(df.select(parsed.cast("string"))) == [("2024-03-10 02:30:00",)] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_other_patterns_use_the_general_parser(spark):
    df = spark.createDataFrame([("5 Jan 2024",)], "t string")
    parsed = df.select(try_parse_timestamp(F.col("t"), "d MMM yyyy")).first()[0]
    assert parsed == dt.datetime(2024, 1, 5)


def test_products(lines):
    parsed = parse.parse_products(
        lines(
            "10001,Laptop,1196.99,2024-01-01",
            '10001,"Laptop, 15in",1196.99,2024-01-01',
            "10002,Phone,NaN,2024-01-01",
            "10003,Tablet,5.0,01/01/2024",
            "10004,Mouse",
        )
    )
    day = dt.date(2024, 1, 1)
    assert rows(parsed.rows) == [("10001-2024-01-01", "10001", "Laptop", 1196.99, day)]
    assert sorted(r[1] for r in rows(parsed.rejects)) == ["date", "price", "price", "price"]


def test_country_catalog(lines):
    # The sample country catalog.
    catalog = [
        "1101,Germany", "1102,France", "1103,Spain", "1104,Italy", "1305,Turkey",
        "2206,Nigeria", "2207,South Africa", "3308,India", "3309,Japan", "5510,Canada",
        "5011,USA", "4412,Australia", "3313,China", "9914,Nowhere",
    ]
    found = dict(rows(parse.parse_countries(lines(*catalog)).rows, "country_id", "continent"))
    assert found["1305"] == "Transcontinental (Europe/Asia)"
    assert found["5011"] == "North America/Global Territories (USA)"
    assert found["9914"] == "UNKNOWN" and len(found) == 14


def test_continents(spark):
    codes = [*CONTINENTS, "77", "", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    assert [r[0] for r in df.select(continent_of(F.col("c"))).collect()] == [
        *CONTINENTS.values(), "UNKNOWN", "UNKNOWN", "UNKNOWN",
    ]


def test_keys(spark):
    df = spark.createDataFrame(
        [("7", dt.datetime(2024, 1, 5, 10, 30))], "invoice_no string, invoice_date timestamp_ntz"
    )
    assert df.select(txn_key()).first()[0] == "7-2024-01-05 10:30:00"
    assert len(df.select(txn_key("sha256")).first()[0]) == 64
    assert df.select(version_key("invoice_no", "invoice_no")).first()[0] == "7-7"
    with pytest.raises(ValueError):
        txn_key("md5")


def test_time_attributes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10),)], "t timestamp_ntz")
    assert tuple(df.select(*time_attributes(F.col("t"))).first()) == (2024, 1, 3, 10, 1, True)


def test_lines_and_payload_round_trip(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert to_lines(df, ["x", "y", "z"]).first()[0] == "a,,3"
    payload = df.select(to_payload(["x", "y", "z"]).alias("p"))
    assert payload.first()[0] == '{"x":"a","y":null,"z":"3"}'
    back = payload.select(from_payload(F.col("p"), ["x", "y", "z"]).alias("r")).select("r.*")
    assert tuple(back.first()) == ("a", None, "3")


def test_alert_header():
    title, rule = alert_header().split("\n")
    assert title.startswith("Invoice         Customer        Stock Code      Qty        Median")
    assert rule == "-" * 90
