"""Table schemas. Column order is part of the contract for positional inserts."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


LINES = _schema(("value", T.StringType()))

TRANSACTIONS = _schema(
    ("invoice_no", T.StringType()),
    ("stock_code", T.StringType()),
    ("quantity", T.IntegerType()),
    ("invoice_date", T.TimestampNTZType()),
    ("customer_id", T.StringType()),
    ("country_id", T.StringType()),
    ("region_code", T.StringType()),
    ("ingestion_timestamp", T.TimestampType()),
    ("is_date_error", T.BooleanType()),
)

PRODUCTS = _schema(
    ("product_id", T.StringType()),
    ("stock_code", T.StringType()),
    ("description", T.StringType()),
    ("unit_price", T.DoubleType()),
    ("price_date", T.DateType()),
)

COUNTRIES = _schema(
    ("country_id", T.StringType()),
    ("country_name", T.StringType()),
    ("continent", T.StringType()),
)

DIM_PRODUCTS = _schema(
    ("product_id", T.StringType()),
    ("stock_code", T.StringType()),
    ("description", T.StringType()),
    ("unit_price", T.DoubleType()),
    ("currency", T.StringType()),
    ("effective_start_date", T.DateType()),
    ("effective_end_date", T.DateType()),
)

DIM_COUNTRIES = COUNTRIES

DIM_CUSTOMERS = _schema(("customer_id", T.StringType()))

FACT_TRANSACTIONS = _schema(
    ("transaction_id", T.StringType()),
    ("invoice_no", T.StringType()),
    ("product_id", T.StringType()),
    ("country_id", T.StringType()),
    ("region_code", T.StringType()),
    ("customer_id", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("currency", T.StringType()),
    ("invoice_date", T.TimestampNTZType()),
    ("ingestion_timestamp", T.TimestampType()),
)

TRANSACTIONS_ERROR = _schema(
    ("invoice_no", T.StringType()),
    ("stock_code", T.StringType()),
    ("customer_id", T.StringType()),
    ("quantity", T.IntegerType()),
    ("invoice_date", T.TimestampNTZType()),
    ("country_id", T.StringType()),
    ("region_code", T.StringType()),
    ("error_message", T.StringType()),
    ("retry_count", T.IntegerType()),
    ("ingestion_timestamp", T.TimestampType()),
    ("is_date_error", T.BooleanType()),
)

ANOMALIES = _schema(
    ("order_id", T.StringType()),
    ("stock_code", T.StringType()),
    ("quantity", T.IntegerType()),
    ("median_qty", T.DoubleType()),
    ("std_deviation", T.DoubleType()),
    ("z_score", T.DoubleType()),
    ("alert_timestamp", T.TimestampType()),
    ("status", T.StringType()),
)
