"""The star-schema sample tables as warehouse tables.

Transactions are order lines; a price history is the highest price per piece and
ship day; the country master comes from nations and regions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.codes import continent_of, label_of, version_key
from tallyhouse.functions.fixed_values import UNKNOWN_CONTINENT

# Region name -> country-code prefix; "99" has no continent.
REGION_PREFIX = {
    "AFRICA": "22",
    "AMERICA": "55",
    "ASIA": "33",
    "EUROPE": "11",
    "MIDDLE EAST": "99",
}


def audit_literal() -> Column:
    """A fixed run time, so that results compare equal between runs."""
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


# Declared, so that opening a table needs no job to read its footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_nationkey, country_id, country_name."""
    prefix = label_of(F.col("r_name"), REGION_PREFIX)
    return (
        load(spark, sf_dir, "nation")
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "n_nationkey",
            F.concat(prefix, F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(
                "country_id"
            ),
            F.col("n_name").alias("country_name"),
        )
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete country master."""
    return nations(spark, sf_dir).select(
        "country_id", "country_name", continent_of(F.col("country_id")).alias("continent")
    )


def known_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master before the countries without a continent were added."""
    return countries(spark, sf_dir).filter(F.col("continent") != UNKNOWN_CONTINENT)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with order, customer country and all columns the models use."""
    customers = load(spark, sf_dir, "customer").join(
        nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = load(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    return load(spark, sf_dir, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        "country_id",
        (F.col("l_suppkey") % 6 + 1).cast("string").alias("region_code"),
        audit_literal().alias("ingestion_timestamp"),
    )


def mixed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, and events as lines of products that no product list has."""
    events = load(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("invoice_no"),
        F.col("event_type").alias("stock_code"),
        F.col("value").cast("int").alias("quantity"),
        F.col("ts").alias("invoice_date"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit("2200").alias("country_id"),
        F.lit("1").alias("region_code"),
        audit_literal().alias("ingestion_timestamp"),
    )
    return transactions(spark, sf_dir).unionByName(events)


def price_history(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """One price per product and ship day, in whole cents. ``gathered`` brings the lines of a product together
    first, for those who order its prices by day: they are then shuffled once for both."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    # whole cents before the shuffle, where they take less room; NaN stays the greatest
    cents = F.when(F.isnan(price), price).otherwise(F.floor(price * 100 + 0.5).cast("double"))
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.to_date("l_shipdate").alias("price_date"),
        cents.alias("_cents"),
    )
    return (
        (lines.repartition("stock_code") if gathered else lines)
        .groupBy("stock_code", "price_date")
        .agg((F.floor(F.max("_cents")) / 100).alias("unit_price"))
        .select(
            version_key("stock_code", "price_date").alias("product_id"),
            "stock_code",
            "unit_price",
            "price_date",
        )
    )


def with_description(spark: SparkSession, sf_dir: str, history: DataFrame) -> DataFrame:
    names = load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
    )
    return history.join(names, "stock_code").select(
        "product_id", "stock_code", "description", "unit_price", "price_date"
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_description(spark, sf_dir, price_history(spark, sf_dir))


def price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations rounded down to 2000s, so that many do not change.

    ``source`` is the line status: "F" lines are the history, "O" lines a batch.
    """
    price = F.max(F.col("l_extendedprice") / F.col("l_quantity"))
    history = (
        load(spark, sf_dir, "lineitem")
        .groupBy(
            "l_partkey",
            F.to_date("l_shipdate").alias("price_date"),
            F.col("l_linestatus").alias("source"),
        )
        .agg((F.floor(price / 2000) * 2000.0).alias("unit_price"))
        .withColumn("stock_code", F.col("l_partkey").cast("string"))
        .withColumn("product_id", version_key("stock_code", "price_date"))
    )
    return history.select("product_id", "stock_code", "unit_price", "price_date", "source")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction lines as text, with every kind of dirt a drop may hold.

    Line 7 has no numeric quantity, lines 5 have one with a fraction, lines 2 not returned
    have tabs around it; returned lines 4 are cut short; returned and shipped lines 3 are
    blank; pending lines 6 lack the region; open lines have padded fields; the date format
    depends on the order priority.
    """
    iso = F.col("o_orderdate").cast("string")
    year, month, day = F.substring(iso, 1, 4), F.substring(iso, 6, 2), F.substring(iso, 9, 2)
    priority = F.substring("o_orderpriority", 1, 1)
    date_text = (
        F.when(priority == "1", iso)
        .when(priority == "2", F.concat_ws("/", day, month, year))
        .when(priority == "3", F.substring(iso, 1, 10))
        .when(priority == "4", F.concat_ws("-", month, day, year))
        .otherwise("unknown")
    )
    line = F.col("l_linenumber")
    whole = F.col("l_quantity").cast("int").cast("string")
    quantity = (
        F.when(line == 7, "x")
        .when(line == 5, F.concat(whole, F.lit(".7")))
        .when((line == 2) & (F.col("l_returnflag") == "N"), F.concat(F.lit("\t"), whole, F.lit("\t ")))
        .otherwise(whole)
    )
    region = (F.col("l_suppkey") % 6 + 1).cast("string")
    geo = F.when((line == 6) & (F.col("o_orderstatus") == "P"), F.col("country_id")).otherwise(
        F.concat_ws("-", "country_id", region)
    )
    sep = F.when(F.col("l_linestatus") == "O", " , ").otherwise(",")
    head = F.concat(F.col("o_orderkey").cast("string"), sep, F.col("l_partkey").cast("string"))
    full = F.concat(
        head, sep, quantity, sep, date_text, sep, F.col("o_custkey").cast("string"), sep, geo
    )
    returned = F.col("l_returnflag") == "R"
    value = (
        F.when((line == 3) & returned & (F.col("l_linestatus") == "F"), "   ")
        .when((line == 4) & returned, head)
        .otherwise(full)
    )
    return order_lines(spark, sf_dir).select(value.alias("value"))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price lines as text; discounted lines name their price in words, names of large
    parts hold a separator, and prices of small ones stand between tabs."""
    day = F.to_date("l_shipdate").cast("string")
    cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5)
    price = F.when(F.col("l_discount") >= 0.1, "on request").otherwise(
        (cents / 100).cast("decimal(12,2)").cast("string")
    )
    price = F.when(F.col("p_size") <= 5, F.concat(F.lit("\t"), price, F.lit("\t"))).otherwise(price)
    name = F.when(F.col("p_size") >= 45, F.concat_ws(", ", "p_name", "p_brand")).otherwise(
        F.col("p_name")
    )
    parts = load(spark, sf_dir, "part")
    return (
        load(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws(",", F.col("l_partkey").cast("string"), name, price, day).alias("value")
        )
    )


def country_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One country line per supplier record: later suppliers rename their country."""
    suppliers = load(spark, sf_dir, "supplier").join(
        nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return suppliers.select(
        F.concat(
            F.lit(" "), "country_id", F.lit(" , "), "country_name", F.lit(" v"),
            F.col("s_suppkey").cast("string"),
        ).alias("value"),
        F.col("s_suppkey").alias("load_no"),
    )


def supplier_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice, customer and the country of the supplier each line was bought from."""
    suppliers = load(spark, sf_dir, "supplier").join(
        nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    lines = load(spark, sf_dir, "lineitem").join(
        load(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("o_orderkey").cast("string").alias("invoice_no"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        "country_id",
    )


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a second series: group = event type, quantity = value."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("invoice_no"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("stock_code"),
        F.col("value").alias("quantity"),
        F.col("ts").alias("invoice_date"),
    )
