"""Sales and anomaly reports on the gold tables.

Money is summed as decimal, so a total does not depend on the order in which
tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.codes import continent_of


def _money(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def _with_period(df: DataFrame, time: str, grain: str) -> DataFrame:
    day = F.to_date(time)
    if grain == "day":
        return df.withColumn("period", day)
    return df.withColumn("period", F.trunc(day, grain).cast("date"))


def revenue_by_country(fact: DataFrame, countries: DataFrame) -> DataFrame:
    """Revenue, line count and invoice count per country.

    Sums first and names the few result rows afterwards.
    """
    per_country = fact.groupBy("country_id").agg(
        _money("total_amount").alias("revenue"),
        F.count(F.lit(1)).alias("n_lines"),
        F.countDistinct("invoice_no").alias("n_orders"),
    )
    return per_country.join(countries, "country_id").select(
        "country_id", "country_name", "revenue", "n_lines", "n_orders"
    )


def sales_by_region(fact: DataFrame, level: str = "region_code") -> DataFrame:
    """Revenue, quantity and line count per ``region_code`` or ``continent``."""
    if level == "continent":
        fact = fact.withColumn("continent", continent_of(F.col("country_id")))
    elif level != "region_code":
        raise ValueError(f"unknown level: {level}")
    return fact.groupBy(level).agg(
        _money("total_amount").alias("revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def top_products(
    fact: DataFrame, products: DataFrame | None = None, measure: str = "quantity", n: int = 20
) -> DataFrame:
    """The ``n`` best products by ``quantity`` or ``revenue``; ties by stock code.

    The fact names price versions; ``products`` gives the product of each. Lines are summed per
    version first, so only versions meet the dimension. A fact that still has its ``stock_code``, as
    ``facts.tag_fact`` gives it, needs no dimension.
    """
    name, column = {
        "quantity": ("total_quantity", F.col("quantity")),
        "revenue": ("revenue", F.col("total_amount").cast("decimal(18,2)")),
    }[measure]
    if products is None:
        summed = fact.select("stock_code", column.alias("_sum"))
    else:
        versions = fact.groupBy("product_id").agg(F.sum(column).alias("_sum"))
        product_of = products.select("product_id", "stock_code").distinct()
        summed = versions.join(product_of, "product_id")
    total = F.sum("_sum").cast("bigint" if measure == "quantity" else "double")
    return (
        summed.groupBy("stock_code")
        .agg(total.alias(name))
        .orderBy(F.desc(name), F.asc("stock_code"))
        .limit(n)
    )


def order_frequency(fact: DataFrame, bucket: int = 1) -> DataFrame:
    """Histogram: how many customers placed how many orders, in steps of ``bucket``."""
    orders = fact.groupBy("customer_id").agg(F.countDistinct("invoice_no").alias("n"))
    low = F.floor(F.col("n") / bucket) * bucket
    return (
        orders.groupBy(low.cast("long").alias("orders_from"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )


def order_sketches(fact: DataFrame, grain: str = "month") -> DataFrame:
    """One sketch (HLL) of a customer's orders per period. It can be stored; a later period only adds its own."""
    return (
        _with_period(fact, "invoice_date", grain)
        .groupBy("customer_id", "period")
        .agg(F.hll_sketch_agg("invoice_no", 12).alias("orders"))
    )


def order_frequency_of(sketches: DataFrame, bucket: int = 1) -> DataFrame:
    """:func:`order_frequency` from sketches of any periods. Counts of a few dozen orders are exact, large ones
    are off by about 1.6 %."""
    merged = sketches.groupBy("customer_id").agg(F.hll_union_agg("orders").alias("orders"))
    low = F.floor(F.hll_sketch_estimate("orders") / bucket) * bucket
    return merged.groupBy(low.cast("long").alias("orders_from")).agg(F.count(F.lit(1)).alias("n_customers"))


def cross_border(fact: DataFrame) -> DataFrame:
    """Customers who bought in more than one country."""
    per_customer = fact.groupBy("customer_id").agg(
        F.countDistinct("country_id").alias("n_countries")
    )
    return per_customer.filter(F.col("n_countries") > 1)


def anomaly_trend(flagged: DataFrame, time: str = "invoice_date", grain: str = "month") -> DataFrame:
    """Flagged orders per period with the lowest and highest limit they broke."""
    return (
        _with_period(flagged, time, grain)
        .groupBy("period")
        .agg(
            F.count(F.lit(1)).alias("n_anomalies"),
            F.max("quantity").alias("max_quantity"),
            F.min("median_stddev").alias("min_limit"),
            F.max("median_stddev").alias("max_limit"),
        )
    )
