"""Physical plans: no Python workers, no cross products, hot keys are split."""

import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import anomaly, quality, scd
from tallyhouse.operators.asof import asof_join
from tallyhouse.plans.registry import QUERIES

SF_DIR = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.001")

# These write files while they are built; their parts are covered by other names.
WRITING = {
    "ingest_twice", "text_round_trip", "outcome_counts", "fact_by_month", "ingest_equal_lines",
    "dated_drop", "catalog_append", "catalog_overwrite", "self_replace", "upsert_catalog",
    "table_or_default_rows", "written_if_any", "snapshot_days", "recover_fixed",
    "recover_still_broken", "recover_twice", "replay_payloads", "upsert_partitioned",
    "replace_partitioned", "fact_two_drops", "baseline_two_days", "expired_snapshots",
    "recover_changed",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan_stays_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_rank_filter_is_applied_before_the_shuffle(spark):
    for name in ("dedup_latest_price", "scd2_bootstrap", "asof_one_per_key"):
        text = plan(QUERIES[name](spark, SF_DIR))
        limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
        assert any("Partial" in line for line in limits) and "Final" in limits[0], name


def scans(df, column):
    """How often a file scan reads ``column``."""
    return sum("FileScan" in line and column in line for line in plan(df).splitlines())


def test_transactions_are_read_once_to_be_priced(spark):
    # once as transactions and once as the price history
    assert scans(QUERIES["fact_transactions"](spark, SF_DIR), "l_partkey") == 2
    assert scans(QUERIES["asof_price"](spark, SF_DIR), "l_partkey") == 2
    assert "unit_price" not in plan(QUERIES["order_frequency"](spark, SF_DIR))


def test_a_merge_shuffles_keys_of_the_batch_only(spark):
    history = spark.range(100_000).selectExpr(
        "concat(id, '-1') AS product_id", "cast(id AS string) AS stock_code", "1.0D AS unit_price",
        "DATE '2024-01-01' AS price_date",
    )
    batch = history.where("stock_code IN ('5', '6')").selectExpr(
        "product_id", "stock_code", "2.0D AS unit_price", "DATE '2024-02-01' AS price_date"
    )
    merged = scd.scd2_merge(batch, history)
    assert merged.count() == 100_002
    merged.collect()
    text = plan(merged)
    passed = text[text.index("Union") :].split("LeftAnti")[0]
    assert "LeftAnti" in text and "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text.split("== Initial Plan ==")[0], passed


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["cross_border"](spark, SF_DIR))
    assert "l_extendedprice" not in text and "o_totalprice" not in text


@pytest.fixture
def many_partitions(spark):
    small = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_key_is_split(spark, many_partitions):
    ids = spark.range(0, 60_000, 1, 8)
    tx = ids.select(
        F.col("id").cast("string").alias("invoice_no"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias(
            "stock_code"
        ),
        (F.col("id") % 50 + 1).cast("int").alias("quantity"),
        F.lit("2024-03-05 10:00:00").cast("timestamp_ntz").alias("invoice_date"),
        (F.col("id") % 100).cast("string").alias("customer_id"),
    )
    prices = tx.select(
        "stock_code", F.lit(1.5).alias("unit_price"), F.lit("2024-01-01").cast("date").alias("day")
    ).distinct()
    day = F.to_date("invoice_date")
    joins = {
        "interval": asof_join(tx, prices, "stock_code", day, "day"),
        "points": asof_join(tx, prices, "stock_code", day, "day", strategy="points"),
        "left": asof_join(tx, prices, "stock_code", day, "day", "left"),
        "anti": asof_join(tx, prices, "stock_code", day, "day", "left_anti"),
        "rule": quality.tag_errors(tx, [quality.product_rule(prices)]),
        "semi": quality.validate_fk(tx, prices, "stock_code").valid,
        "limits": anomaly.with_limits(tx),
    }
    for name, df in joins.items():
        rows = len(df.collect())
        assert "skew=true" in plan(df), name
        assert rows == (0 if name == "anti" else 60_000), name


def test_recovered_fact_tags_the_lines_once(spark):
    # the quarantine is written from stored tagged lines, and the fact reads the same ones
    assert scans(QUERIES["recover_twice"](spark, SF_DIR), "l_suppkey") == 0


def test_recovered_fact_is_shuffled_in_its_short_form(spark):
    # 32 bytes of the hash, and no columns that follow from others
    text = plan(QUERIES["recover_twice"](spark, SF_DIR))
    short = [line for line in text.splitlines() if "unhex(sha2" in line]
    assert short and not any("total_amount" in line for line in short)
