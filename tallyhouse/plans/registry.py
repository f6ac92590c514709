"""Every query by name: ``query(spark, sf_dir) -> DataFrame`` over whole tables.

Floating results are rounded to six places, so that they compare equal whatever
the order in which partial results were merged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.codes import continent_of, txn_key
from tallyhouse.functions.dates import parse_date_any, time_attributes
from tallyhouse.functions.fixed_values import (
    INVALID_DATE,
    STATUS_NEW,
    STATUS_RESOLVED,
    STATUS_REVIEWED,
)
from tallyhouse.functions.texts import to_lines
from tallyhouse.operators import anomaly, dims, facts, parse, quality, scd
from tallyhouse.operators.asof import asof_join, validity_join
from tallyhouse.operators.dedup import distinct_keys, latest_per_key
from tallyhouse.operators.upsert import repeated_keys, upsert
from tallyhouse.plans import jobs, reports
from tallyhouse.plans.session import shared_dir
from tallyhouse.sinks import files, tables
from tallyhouse.sources import samples
from tallyhouse.sources.lines import drop_path, read_drop, read_lines
from tallyhouse.sources.tables import is_bootstrap, register_views, table_or_default
from tallyhouse.streaming.facts import load_fact_stream
from tallyhouse.streaming.ingest import ingest_new, new_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TX_KEY = ("invoice_no", "stock_code", "customer_id")

def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- parsing and derivation -------------------------------------------------


@query
def parse_log_lines(spark, sf_dir):
    lines = samples.log_lines(spark, sf_dir)
    return parse.parse_transactions(lines, samples.audit_literal()).rows


@query
def parse_log_rejects(spark, sf_dir):
    return parse.parse_transactions(samples.log_lines(spark, sf_dir)).rejects


@query
def parse_products(spark, sf_dir):
    return parse.parse_products(samples.product_lines(spark, sf_dir)).rows


@query
def parse_product_rejects(spark, sf_dir):
    return parse.parse_products(samples.product_lines(spark, sf_dir)).rejects


@query
def parse_countries(spark, sf_dir):
    return parse.parse_countries(samples.country_lines(spark, sf_dir)).rows


@query
def parse_date_formats(spark, sf_dir):
    """Orders per date text and parsed date, over all accepted formats."""
    raw = parse.parse_lines(
        samples.log_lines(spark, sf_dir), ["invoice_no", "_s", "_q", "date_text"]
    )
    parsed, bad = parse_date_any(F.col("date_text"))
    return (
        raw.filter(F.col("date_text").isNotNull())
        .groupBy("date_text")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .select("date_text", "n_lines", parsed.alias("parsed"), bad.alias("is_date_error"))
    )


@query
def continent_counts(spark, sf_dir):
    return (
        samples.transactions(spark, sf_dir)
        .groupBy(continent_of(F.col("country_id")).alias("continent"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("quantity").alias("total_quantity"),
            F.min("quantity").alias("min_quantity"),
            F.max("quantity").alias("max_quantity"),
        )
    )


@query
def order_time_attributes(spark, sf_dir):
    return samples.load(spark, sf_dir, "orders").select(
        "o_orderkey", *time_attributes(F.col("o_orderdate"))
    )


@query
def event_time_attributes(spark, sf_dir):
    return (
        samples.load(spark, sf_dir, "events")
        .select(*time_attributes(F.col("ts")))
        .groupBy("year", "quarter", "month", "day", "day_of_week", "is_weekend")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


@query
def txn_key_concat(spark, sf_dir):
    return samples.transactions(spark, sf_dir).select(
        "invoice_no", "stock_code", txn_key().alias("transaction_id")
    )


@query
def txn_key_sha(spark, sf_dir):
    key = txn_key("sha256", facts.LINE_COLUMNS)
    return samples.transactions(spark, sf_dir).select(
        "invoice_no", "stock_code", key.alias("transaction_id")
    )


@query
def transaction_lines(spark, sf_dir):
    columns = ["invoice_no", "stock_code", "quantity", "invoice_date", "customer_id"]
    return to_lines(samples.transactions(spark, sf_dir), columns)


@query
def row_count(spark, sf_dir):
    return samples.transactions(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def distinct_products(spark, sf_dir):
    return distinct_keys(samples.transactions(spark, sf_dir), "stock_code")


@query
def preview(spark, sf_dir):
    tx = samples.transactions(spark, sf_dir)
    return tx.orderBy(*[F.col(name) for name in tx.columns]).limit(10)


# --- slowly changing dimensions ----------------------------------------------


@query
def dedup_latest_price(spark, sf_dir):
    order = [F.desc("price_date"), F.desc("unit_price")]
    return latest_per_key(samples.price_history(spark, sf_dir), ["stock_code"], order)


def _bands(spark, sf_dir):
    bands = samples.price_bands(spark, sf_dir)
    history = bands.filter(F.col("source") == "F").drop("source")
    batch = bands.filter(F.col("source") == "O").drop("source")
    return batch, history


@query
def scd2_changes(spark, sf_dir):
    return scd.scd2_changes(*_bands(spark, sf_dir))


@query
def scd2_bootstrap(spark, sf_dir):
    """All dated prices as a first load."""
    return scd.scd2_changes(samples.price_bands(spark, sf_dir).drop("source"))


@query
def scd2_bootstrap_merge(spark, sf_dir):
    bands = samples.price_bands(spark, sf_dir).drop("source")
    return scd.scd2_changes(bands, late_policy="merge")


@query
def scd2_changes_twice(spark, sf_dir):
    """History after the same batch, which holds late rows, came twice."""
    batch, history = _bands(spark, sf_dir)
    for _ in range(2):
        history = history.unionByName(scd.scd2_changes(batch, history))
    return history


@query
def scd2_late_changes(spark, sf_dir):
    return scd.scd2_changes(*_bands(spark, sf_dir), late_policy="merge")


@query
def scd2_late_merge(spark, sf_dir):
    return scd.scd2_merge(*_bands(spark, sf_dir))


@query
def scd2_intervals(spark, sf_dir):
    return scd.scd2_intervals(samples.price_history(spark, sf_dir))


@query
def scd0_countries(spark, sf_dir):
    tagged = parse.tag_countries(samples.country_lines(spark, sf_dir))
    return scd.scd0_latest(tagged, "country_id", [F.desc("load_no")]).select(
        "country_id", "country_name", "continent", "load_no"
    )


@query
def dim_products(spark, sf_dir):
    return dims.dim_products(samples.products(spark, sf_dir))


@query
def dim_countries(spark, sf_dir):
    lines = samples.country_lines(spark, sf_dir)
    return dims.dim_countries(lines, [F.desc("load_no")])


@query
def dim_customers(spark, sf_dir):
    return dims.dim_customers(samples.transactions(spark, sf_dir))


@query
def upsert_latest(spark, sf_dir):
    """The current price list of the history, brought up to date by the batch."""
    batch, history = _bands(spark, sf_dir)
    newest = [F.desc("price_date"), F.desc("unit_price")]
    current = latest_per_key(history, ["stock_code"], newest)
    return upsert(current, batch, ["stock_code"], newest)


# --- reference checks and joins ----------------------------------------------


def _fact(spark, sf_dir, **options):
    return facts.build_fact(
        samples.transactions(spark, sf_dir),
        samples.price_history(spark, sf_dir),
        samples.known_countries(spark, sf_dir),
        as_of=samples.audit_literal(),
        **options,
    )


@query
def fk_valid(spark, sf_dir):
    tx = samples.transactions(spark, sf_dir)
    return quality.validate_fk(tx, samples.known_countries(spark, sf_dir), "country_id").valid


@query
def fk_missing(spark, sf_dir):
    tx = samples.transactions(spark, sf_dir)
    return quality.validate_fk(tx, samples.known_countries(spark, sf_dir), "country_id").errors


@query
def fk_errors(spark, sf_dir):
    return _fact(spark, sf_dir).errors


@query
def fk_errors_two_rules(spark, sf_dir):
    """Country and product must exist; lines of another source have no product."""
    rules = [
        quality.country_rule(samples.known_countries(spark, sf_dir)),
        quality.product_rule(samples.products(spark, sf_dir)),
    ]
    split = quality.split_valid(samples.mixed_transactions(spark, sf_dir), rules)
    return quality.error_rows(split.errors, samples.audit_literal())


@query
def error_payload(spark, sf_dir):
    return quality.error_payloads(_fact(spark, sf_dir).errors)


def _asof(spark, sf_dir, **options):
    return asof_join(
        samples.transactions(spark, sf_dir),
        samples.price_history(spark, sf_dir),
        "stock_code",
        F.to_date("invoice_date"),
        "price_date",
        **options,
    )


@query
def asof_price(spark, sf_dir):
    return _asof(spark, sf_dir)


@query
def asof_union_last(spark, sf_dir):
    return _asof(spark, sf_dir, strategy="points")


@query
def asof_timestamp_prices(spark, sf_dir):
    """Days against prices that hold from a moment on."""
    since = F.col("price_date").cast("timestamp_ntz")
    prices = samples.price_history(spark, sf_dir).withColumn("price_time", since)
    return asof_join(
        samples.transactions(spark, sf_dir), prices.drop("price_date"), "stock_code",
        F.to_date("invoice_date"), "price_time", strategy="points",
    )


@query
def asof_left(spark, sf_dir):
    return _asof(spark, sf_dir, how="left")


@query
def asof_unpriced(spark, sf_dir):
    return _asof(spark, sf_dir, how="left_anti")


@query
def asof_one_per_key(spark, sf_dir):
    """Repeated lines of (invoice, product, customer) collapse to one."""
    return _asof(spark, sf_dir, key=TX_KEY)


@query
def price_validity_join(spark, sf_dir):
    tx = samples.transactions(spark, sf_dir)
    dim = dims.dim_products(samples.products(spark, sf_dir))
    day = F.to_date("invoice_date")
    return validity_join(tx, dim, "stock_code", day)


@query
def fact_transactions(spark, sf_dir):
    return _fact(spark, sf_dir).fact


@query
def fact_hashed_keys(spark, sf_dir):
    """The fact with one hashed key per line and another currency."""
    options = {"key_style": "sha256", "key_columns": facts.LINE_COLUMNS, "currency": "GBP"}
    return _fact(spark, sf_dir, **options).fact


@query
def fact_unpriced(spark, sf_dir):
    return _fact(spark, sf_dir).unpriced


@query
def fact_date_errors(spark, sf_dir):
    """Lines whose date could not be read are quarantined under their own message."""
    lines = samples.log_lines(spark, sf_dir)
    load = facts.build_fact(
        parse.parse_transactions(lines, samples.audit_literal()).rows,
        samples.price_history(spark, sf_dir),
        samples.known_countries(spark, sf_dir),
        as_of=samples.audit_literal(),
    )
    return load.errors.filter(F.col(quality.ERROR) == INVALID_DATE)


def _tagged(spark, sf_dir, lines=None, gathered=False, **options):
    return facts.tag_fact(
        samples.transactions(spark, sf_dir) if lines is None else lines,
        samples.price_history(spark, sf_dir, gathered),
        samples.known_countries(spark, sf_dir),
        as_of=samples.audit_literal(),
        **options,
    )


def _quarantine(tagged):
    """The error table, stored as the load job stores it."""
    failed = tagged.filter(F.col(quality.ERROR).isNotNull())
    errors = quality.error_rows(failed, samples.audit_literal())
    path = _scratch(tagged.sparkSession, "quarantine")
    errors.write.parquet(path)
    return tagged.sparkSession.read.schema(errors.schema).parquet(path)


def _recovery(spark, sf_dir, errors=None, gathered=False, **options):
    return facts.recover(
        _quarantine(_tagged(spark, sf_dir)) if errors is None else errors,
        samples.countries(spark, sf_dir),
        samples.price_history(spark, sf_dir, gathered),
        as_of=samples.audit_literal(),
        **options,
    )


def _stored(df, name):
    return jobs._stage(df, _scratch(df.sparkSession, name))


def _numbered(lines):
    """Stored lines with their line numbers."""
    return facts.with_line_number(lines, repeated=_stored(facts.repeated_lines(lines), "repeated"))


@query
def recover_fixed(spark, sf_dir):
    return _recovery(spark, sf_dir).fixed


@query
def recover_still_broken(spark, sf_dir):
    return _recovery(spark, sf_dir).still_broken


@query
def recover_twice(spark, sf_dir):
    """The fact with hashed keys after its quarantine was recovered twice."""
    # tagged once: the quarantine and the fact read the same stored lines, which get their numbers and keys as they are read
    tagged = _tagged(
        spark, sf_dir, gathered=True, apart=True, **jobs.UNIQUE_KEYS,
        store=lambda priced: _numbered(_stored(priced.drop("price_date"), "priced")),
    )
    fact = tagged.filter(F.col(quality.ERROR).isNull()).select(*schemas.FACT_TRANSACTIONS.names)
    # nearly every product has a quarantined line
    fixed = _recovery(
        spark, sf_dir, _numbered(_quarantine(tagged)), gathered=True, prune=False, **jobs.UNIQUE_KEYS,
        store=lambda priced: _stored(priced.drop("price_date"), "recovered"),
    ).fixed
    fact, fixed = facts.compact(fact), facts.compact(fixed)
    repeated = _stored(repeated_keys(fixed, ["transaction_id"]), "repeated")
    for _ in range(2):
        fact = upsert(fact, fixed, ["transaction_id"], [F.desc("invoice_no")], repeated)
    return facts.expanded(fact, samples.audit_literal())


@query
def replay_payloads(spark, sf_dir):
    """Quarantined lines read back from their JSON payloads and recovered."""
    payloads = quality.error_payloads(_quarantine(_tagged(spark, sf_dir)))
    return _recovery(spark, sf_dir, quality.replayed(payloads)).fixed


@query
def fact_two_drops(spark, sf_dir):
    """Two drops of log lines, some of them in both, loaded one after the other; the second batch is
    loaded once more under its number."""
    root = _scratch(spark, "increments")
    database = f"tally_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    fact, errors = jobs.create_fact_tables(spark, database)
    third = F.length("value") % 3
    sides = (
        samples.price_history(spark, sf_dir, gathered=True), samples.known_countries(spark, sf_dir), fact,
        errors, f"{root}/store", samples.audit_literal(),
    )
    # joined once for both drops
    lines = jobs._stage(samples.log_lines(spark, sf_dir), f"{root}/lines")
    for day, drop in (("2024-05-31", lines.where(third < 2)), ("2024-06-01", lines.where(third > 0))):
        files.write_lines(drop, drop_path(root, "logs", day), compression="gzip")
        load_fact_stream(spark, f"{root}/logs/*", *sides)
    again = parse.parse_transactions(lines.where(third > 0), samples.audit_literal()).rows
    jobs.load_fact_increment(again, 1, *sides)
    return spark.table(fact).select(*schemas.FACT_TRANSACTIONS.names)


# --- anomalies -----------------------------------------------------------------


@query
def product_baseline(spark, sf_dir):
    return _rounded(anomaly.group_baseline(samples.transactions(spark, sf_dir)), "stddev_qty")


@query
def product_baseline_approx(spark, sf_dir):
    tx = samples.transactions(spark, sf_dir)
    return _rounded(anomaly.group_baseline(tx, exact=False), "stddev_qty")


@query
def event_baseline(spark, sf_dir):
    events = samples.event_values(spark, sf_dir)
    return _rounded(anomaly.group_baseline(events), "median_qty", "stddev_qty")


@query
def baseline_of_ids(spark, sf_dir):
    """Exact median of 64-bit integers."""
    events = samples.load(spark, sf_dir, "events")
    return _rounded(
        anomaly.group_baseline(events, "event_type", "user_id"), "median_qty", "stddev_qty"
    )


def _flagged(spark, sf_dir):
    return anomaly.detect_anomalies(samples.transactions(spark, sf_dir))


@query
def anomalies(spark, sf_dir):
    return _rounded(anomaly.anomaly_report(_flagged(spark, sf_dir)), "median_stddev")


@query
def event_anomalies(spark, sf_dir):
    flagged = anomaly.detect_anomalies(samples.event_values(spark, sf_dir))
    return _rounded(anomaly.anomaly_report(flagged), "median_qty", "median_stddev")


@query
def alert_lines(spark, sf_dir):
    return anomaly.alert_lines(_flagged(spark, sf_dir))


@query
def anomaly_records(spark, sf_dir):
    records = anomaly.anomaly_records(_flagged(spark, sf_dir), samples.audit_literal())
    return _rounded(records, "std_deviation", "z_score")


@query
def baseline_refresh(spark, sf_dir):
    """Orders less than 2.05 deviations out were found to be real bulk orders."""
    tx = samples.transactions(spark, sf_dir)
    records = anomaly.anomaly_records(_flagged(spark, sf_dir), samples.audit_literal())
    reviewed = records.withColumn(
        "status", F.when(F.col("z_score") < 2.05, STATUS_RESOLVED).otherwise(STATUS_NEW)
    )
    return _rounded(anomaly.refresh_baseline(tx, reviewed), "stddev_qty")


@query
def baseline_two_days(spark, sf_dir):
    """Baselines from stored counts: the orders of one half of the year, then those of the other added without
    reading the first again, less the cases that are still open."""
    tx = samples.transactions(spark, sf_dir)
    early = F.month("invoice_date") <= 6
    path = _scratch(spark, "counts")
    anomaly.value_counts(tx.where(early)).write.parquet(path)
    stored = spark.read.parquet(path)
    state = anomaly.merge_counts(stored, anomaly.value_counts(tx.where(~early)))
    records = anomaly.anomaly_records(_flagged(spark, sf_dir), samples.audit_literal())
    still_open = tx.join(
        records.where("z_score >= 2.05").select(F.col("order_id").alias("invoice_no"), "stock_code", "quantity").distinct(),
        ["invoice_no", "stock_code", "quantity"], "left_semi",
    )
    state = anomaly.merge_counts(state, anomaly.value_counts(still_open), sign=-1)
    return _rounded(anomaly.counts_baseline(state), "stddev_qty")


@query
def median_by_period(spark, sf_dir):
    """Median quantity of a product in the three months up to each month, from one sketch per month."""
    sketches = anomaly.period_sketches(samples.transactions(spark, sf_dir))
    return anomaly.sliding_medians(sketches, periods=3)


@query
def anomalies_second_run(spark, sf_dir):
    """Records after a second run: statuses stay, open cases stay out of the baseline."""
    tx = samples.transactions(spark, sf_dir)
    records = anomaly.anomaly_records(_flagged(spark, sf_dir), samples.audit_literal())
    status = (
        F.when(F.col("z_score") < 2.05, STATUS_RESOLVED)
        .when(F.col("z_score") < 2.2, STATUS_REVIEWED)
        .otherwise(STATUS_NEW)
    )
    known = records.withColumn("status", status)
    again = anomaly.detect_anomalies(tx, baseline=anomaly.refresh_baseline(tx, known))
    found = anomaly.anomaly_records(again, samples.audit_literal())
    return _rounded(anomaly.merge_records(known, found), "std_deviation", "z_score")


@query
def anomaly_trend(spark, sf_dir):
    trend = reports.anomaly_trend(_flagged(spark, sf_dir))
    return _rounded(trend, "min_limit", "max_limit")


@query
def event_anomaly_trend(spark, sf_dir):
    flagged = anomaly.detect_anomalies(samples.event_values(spark, sf_dir))
    trend = reports.anomaly_trend(flagged, grain="day")
    return _rounded(trend, "max_quantity", "min_limit", "max_limit")


@query
def anomaly_drill(spark, sf_dir):
    flagged = anomaly.detect_anomalies(samples.event_values(spark, sf_dir))
    records = anomaly.anomaly_records(
        flagged, samples.audit_literal(), extra=["invoice_date"]
    )
    found = anomaly.drill_anomalies(
        records, product="purchase", start="2024-01-05", end="2024-01-20", min_z=2.5
    )
    return _rounded(found, "median_qty", "std_deviation", "z_score")


# --- reports -------------------------------------------------------------------


@query
def revenue_by_country(spark, sf_dir):
    return reports.revenue_by_country(
        _fact(spark, sf_dir).fact, samples.known_countries(spark, sf_dir)
    )


@query
def sales_by_region(spark, sf_dir):
    return reports.sales_by_region(_fact(spark, sf_dir).fact)


@query
def sales_by_continent(spark, sf_dir):
    return reports.sales_by_region(_fact(spark, sf_dir).fact, "continent")


@query
def top20_quantity(spark, sf_dir):
    products = samples.price_history(spark, sf_dir)
    return reports.top_products(_fact(spark, sf_dir).fact, products, "quantity")


@query
def top20_revenue(spark, sf_dir):
    priced = _tagged(spark, sf_dir).filter(F.col(quality.ERROR).isNull())
    return reports.top_products(priced, measure="revenue")


@query
def order_frequency(spark, sf_dir):
    return reports.order_frequency(_fact(spark, sf_dir).lines, bucket=2)


@query
def order_frequency_sketch(spark, sf_dir):
    """The same histogram from sketches of a customer's orders per month, merged."""
    sketches = reports.order_sketches(_fact(spark, sf_dir).lines)
    return reports.order_frequency_of(sketches, bucket=2)


@query
def cross_border(spark, sf_dir):
    return reports.cross_border(samples.supplier_sales(spark, sf_dir))


@query
def sales_by_year_sql(spark, sf_dir):
    """Ad-hoc SQL over registered views."""
    view = f"fact_{uuid.uuid4().hex}"
    register_views({view: _fact(spark, sf_dir).fact})
    found = spark.sql(
        f"""
        SELECT year(invoice_date) AS sales_year, count(*) AS n_lines,
               CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM {view} GROUP BY year(invoice_date)
        """
    )
    spark.catalog.dropTempView(view)
    return found


# --- sinks and repeatable ingest ------------------------------------------------


@query
def ingest_twice(spark, sf_dir):
    """Lines dropped as text files, ingested twice: the second run adds nothing."""
    root = _scratch(spark, "ingest")
    files.write_lines(samples.log_lines(spark, sf_dir), f"{root}/drop")
    tag = lambda lines: parse.tag_transactions(lines, samples.audit_literal())
    for _ in range(2):
        ingest_new(spark, f"{root}/drop", tag, f"{root}/table", f"{root}/progress")
    loaded = files.read_outcome(spark, f"{root}/table", "valid")
    return loaded.select(*schemas.TRANSACTIONS.names)


@query
def ingest_equal_lines(spark, sf_dir):
    """The same lines dropped on two days, ingested after each: both copies stay."""
    root = _scratch(spark, "drops")
    view = f"lines_{uuid.uuid4().hex}"
    for day in ("2024-05-31", "2024-06-01"):
        files.write_lines(samples.log_lines(spark, sf_dir), drop_path(root, "logs", day))
        for _ in range(2):
            jobs.ingest_transactions(
                spark, f"{root}/logs/*", view, f"{root}/store", samples.audit_literal()
            )
    loaded = spark.table(view).select(*schemas.TRANSACTIONS.names)
    for name in (view, f"{view}_rejects"):
        spark.sql(f"DROP VIEW {name}")
    return loaded


@query
def dated_drop(spark, sf_dir):
    """Of two days' drops the lines of one."""
    root = _scratch(spark, "dated")
    files.write_lines(samples.log_lines(spark, sf_dir), drop_path(root, "logs", "2024-05-31"))
    files.write_lines(samples.product_lines(spark, sf_dir), drop_path(root, "logs", "2024-06-01"))
    return read_drop(spark, root, "logs", "2024-06-01")


def _new_table(spark, sf_dir, schema):
    """An empty catalog table in a database of its own below the shared folder."""
    database = f"tally_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch(spark, database)}'")
    tables.create_table(spark, f"{database}.t", schema)
    return f"{database}.t"


@query
def catalog_append(spark, sf_dir):
    """History and batch appended to a catalog table one after the other."""
    batch, history = _bands(spark, sf_dir)
    table = _new_table(spark, sf_dir, batch.schema)
    for rows in (history, batch.select(*reversed(batch.columns))):
        tables.append(rows, table)
    return spark.table(table)


@query
def catalog_overwrite(spark, sf_dir):
    """A catalog table that held the history, overwritten by the batch."""
    batch, history = _bands(spark, sf_dir)
    table = _new_table(spark, sf_dir, batch.schema)
    tables.append(history, table)
    tables.overwrite(batch, table)
    return spark.table(table)


@query
def self_replace(spark, sf_dir):
    """A catalog table replaced twice by rows that are read from it."""
    prices = samples.price_history(spark, sf_dir)
    table = _new_table(spark, sf_dir, prices.schema)
    tables.append(prices, table)
    for _ in range(2):
        tables.replace_table(
            spark.table(table).withColumn("unit_price", F.col("unit_price") * 2), table
        )
    return spark.table(table)


@query
def upsert_catalog(spark, sf_dir):
    """Current prices of the history in a catalog table, with those of the batch upserted
    twice."""
    batch, history = _bands(spark, sf_dir)
    newest = [F.desc("price_date"), F.desc("unit_price")]
    table = _new_table(spark, sf_dir, batch.schema)
    tables.append(latest_per_key(history, ["stock_code"], newest), table)
    for _ in range(2):
        tables.upsert_table(latest_per_key(batch, ["stock_code"], newest), table, ["stock_code"])
    return spark.table(table)


def _dated_table(spark, sf_dir, rows):
    """A catalog table partitioned by year and month of the price date, with ``rows``."""
    database = f"tally_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch(spark, database)}'")
    tables.create_table(spark, f"{database}.t", _dated(rows).schema, ["year", "month"])
    tables.append(_dated(rows), f"{database}.t")
    return f"{database}.t"


def _dated(rows):
    return rows.withColumns({"year": F.year("price_date"), "month": F.month("price_date")})


@query
def upsert_partitioned(spark, sf_dir):
    """Current prices in month partitions, those of the batch upserted twice: a product moves
    to the month of its new price, and months without one keep their files."""
    batch, history = _bands(spark, sf_dir)
    newest = [F.desc("price_date"), F.desc("unit_price")]
    table = _dated_table(spark, sf_dir, latest_per_key(history, ["stock_code"], newest))
    latest = latest_per_key(batch, ["stock_code"], newest)
    for _ in range(2):
        tables.upsert_table(_dated(latest), table, ["stock_code"])
    return spark.table(table)


@query
def replace_partitioned(spark, sf_dir):
    """A partitioned table replaced twice by rows that are read from it; its last months go."""
    table = _dated_table(spark, sf_dir, samples.price_history(spark, sf_dir))
    for year in (2001, 2000):
        kept = spark.table(table).where(F.col("year") < year)
        tables.replace_table(kept.withColumn("unit_price", F.col("unit_price") * 2), table)
    return spark.table(table)


@query
def upsert_null_keys(spark, sf_dir):
    """Current prices with a NULL key for some products, upserted twice by the batch."""
    batch, history = _bands(spark, sf_dir)
    newest = [F.desc("price_date"), F.desc("unit_price"), F.desc("product_id")]
    key = F.when(F.pmod(F.col("stock_code").cast("int"), F.lit(5)) > 0, F.col("stock_code"))
    current, found = (rows.withColumn("stock_code", key) for rows in (history, batch))
    current = latest_per_key(current, ["stock_code"], newest)
    for _ in range(2):
        current = upsert(current, found, ["stock_code"], newest)
    return current


@query
def table_or_default_rows(spark, sf_dir):
    """The default while the table is empty, and its rows once it has some."""
    batch, history = _bands(spark, sf_dir)
    table = _new_table(spark, sf_dir, batch.schema)
    empty = table_or_default(spark, table, history).withColumn("first_load", F.lit(True))
    tables.append(batch, table)
    filled = table_or_default(spark, table, history).withColumn(
        "first_load", F.lit(is_bootstrap(spark, table))
    )
    return empty.unionByName(filled)


@query
def written_if_any(spark, sf_dir):
    """Rows that are there are written, of none nothing is: the sink is not called."""
    rejects = parse.parse_products(samples.product_lines(spark, sf_dir)).rejects
    table = _new_table(spark, sf_dir, rejects.schema)
    sink = lambda df: tables.append(df, table)
    for rows in (rejects, rejects.filter("value IS NULL")):
        tables.write_if_any(rows, sink, _scratch(spark, "any"))
    return spark.table(table)


@query
def snapshot_days(spark, sf_dir):
    """Snapshots of two days, the second written twice; counted per day."""
    path = _scratch(spark, "snapshot")
    batch, history = _bands(spark, sf_dir)
    for day, rows in (("2024-05-31", history), ("2024-06-01", history), ("2024-06-01", batch)):
        files.snapshot(rows, path, day)
    return (
        spark.read.parquet(path)
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("stock_code").alias("n_products"))
    )


@query
def reload_new_rows(spark, sf_dir):
    """Batch form of repeatable ingest: all lines, of which the "F" lines are loaded."""
    bands = samples.price_bands(spark, sf_dir)
    loaded = bands.filter(F.col("source") == "F")
    return new_rows(bands.drop("source"), loaded, ["stock_code", "price_date"])


@query
def text_round_trip(spark, sf_dir):
    """Lines written to text files and read back."""
    path = _scratch(spark, "lines")
    files.write_lines(samples.product_lines(spark, sf_dir), path)
    return read_lines(spark, path)


@query
def outcome_counts(spark, sf_dir):
    """Fact and quarantine written from one pass, then counted from the files."""
    path = _scratch(spark, "outcome")
    files.write_by_outcome(_tagged(spark, sf_dir), quality.ERROR, path)
    return (
        spark.read.parquet(path)
        .groupBy("outcome", quality.ERROR)
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("total_quantity"))
    )


@query
def fact_by_month(spark, sf_dir):
    """Fact written in year and month folders, then read back."""
    path = _scratch(spark, "fact")
    files.write_partitioned(_fact(spark, sf_dir).fact, "invoice_date", path)
    return (
        spark.read.parquet(path)
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double").alias("revenue"),
        )
    )


@query
def expired_snapshots(spark, sf_dir):
    """Daily snapshots of twelve days after the job that deletes all but the last seven days."""
    path = _scratch(spark, "retention")
    history = _bands(spark, sf_dir)[1]
    for day in range(20, 32):
        files.snapshot(history, path, f"2024-05-{day}")
    files.expire_snapshots(spark, path, "2024-05-31")
    return spark.read.parquet(path).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def recover_changed(spark, sf_dir):
    """Of the quarantine only the lines that the countries which arrived since can have mended."""
    errors = _quarantine(_tagged(spark, sf_dir))
    known = samples.known_countries(spark, sf_dir)
    arrived = samples.countries(spark, sf_dir).join(known, "country_id", "left_anti")
    split = quality.split_fixable(errors, arrived.where("country_id < '9920'"), None)
    fixed = _recovery(spark, sf_dir, split.fixable).fixed
    return fixed.select("invoice_no", "product_id", "country_id", F.lit("fixed").alias("state")).unionByName(
        split.waiting.select("invoice_no", F.lit(None).cast("string").alias("product_id"), "country_id",
                             F.lit("waiting").alias("state"))
    )


@query
def retain_recent(spark, sf_dir):
    """Events of the seven days before 2024-01-25, and later ones."""
    events = samples.load(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return files.retain_recent(events, "day", "2024-01-25").select(
        "event_id", "day", "event_type"
    )
