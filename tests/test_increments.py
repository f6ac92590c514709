"""Partitioned tables, incremental loads, stored baselines and expiry."""

import datetime as dt
import glob
import os
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.operators import anomaly, facts, quality
from tallyhouse.operators.asof import asof_join, packed_versions
from tallyhouse.operators.upsert import repeated_keys, upsert
from tallyhouse.plans import jobs, reports
from tallyhouse.sinks import files, tables
from tallyhouse.streaming.facts import load_fact_stream

AS_OF = dt.datetime(2024, 6, 1)
MONTHS = "key string, value int, month int"


@pytest.fixture
def db(spark):
    spark.sql("DROP DATABASE IF EXISTS shelf CASCADE")
    spark.sql("CREATE DATABASE shelf")
    yield "shelf"
    spark.sql("DROP DATABASE shelf CASCADE")


def made(spark, *data):
    return spark.createDataFrame(list(data), MONTHS)


@pytest.fixture
def monthly(spark, db):
    tables.create_table(spark, "shelf.t", made(spark).schema, ["month"])
    tables.append(made(spark, ("a", 1, 1), ("b", 2, 2), ("c", 3, 3), (None, 4, 3), ("n", 5, None)), "shelf.t")
    return "shelf.t"


def folders(spark, table):
    """Data files of each partition folder."""
    where = tables._location(spark, table).removeprefix("file:")
    found = {}
    for path in glob.glob(f"{where}/*/*.parquet"):
        found.setdefault(os.path.basename(os.path.dirname(path)), set()).add(os.path.basename(path))
    return found


def test_an_upsert_rewrites_touched_partitions_only(spark, monthly):
    before = folders(spark, monthly)
    # a moves from month 1, which is empty then, to month 4; a NULL key is a key
    change = made(spark, ("a", 10, 4), (None, 40, 3))
    for _ in range(2):
        tables.upsert_table(change, monthly, ["key"])
        assert rows(spark.table(monthly)) == sorted(
            [("a", 10, 4), ("b", 2, 2), ("c", 3, 3), (None, 40, 3), ("n", 5, None)], key=repr
        )
    after = folders(spark, monthly)
    assert after["month=2"] == before["month=2"]
    assert after["month=__HIVE_DEFAULT_PARTITION__"] == before["month=__HIVE_DEFAULT_PARTITION__"]
    assert after["month=3"] != before["month=3"] and "month=1" not in after
    tables.upsert_table(made(spark), monthly, ["key"])
    tables.upsert_table(made(spark, ("n", 6, 2)), monthly, ["key"])
    assert ("n", 6, 2) in rows(spark.table(monthly)) and spark.table(monthly).count() == 5


def test_a_partitioned_table_is_replaced_by_rows_of_itself(spark, monthly):
    for _ in range(2):
        doubled = spark.table(monthly).where("month IS NULL OR month > 1").withColumn("value", F.col("value") * 2)
        tables.replace_table(doubled, monthly)
    assert sorted(r[0] for r in rows(spark.table(monthly), "value")) == [8, 12, 16, 20]
    tables.replace_table(spark.table(monthly).limit(0), monthly)
    assert spark.table(monthly).count() == 0
    tables.append(made(spark, ("z", 1, 1)), monthly)
    assert rows(spark.table(monthly)) == [("z", 1, 1)]


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["_stage_swap", "finish_swap", "overwrite_partitions", "_delete"])
def test_a_swap_stopped_at_any_step_is_whole_or_finished_later(spark, monthly, monkeypatch, step):
    old = rows(spark.table(monthly))
    change = made(spark, ("a", 10, 4), ("b", 20, 2))
    new = sorted([("a", 10, 4), ("b", 20, 2), ("c", 3, 3), (None, 4, 3), ("n", 5, None)], key=repr)
    real, calls = getattr(tables, step), []

    def stop(*args, **kwargs):
        calls.append(step)
        if step == "finish_swap" and len(calls) == 1:
            return real(*args, **kwargs)
        raise Stop

    monkeypatch.setattr(tables, step, stop)
    with pytest.raises(Stop):
        tables.upsert_table(change, monthly, ["key"])
    monkeypatch.undo()
    if step in ("_stage_swap", "finish_swap", "overwrite_partitions"):
        assert rows(spark.table(monthly)) == old
    else:
        assert rows(spark.table(monthly)) == new
    finished = tables.finish_swap(spark, monthly)
    assert finished == (step != "_stage_swap")
    assert rows(spark.table(monthly)) == (new if finished else old)
    assert not tables.finish_swap(spark, monthly)
    tables.upsert_table(change, monthly, ["key"])
    assert rows(spark.table(monthly)) == new


def test_new_keys_are_added_without_rewriting(spark, monthly):
    before = folders(spark, monthly)
    change = made(spark, ("d", 6, 2), ("e", 7, 4), ("f", 8, None))
    tables.upsert_table(change, monthly, ["key"])
    after = folders(spark, monthly)
    assert all(before[name] <= after[name] for name in before)
    assert len(after["month=2"]) == len(before["month=2"]) + 1 and len(after["month=4"]) == 1
    held = [("a", 1, 1), ("b", 2, 2), ("c", 3, 3), (None, 4, 3), ("n", 5, None), ("d", 6, 2), ("e", 7, 4), ("f", 8, None)]
    assert rows(spark.table(monthly)) == sorted(held, key=repr)
    # repeated keys of a batch are one row, whatever their partitions
    tables.upsert_table(made(spark, ("g", 1, 5), ("g", 2, 6), ("g", 2, 6)), monthly, ["key"])
    assert rows(spark.table(monthly).where("key = 'g'")) == [("g", 2, 6)]


@pytest.mark.parametrize("step", ["_list_partitions", "_move_files", "moved", "_delete"])
def test_an_insert_stopped_at_any_step_is_whole_or_finished_later(spark, monthly, monkeypatch, step):
    old = rows(spark.table(monthly))
    change = made(spark, ("d", 6, 2), ("e", 7, 4))
    name, real = step.replace("moved", "_move_files"), tables._move_files

    def stop(*args):
        if step == "moved":
            real(*args)
        raise Stop

    monkeypatch.setattr(tables, name, stop)
    with pytest.raises(Stop):
        tables.upsert_table(change, monthly, ["key"])
    monkeypatch.undo()
    assert tables.finish_swap(spark, monthly) == (step != "_list_partitions")
    new = sorted([*old, ("d", 6, 2), ("e", 7, 4)], key=repr)
    assert rows(spark.table(monthly)) == (old if step == "_list_partitions" else new)
    for _ in range(2):
        tables.upsert_table(change, monthly, ["key"])
        assert rows(spark.table(monthly)) == new


def test_partition_values_of_all_kinds(spark, db):
    kind = "v int, day date, name string, flag boolean"
    data = [(1, dt.date(2024, 1, 2), "it's a/b=c\\d", True), (2, None, "x", False), (3, dt.date(2024, 1, 3), None, None)]
    df = spark.createDataFrame(data, kind)
    tables.create_table(spark, "shelf.k", df.schema, ["day", "name", "flag"])
    tables.append(df, "shelf.k")
    tables.replace_table(spark.table("shelf.k").where("v = 3"), "shelf.k")
    assert rows(spark.table("shelf.k"), "v") == [(3,)]


def test_new_keys_in_partitions_of_all_kinds(spark, db):
    kind = "v int, day date, name string, flag boolean"
    data = [(1, dt.date(2024, 1, 2), "it's a/b=c\\d 100%", True), (2, None, "x", False), (3, dt.date(2024, 1, 3), None, None)]
    df = spark.createDataFrame(data, kind)
    tables.create_table(spark, "shelf.k", df.schema, ["day", "name", "flag"])
    tables.upsert_table(df, "shelf.k", ["v"])
    tables.upsert_table(df.withColumn("v", F.col("v") + 3), "shelf.k", ["v"])
    assert rows(spark.table("shelf.k")) == sorted([*data, *[(v + 3, *rest) for v, *rest in data]], key=repr)


def test_null_keys_are_updated(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1)], "key string, n int")
    change = spark.createDataFrame([(None, 2), ("b", 2)], "key string, n int")
    for _ in range(2):
        target = upsert(target, change, ["key"], [F.desc("n")])
    assert rows(target) == sorted([(None, 2), ("a", 1), ("b", 2)], key=repr)


def test_updates_of_single_keys_are_not_ranked(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1), ("c", 1)], "key string, n int")
    for data in ([(None, 2), ("b", 2)], [(None, 2), (None, 3), ("b", 2), ("b", 1), ("a", 5)], []):
        change = spark.createDataFrame(data, target.schema)
        quick = target
        for _ in range(2):
            quick = upsert(quick, change, ["key"], [F.desc("n")], repeated_keys(change, ["key"]))
        assert rows(quick) == rows(upsert(target, change, ["key"], [F.desc("n")]))


def test_fact_rows_come_back_from_their_short_form(spark):
    day = dt.datetime(2024, 1, 5)
    names = "invoice_no string, invoice_date timestamp_ntz, stock_code string, customer_id string, quantity int, country_id string, region_code string"
    lines = spark.createDataFrame(
        [("i1", day, "s", "c", 2, "11", "1"), ("i1", day, "s", "c", 2, "11", "1"), ("i2", day, "s", None, 3, "99", None),
         ("i3", None, "s", "c", 1, "11", "1"), ("i4", day, "t", "c", 1, "11", "1")], names
    )
    products = spark.createDataFrame([("p", "s", 1.1, dt.date(2024, 1, 1))], "product_id string, stock_code string, unit_price double, price_date date")
    countries = spark.createDataFrame([("11",)], "country_id string")
    lines = facts.with_line_number(lines)
    whole = facts.tag_fact(lines, products, countries, AS_OF, **jobs.UNIQUE_KEYS)
    stored = []
    apart = facts.tag_fact(
        lines, products, countries, AS_OF, apart=True, store=lambda df: stored.append(df) or df.drop("price_date"), **jobs.UNIQUE_KEYS
    )
    assert rows(apart) == rows(whole) and not {"transaction_id", "total_amount"} & set(stored[0].columns)
    fact = whole.where("error_message IS NULL").drop("stock_code", "error_message")
    short = facts.compact(fact)
    assert {len(r[0]) for r in short.select("transaction_id").collect()} == {32}
    assert rows(facts.expanded(short, AS_OF)) == rows(fact) and fact.count() == 2


# --- incremental facts --------------------------------------------------------------------

LINE = "{},10001,5,{},51234,{}-3"


def drop(path, *texts):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(texts) + "\n")


@pytest.fixture
def shop(spark, db, tmp_path):
    products = spark.createDataFrame(
        [("p1", "10001", 2.0, dt.date(2024, 1, 1))], "product_id string, stock_code string, unit_price double, price_date date"
    )
    countries = spark.createDataFrame([("1101",)], "country_id string")
    fact, errors = jobs.create_fact_tables(spark, db)
    return products, countries, fact, errors, f"{tmp_path}/store", AS_OF


def test_drops_are_added_once(spark, shop, tmp_path):
    one = LINE.format("i1", "2024-01-05 10:30:00", "1101")
    drop(f"{tmp_path}/in/a", one, one, LINE.format("i2", "2024-02-05", "1101"), LINE.format("i3", "2024-02-05", "9999"))
    load_fact_stream(spark, f"{tmp_path}/in", *shop)
    fact, errors = shop[2:4]
    assert rows(spark.table(fact), "invoice_no", "year", "month") == [("i1", 2024, 1)] * 2 + [("i2", 2024, 2)]
    files_before = {p for p in glob.glob(f"{tables._location(spark, fact).removeprefix('file:')}/*/month=2/*.parquet")}
    drop(f"{tmp_path}/in/b", one, LINE.format("i4", "2024-01-06", "9999"))
    for _ in range(2):
        load_fact_stream(spark, f"{tmp_path}/in", *shop)
    held = spark.table(fact)
    assert held.count() == 4 and held.select("transaction_id").distinct().count() == 4
    files_after = {p for p in glob.glob(f"{tables._location(spark, fact).removeprefix('file:')}/*/month=2/*.parquet")}
    assert files_before == files_after
    assert rows(spark.table(errors), "invoice_no", "batch_id") == [("i3", 0), ("i4", 1)]
    # the keys are those of a load of everything at once
    every = spark.read.text(f"{tmp_path}/in/*")
    tagged = jobs.parse.parse_transactions(every, AS_OF).rows
    whole = facts.tag_fact(facts.with_line_number(facts.standardise(tagged)), *shop[:2], AS_OF, **jobs.UNIQUE_KEYS)
    assert rows(held, "transaction_id") == rows(whole.where("error_message IS NULL"), "transaction_id")


@pytest.mark.parametrize("step", ["write", "upsert", "errors", "mark"])
def test_a_batch_stopped_at_any_step_is_added_once(spark, shop, monkeypatch, step):
    def batch(*ids):
        kind = "invoice_no string, stock_code string, quantity int, invoice_date timestamp_ntz, customer_id string, country_id string, region_code string, ingestion_timestamp timestamp, is_date_error boolean"
        day = dt.datetime(2024, 1, 5)
        return spark.createDataFrame(
            [(i, "10001", 1, day, "c", "9999" if i == "bad" else "1101", "1", AS_OF, False) for i in ids], kind
        )

    jobs.load_fact_increment(batch("a", "b"), 0, *shop)

    def stop(*args, **kwargs):
        raise Stop

    where, name = {"write": (jobs, "_stage"), "upsert": (jobs.tables, "upsert_table"),
                   "errors": (jobs.tables, "overwrite_partitions"), "mark": (type(spark), "range")}[step]
    monkeypatch.setattr(where, name, stop)
    with pytest.raises(Stop):
        jobs.load_fact_increment(batch("a", "a", "bad"), 1, *shop)
    monkeypatch.undo()
    assert jobs.load_fact_increment(batch("a", "a", "bad"), 1, *shop)
    assert not jobs.load_fact_increment(batch("a", "a", "bad"), 1, *shop)
    assert rows(spark.table(shop[2]), "invoice_no") == [("a",)] * 3 + [("b",)]
    assert rows(spark.table(shop[3]), "invoice_no") == [("bad",)]


def test_equal_lines_are_numbered(spark):
    day = dt.datetime(2024, 1, 5)
    lines = [("i1", day, "s", "c", 1, "11", "1", 0), ("i1", day, "s", "c", 1, "11", "1", 9)] + [
        ("i2", None, "s", None, 2, "11", "1", 0)
    ] * 500 + [("i3", day, "s", "c", 1, "11", "1", 0)]
    names = "invoice_no string, invoice_date timestamp_ntz, stock_code string, customer_id string, quantity int, country_id string, region_code string, extra int"
    df = spark.createDataFrame(lines, names)
    numbers = Counter()
    for r in facts.with_line_number(df).collect():
        numbers[r.invoice_no, r.line_no] += 1
    assert numbers == Counter([("i1", 1), ("i1", 2), *[("i2", n) for n in range(1, 501)], ("i3", 1)])
    before = df.where("invoice_no = 'i3'").select(facts.line_hash().alias("_line"), F.lit(7).alias("n"))
    assert rows(facts.with_line_number(df, before).where("invoice_no = 'i3'"), "line_no") == [(8,)]


# --- as-of, quarantine, baselines, sketches, expiry --------------------------------------------


def test_a_key_with_more_versions_than_fit_in_a_row(spark):
    versions = spark.range(300).selectExpr("'k' AS key", "id AS since", "id AS price")
    packed = packed_versions(
        versions.selectExpr("key AS _key", "since AS _start", "lead(since) OVER (ORDER BY since) AS _end", "price"), chunk=8
    )
    found = rows(packed, "_since", "_until")
    assert len(found) == 5 and max(len(c) for r in packed.collect() for c in [r._chunks]) == 8
    days = spark.range(-5, 320).selectExpr("'k' AS key", "id AS at")
    joined = asof_join(days, versions, "key", "at", "since", "left")
    assert joined.count() == 325
    for at, price in rows(joined, "at", "price"):
        assert price == (None if at < 0 else min(at, 299))


def test_only_lines_that_can_be_mended_are_looked_at(spark):
    day = dt.datetime(2024, 1, 5)
    errors = spark.createDataFrame(
        [("a", "s1", "11", "Missing Country ID"), ("b", "s1", "22", "Missing Country ID"), ("c", "s1", "11", "Missing Price"),
         ("d", "s2", "11", "Missing Price"), ("e", "s3", "11", "Missing Price"), ("f", "s1", "11", "Invalid Date"), ("g", None, None, None)],
        "invoice_no string, stock_code string, country_id string, error_message string",
    ).withColumn("invoice_date", F.lit(day).cast("timestamp_ntz"))
    countries = spark.createDataFrame([("11",), (None,)], "country_id string")
    prices = spark.createDataFrame(
        [("s1", dt.date(2024, 1, 5)), ("s1", dt.date(2024, 3, 1)), ("s2", dt.date(2024, 1, 6))], "stock_code string, price_date date"
    )
    for sides, wanted in (((countries, prices), "ac"), ((countries, None), "a"), ((None, prices), "c"), ((None, None), "")):
        split = quality.split_fixable(errors, *sides)
        assert "".join(r[0] for r in rows(split.fixable, "invoice_no")) == wanted
        assert split.waiting.count() + split.fixable.count() == 7
        assert split.fixable.columns == errors.columns


def test_stored_counts_give_the_baseline_of_all_rows(spark):
    data = [("a", v) for v in (1, 5, 5, 9)] + [("b", 3), ("n", None), ("n", None)]
    df = spark.createDataFrame(data, "stock_code string, quantity int")
    days = [df.where("stock_code = 'a' AND quantity < 6"), df.where("NOT (stock_code = 'a' AND quantity < 6) OR quantity IS NULL")]
    state = anomaly.merge_counts(*[anomaly.value_counts(d) for d in days])
    assert rows(anomaly.counts_baseline(state)) == rows(anomaly.group_baseline(df))
    case = anomaly.value_counts(spark.createDataFrame([("a", 9), ("b", 3)], df.schema))
    less = anomaly.merge_counts(state, case, sign=-1)
    expected = df.where("NOT (quantity IN (9, 3)) OR quantity IS NULL")
    assert rows(anomaly.counts_baseline(less)) == rows(anomaly.group_baseline(expected))
    assert rows(anomaly.merge_counts(less, case)) == rows(state)


def test_sketched_medians_are_within_their_rank_error(spark):
    df = spark.range(60_000).selectExpr(
        "'k' AS stock_code", "cast(pmod(hash(id), 100000) AS int) AS quantity",
        "cast(add_months(DATE '2024-01-15', cast(id % 3 AS int)) AS timestamp_ntz) AS invoice_date",
    )
    found = anomaly.sliding_medians(anomaly.period_sketches(df), 2)
    for r in found.collect():
        months = [m for m in (r.period.month - 1, r.period.month) if 1 <= m <= 3]
        inside = df.where(F.month("invoice_date").isin(months))
        below = inside.where(F.col("quantity") <= r.median_qty).count()
        assert r.n_lines == inside.count() and abs(below / r.n_lines - 0.5) < 0.0165


def test_sketched_orders_are_within_their_error(spark):
    fact = spark.range(40_000).selectExpr(
        "cast(id % 2 AS string) AS customer_id", "cast(id AS string) AS invoice_no",
        "cast(add_months(DATE '2024-01-15', cast(id % 5 AS int)) AS timestamp_ntz) AS invoice_date",
    )
    merged = reports.order_sketches(fact.unionByName(fact)).groupBy("customer_id").agg(
        F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("n")
    )
    assert all(abs(r.n / 20_000 - 1) < 0.05 for r in merged.collect())
    few = reports.order_frequency_of(reports.order_sketches(fact.limit(30)))
    assert rows(few) == rows(reports.order_frequency(fact.limit(30)))


def test_expiry_stopped_at_any_step_loses_no_valid_day(spark, tmp_path):
    df = spark.range(3)
    for day in ("2024-01-01", "2024-01-05", "2024-01-20"):
        files.snapshot(df, str(tmp_path), day)
    os.makedirs(tmp_path / "snapshot_date=unknown")
    # a stop between renaming and deleting leaves a hidden folder
    os.rename(tmp_path / "snapshot_date=2024-01-01", tmp_path / "_expired-snapshot_date=2024-01-01")
    assert files.expire_snapshots(spark, str(tmp_path), "2024-01-21") == ["2024-01-05"]
    assert [d for d in os.listdir(tmp_path) if "=2" in d] == ["snapshot_date=2024-01-20"]
    assert files.expire_snapshots(spark, str(tmp_path), dt.date(2024, 1, 27)) == []
    assert files.expire_snapshots(spark, f"{tmp_path}/none", "2024-01-21") == []
