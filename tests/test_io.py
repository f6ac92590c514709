import datetime as dt
import os
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import parse
from tallyhouse.plans import jobs
from tallyhouse.plans.session import shared_dir
from tallyhouse.sinks import files, jdbc, tables
from tallyhouse.sources.lines import drop_path, read_drop, read_lines
from tallyhouse.sources.tables import is_bootstrap, register_views, table_or_default
from tallyhouse.streaming.ingest import ingest_new, new_rows

AS_OF = dt.datetime(2024, 6, 1)
LINE = "{},10001,5,2024-01-05 10:30:00,51234,1101-3"


@pytest.fixture
def db(spark):
    spark.sql("DROP DATABASE IF EXISTS shop CASCADE")
    spark.sql("CREATE DATABASE shop")
    yield "shop"
    spark.sql("DROP DATABASE shop CASCADE")


def write(path, *texts):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(texts) + "\n")


def test_lines_and_drops(spark, tmp_path):
    write(f"{tmp_path}/logs/logs_2024-01-05/part-0", "a", "b")
    write(f"{tmp_path}/logs/logs_2024-01-06/part-0", "c")
    assert drop_path(str(tmp_path), "logs", "2024-01-05").endswith("logs/logs_2024-01-05")
    assert rows(read_drop(spark, str(tmp_path), "logs", dt.date(2024, 1, 5))) == [("a",), ("b",)]
    every = read_lines(spark, f"{tmp_path}/logs/*", with_source=True)
    assert every.count() == 3 and every.select("source_file").distinct().count() == 2


def test_table_guards(spark, db):
    default = spark.createDataFrame([("10001",)], "stock_code string")
    assert is_bootstrap(spark, "shop.products")
    tables.create_table(spark, "shop.products", schemas.PRODUCTS)
    assert is_bootstrap(spark, "shop.products")
    assert rows(table_or_default(spark, "shop.products", default)) == [("10001",)]
    one = [("k", "s", "d", 1.0, dt.date(2024, 1, 1))]
    tables.append(spark.createDataFrame(one, schemas.PRODUCTS), "shop.products")
    assert not is_bootstrap(spark, "shop.products")
    register_views({"current_products": spark.table("shop.products")})
    assert spark.sql("SELECT count(*) FROM current_products").first()[0] == 1


def test_append_overwrite_and_replace_align_columns_by_name(spark, db):
    tables.create_table(spark, "shop.t", schemas.COUNTRIES)
    swapped = spark.createDataFrame(
        [("Europe", "Germany", "1101")], "continent string, country_name string, country_id string"
    )
    tables.append(swapped, "shop.t")
    tables.append(swapped, "shop.t")
    assert rows(spark.table("shop.t")) == [("1101", "Germany", "Europe")] * 2
    tables.overwrite(swapped, "shop.t")
    assert rows(spark.table("shop.t")) == [("1101", "Germany", "Europe")]
    for _ in range(2):
        doubled = spark.table("shop.t").withColumn("country_name", F.concat("country_name", F.lit("!")))
        tables.replace_table(doubled, "shop.t")
    assert rows(spark.table("shop.t")) == [("1101", "Germany!!", "Europe")]
    assert spark.sql("SHOW TABLES IN shop").filter("NOT isTemporary").count() == 1


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "repoint", "refresh", "delete"])
def test_replace_stopped_at_any_step_loses_nothing(spark, db, monkeypatch, step):
    tables.create_table(spark, "shop.t", schemas.COUNTRIES)
    first = [("1101", "Germany", "Europe"), ("1102", "France", "Europe")]
    tables.append(spark.createDataFrame(first, schemas.COUNTRIES), "shop.t")
    louder = lambda: spark.table("shop.t").withColumn("country_name", F.upper("country_name"))

    def stop(*args, **kwargs):
        raise Stop

    with monkeypatch.context() as patch:
        if step == "write":
            patch.setattr(DataFrameWriter, "parquet", stop)
        elif step == "repoint":
            plain = SparkSession.sql
            patch.setattr(
                SparkSession, "sql",
                lambda self, text, *a, **k: stop() if "SET LOCATION" in text else plain(self, text, *a, **k),
            )
        elif step == "refresh":
            patch.setattr(type(spark.catalog), "refreshTable", stop)
        else:
            patch.setattr(tables, "_delete", stop)
        with pytest.raises(Stop):
            tables.replace_table(louder(), "shop.t")
    done = step in ("refresh", "delete")
    spark.catalog.refreshTable("shop.t")
    names = ["FRANCE", "GERMANY"] if done else ["France", "Germany"]
    assert [r[0] for r in rows(spark.table("shop.t"), "country_name")] == names
    assert not is_bootstrap(spark, "shop.t")
    for _ in range(2):
        tables.replace_table(louder(), "shop.t")
    assert [r[0] for r in rows(spark.table("shop.t"), "country_name")] == ["FRANCE", "GERMANY"]


def test_upsert_into_a_table_twice(spark, db):
    tables.create_table(spark, "shop.t", schemas.COUNTRIES)
    rows_of = lambda *r: spark.createDataFrame(list(r), schemas.COUNTRIES)
    tables.append(rows_of(("1", "a", "x"), ("2", "b", "x")), "shop.t")
    for _ in range(2):
        tables.upsert_table(rows_of(("2", "B", "x"), ("3", "c", "x")), "shop.t", ["country_id"])
    assert rows(spark.table("shop.t"), "country_id", "country_name") == [
        ("1", "a"), ("2", "B"), ("3", "c"),
    ]


def counted(spark, df, column):
    """``df`` with an accumulator of the rows that are computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    again = F.udf(count, "string").asNondeterministic()
    return df.withColumn(column, again(column)), seen


def test_write_if_any_computes_once(spark, tmp_path):
    seen = []
    df, computed = counted(spark, spark.range(3).selectExpr("cast(id AS string) AS id"), "id")
    assert tables.write_if_any(df, lambda d: seen.append(d.count()), f"{tmp_path}/a")
    assert not tables.write_if_any(
        spark.range(3).filter("id > 9"), lambda d: seen.append(d.count()), f"{tmp_path}/b"
    )
    assert (seen, computed.value) == ([3], 3)


def test_text_files(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "value string").repartition(4)
    files.write_lines(df, f"{tmp_path}/out", n_files=1)
    files.write_lines(df, f"{tmp_path}/out", n_files=1)
    assert rows(read_lines(spark, f"{tmp_path}/out")) == [("a",), ("b",)]
    assert len([f for f in os.listdir(f"{tmp_path}/out") if f.startswith("part")]) == 1


def test_partitioned_by_month(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 5)), (2, dt.datetime(2024, 2, 5))], "id int, ts timestamp_ntz"
    )
    files.write_partitioned(df, "ts", f"{tmp_path}/fact")
    back = spark.read.parquet(f"{tmp_path}/fact").filter("year = 2024 AND month = 2")
    assert rows(back, "id") == [(2,)]
    assert "PartitionFilters: [isnotnull(year" in back._jdf.queryExecution().toString()


def test_snapshots_replace_their_day_and_expire(spark, tmp_path):
    path = f"{tmp_path}/snap"
    for day, n in (("2024-01-01", 5), ("2024-01-08", 3), ("2024-01-08", 4), ("2024-01-09", 2)):
        files.snapshot(spark.range(n), path, day)
    snaps = spark.read.parquet(path)
    counts = dict(rows(snaps.groupBy(F.col("snapshot_date").cast("string")).count()))
    assert counts == {"2024-01-01": 5, "2024-01-08": 4, "2024-01-09": 2}
    assert files.retain_recent(snaps, "snapshot_date", "2024-01-09").count() == 6
    assert files.retain_recent(snaps, "snapshot_date", "2024-01-08").count() == 11
    some = os.listdir(f"{path}/snapshot_date=2024-01-01")
    assert any(name.endswith(".gz.parquet") for name in some)


def test_outcomes_are_split_in_one_write(spark, tmp_path):
    tagged = spark.createDataFrame([(1, None), (2, "bad")], "id int, message string")
    files.write_by_outcome(tagged, "message", f"{tmp_path}/o")
    assert rows(files.read_outcome(spark, f"{tmp_path}/o", "valid"), "id") == [(1,)]
    assert rows(files.read_outcome(spark, f"{tmp_path}/o", "error"), "id") == [(2,)]


def test_jdbc_options():
    options = jdbc.jdbc_options({"user": "u", "truncate": "false"}, batch_size=5)
    assert options == {
        "truncate": "false", "batchsize": "5", "numPartitions": "16", "user": "u",
    }


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    settings = {"spark.sql.warehouse.dir": "hdfs:/house/"}
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other=None: settings.get(key, other)))
    assert shared_dir(unset) == "hdfs:/house/checkpoints"


def test_stream_ingest_loads_each_file_once(spark, tmp_path):
    src, dst, progress = (f"{tmp_path}/{n}" for n in ("drop", "table", "progress"))
    tag = lambda df: parse.tag_transactions(df, AS_OF)
    write(f"{src}/a.txt", LINE.format(1), LINE.format(2), "bad line")
    for _ in range(2):
        ingest_new(spark, src, tag, dst, progress)
    assert rows(files.read_outcome(spark, dst, "valid"), "invoice_no") == [("1",), ("2",)]
    write(f"{src}/b.txt", LINE.format(3))
    ingest_new(spark, src, tag, dst, progress, max_files=1)
    loaded = files.read_outcome(spark, dst, "valid")
    assert rows(loaded, "invoice_no") == [("1",), ("2",), ("3",)]
    assert rows(files.read_outcome(spark, dst, "error"), "value", "reject_reason") == [
        ("bad line", "key")
    ]


def test_equal_lines_of_different_drops_are_kept(spark, db, tmp_path):
    path, store = f"{tmp_path}/logs/*", f"{tmp_path}/store"
    write(f"{tmp_path}/logs/logs_2024-01-05/a", LINE.format(1), LINE.format(1), "bad line")
    load = lambda: jobs.ingest_transactions(spark, path, "shop.tx", store, AS_OF)
    assert load() and load()
    assert spark.table("shop.tx").count() == 2
    write(f"{tmp_path}/logs/logs_2024-01-06/a", LINE.format(1))
    assert load() and load()
    assert rows(spark.table("shop.tx"), "invoice_no") == [("1",)] * 3
    assert spark.table("shop.tx").columns == schemas.TRANSACTIONS.names
    assert rows(spark.table("shop.tx_rejects")) == [("bad line", "key")]


def test_numbers_as_text(spark, lines):
    line = "1,10001,{},2024-01-05,c,1101-3"
    good = {"5": 5, "5.0": 5, "5.7": 5, "-5.7": -5, "\t5 ": 5, "+5": 5, "5.": 5, ".9": 0}
    found = parse.parse_transactions(lines(*[line.format(q) for q in good])).rows
    assert sorted(r.quantity for r in found.collect()) == sorted(good.values())
    bad = ["x", "", ".", "5.x", "1e3", "99999999999", "5 5"]
    assert parse.parse_transactions(lines(*[line.format(q) for q in bad])).rejects.count() == len(bad)
    prices = lines("1,d,\t1.5\t,2024-01-05", "1,d,.5,2024-01-05", "1,d,1e2,2024-01-05")
    assert rows(parse.parse_products(prices).rows, "unit_price") == [(0.5,), (1.5,), (100.0,)]
    assert parse.parse_products(lines("1,d,1.2.3,2024-01-05", "1,d,.,2024-01-05")).rejects.count() == 2


def test_new_rows_treat_nulls_as_equal(spark):
    schema = "a string, b string"
    batch = spark.createDataFrame([("x", None), ("y", None), ("y", None)], schema)
    loaded = spark.createDataFrame([("x", None)], schema)
    assert rows(new_rows(batch, loaded, ["a", "b"])) == [("y", None)] * 2


def test_the_whole_flow_twice(spark, db, tmp_path):
    def run():
        jobs.ingest_transactions(spark, f"{tmp_path}/logs", "shop.tx", f"{tmp_path}/store", AS_OF)
        jobs.ingest_products(spark, f"{tmp_path}/products", "shop.products")
        jobs.ingest_countries(spark, f"{tmp_path}/countries", "shop.countries")
        for name, schema in (
            ("fact", schemas.FACT_TRANSACTIONS),
            ("errors", schemas.TRANSACTIONS_ERROR),
            ("dim_products", schemas.DIM_PRODUCTS),
            ("dim_countries", schemas.DIM_COUNTRIES),
            ("dim_customers", schemas.DIM_CUSTOMERS),
            ("anomalies", schemas.ANOMALIES),
        ):
            tables.create_table(spark, f"shop.{name}", schema)
        into = lambda name: lambda df: tables.overwrite(df, f"shop.{name}")
        jobs.load_dimensions(
            spark.table("shop.products"), spark.table("shop.countries"), spark.table("shop.tx"),
            into("dim_products"), into("dim_countries"), into("dim_customers"),
        )
        jobs.load_fact(
            spark.table("shop.tx"), spark.table("shop.products"), spark.table("shop.countries"),
            f"{tmp_path}/stage", into("fact"), into("errors"), AS_OF,
        )
        return jobs.report_anomalies(
            spark.table("shop.tx"), f"{tmp_path}/flagged",
            lambda df: tables.replace_table(df, "shop.anomalies"), spark.table("shop.anomalies"),
            lambda df: files.write_lines(df, f"{tmp_path}/alerts", 1), AS_OF,
        )

    quantities = [1] * 9 + [50]
    write(
        f"{tmp_path}/logs/a.txt",
        *[f"{i},10001,{q},2024-01-05 10:30:00,c{i % 3},1101-3" for i, q in enumerate(quantities)],
        "90,10001,1,2024-01-05 10:30:00,c1,6601-3",
        "91,10009,1,2024-01-05 10:30:00,c1,1101-3",
        "92,10001",
    )
    write(f"{tmp_path}/products/a.txt", "10001,Laptop,10.5,2024-01-01", "10001,Laptop,10.5,2023-12-01")
    write(f"{tmp_path}/countries/a.txt", "1101,Germany", "1101,Deutschland")
    for n in range(2):
        assert run()
        if not n:  # a reviewer looks at the case
            reviewed = spark.table("shop.anomalies").withColumn("status", F.lit("REVIEWED"))
            tables.replace_table(reviewed, "shop.anomalies")
    assert rows(spark.table("shop.anomalies"), "quantity", "status") == [(50, "REVIEWED")]
    count = lambda name: spark.table(f"shop.{name}").count()
    assert (count("tx"), count("fact"), count("errors")) == (12, 10, 2)
    # the same price on two days is one version
    assert (count("products"), count("countries"), count("dim_customers")) == (1, 1, 3)
    assert rows(spark.table("shop.products"), "product_id") == [("10001-2023-12-01",)]
    assert (count("dim_products"), count("dim_countries"), count("anomalies")) == (1, 1, 1)
    assert read_lines(spark, f"{tmp_path}/alerts").count() == 1

    # A late older price, a new price, and the missing country and product arrive.
    write(f"{tmp_path}/products/b.txt", "10001,Laptop,9.0,2023-12-15", "10009,Mouse,2.0,2024-01-01")
    write(f"{tmp_path}/countries/b.txt", "6601,Peru", "1101,Germania")
    jobs.ingest_products(spark, f"{tmp_path}/products", "shop.products", late_policy="merge")
    jobs.ingest_countries(spark, f"{tmp_path}/countries", "shop.countries")
    assert rows(spark.table("shop.countries"), "country_id", "country_name") == [
        ("1101", "Germania"), ("6601", "Peru"),
    ]
    assert rows(spark.table("shop.products"), "product_id", "unit_price") == [
        ("10001-2023-12-01", 10.5), ("10001-2023-12-15", 9.0), ("10001-2024-01-01", 10.5),
        ("10009-2024-01-01", 2.0),
    ]
    def recover(replace_errors):
        errors, seen = counted(spark, spark.table("shop.errors"), "invoice_no")
        jobs.recover_errors(
            errors, spark.table("shop.products"), spark.table("shop.countries"),
            f"{tmp_path}/recovery",
            lambda df: tables.upsert_table(df, "shop.fact", ["transaction_id"]),
            replace_errors, AS_OF,
        )
        return seen.value

    def crash(df):
        raise Stop

    with pytest.raises(Stop):
        recover(crash)
    assert (count("fact"), count("errors")) == (12, 2)
    # two rows, read for the join and for the buckets that occur, not once per output
    assert recover(lambda df: tables.replace_table(df, "shop.errors")) <= 4
    assert (count("fact"), count("errors")) == (12, 0)
    assert spark.table("shop.fact").select("transaction_id").distinct().count() == 12


def test_empty_inputs_do_nothing(spark, db, tmp_path):
    os.makedirs(f"{tmp_path}/none")
    for job in (jobs.ingest_products, jobs.ingest_countries):
        assert not job(spark, f"{tmp_path}/none", "shop.x")
    assert not jobs.ingest_transactions(spark, f"{tmp_path}/none", "shop.x", f"{tmp_path}/s")
    assert not spark.catalog.tableExists("shop.x")
