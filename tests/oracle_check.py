"""Run registered queries against their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns, records) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(record[i]) for i in order) for record in records)


def compare(name: str, df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.execute(sql)
    columns = [item[0] for item in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} vs {sorted(columns)}"
    expected = _rows(columns, result.fetchall())
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    if len(actual) != len(expected):
        return f"{name}: {len(actual)} rows vs {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"{name}: {got} vs {want}"
    return None if actual else f"{name}: no rows"


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from tallyhouse.plans.session import build_session

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    con, sql = connect(sf_dir), oracle_sql()
    names = sys.argv[1:] or list(queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            problem = compare(name, df, con, sql[name]) if name in sql else f"{name}: no SQL"
        except Exception as exc:  # report and go on with the next query
            problem = f"{name}: {type(exc).__name__} {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {problem or name + ': equal'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
