"""Compare registered queries with their SQL: python -m checks.compare FOLDER [QUERY ...]"""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks import oracle
from checks.queries import QUERIES
from parvis.session import with_defaults

TABLES = ["part", "lineitem"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime.date):
        return value.isoformat()
    return round(value, 9) + 0.0 if isinstance(value, float) else value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, folder: str) -> str:
    """Empty when both engines agree on columns and rows."""
    got = QUERIES[name](spark, folder)
    want = con.execute(oracle.statement(name))
    columns = [d[0] for d in want.description]
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(set(columns) ^ set(got.columns))}"
    ours, theirs = _rows(got.columns, got.collect()), _rows(columns, want.fetchall())
    if ours == theirs:
        return ""
    left, right = list((ours - theirs).elements()), list((theirs - ours).elements())
    return f"{len(left)} rows only here, {len(right)} only there, e.g. {left[:1]} {right[:1]}"


def main(folder: str, names: list[str]) -> int:
    builder = with_defaults(SparkSession.builder.master("local[8]").appName("compare"))
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names or [n for n in QUERIES if n in oracle.FINAL]:
        start = time.time()
        try:
            problem = difference(spark, con, name, folder)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
