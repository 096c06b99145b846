"""Run a query and its SQL side by side, and say how the results differ.

    python tests/compare.py [--sf 0.01] [--set spark.sql.ansi.enabled=false] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df, connection, sql: str) -> list[str]:
    """Empty when names, row count and every value agree exactly."""
    names, got = _rows(df.columns, df.collect())
    result = connection.execute(sql)
    described = result.description
    want_names, want = _rows([c[0] for c in described], result.fetchall())
    if names != want_names:
        return [f"columns {names} but expected {want_names}"]
    out = []
    if len(got) != len(want):
        out.append(f"{len(got)} rows but expected {len(want)}")
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} but expected {wrong[0][1]}")
    spark_types = dict(df.dtypes)
    loose = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    for column in described:
        kind = spark_types[column[0]]
        if kind in loose and str(column[1]) not in (loose[kind], '"NULL"'):
            out.append(f"type of {column[0]}: {kind} but expected {column[1]}")
    return out


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="session setting")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for setting in args.set:
        spark.conf.set(*setting.split("=", 1))
    connection = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problems = differences(df, connection, sql[name]) if name in sql else [f"(no SQL) {df.count()} rows"]
        except Exception as problem:  # the report goes on with the next query
            problems = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        ok = not problems or problems[0].startswith("(no SQL)")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {'; '.join(problems)}", flush=True)
    print(f"{bad} of {len(args.names or queries)} wrong")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
