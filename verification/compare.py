"""Run registered queries against their reference SQL and compare all values.

Usage: python -m verification.compare <folder of Parquet tables> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from platewise.workspace import discard
from verification.oracles import oracle_sql
from verification.queries import queries

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, folder: str, name: str) -> str:
    """Empty text if the query equals its reference, else what differs."""
    df = queries()[name](spark, folder)
    cursor = con.execute(oracle_sql()[name])
    expected_names = [d[0] for d in cursor.description]
    expected = rows_of(expected_names, cursor.fetchall())
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} <> {sorted(expected_names)}"
    actual = rows_of(df.columns, df.collect())
    if actual == expected:
        return ""
    only_spark, only_sql = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} / {sum(expected.values())} rows, {sum(only_spark.values())} differ\n"
        f"   columns {sorted(df.columns)}\n   spark {sorted(map(str, only_spark))[:3]}\n   sql   {sorted(map(str, only_sql))[:3]}"
    )


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(folder)
    spark.sparkContext.setLogLevel("OFF")
    failed = 0
    for name in wanted or queries():
        started = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = str(error)[:1200].split("JVM stacktrace")[0]
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    discard(spark)
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
