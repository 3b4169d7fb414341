import sqlite3
from datetime import date, datetime
from decimal import Decimal

import pytest

from platewise.sources.database import DatabaseTable, read_database

SCHEMA = "order_id bigint, city string, total decimal(18,2), day date, at timestamp_ntz, km double, done boolean"


@pytest.fixture(scope="module")
def database(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("db") / "orders.db")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE orders (order_id INTEGER, city TEXT, total TEXT, day TEXT, at TEXT, km REAL, done INTEGER, "odd ""name" INTEGER)')
        rows = [(10 ** (i % 7) + i, "medan" if i % 3 else "o'brien", f"{i}.5", "2024-01-02", "2024-01-02 03:04:05", i / 4, i % 2, i) for i in range(2000)]
        rows += [(5, "hot", "1", None, None, None, None, -1)] * 3000 + [(None, "no key", None, None, None, None, None, -2)] * 10
        db.executemany("INSERT INTO orders VALUES (?, ?, ?, ?, ?, ?, ?, ?)", rows)
    db.close()
    return path, rows


def scan(spark, path, **options):
    return read_database(spark, "sqlite3", {"database": path}, "orders", SCHEMA, "order_id", **{"partitions": 8} | options)


def test_all_rows_in_ranges_of_the_key(spark, database):
    path, rows = database
    frame = scan(spark, path)
    got = frame.collect()
    assert len(got) == len(rows) and sum(r["order_id"] is None for r in got) == 10
    first = next(r for r in got if r["km"] == 1.0)
    assert tuple(first)[1:] == ("medan", Decimal("4.50"), date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), 1.0, False)
    assert sorted(r["order_id"] for r in got if r["order_id"] is not None) == sorted(r[0] for r in rows if r[0] is not None)
    sizes = frame.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert 3 <= len(sizes) <= 8 and max(sizes) <= 3000 + 800  # the value that most rows have is one range


def test_filters_reach_the_database(spark, database, plan):
    path, rows = database
    frame = scan(spark, path)
    picked = frame.where("city = \"o'brien\" AND order_id >= 1000 AND km < 400 AND day IS NOT NULL AND order_id IN (1003, 1010, 10017)")
    want = [r for r in rows if r[1] == "o'brien" and r[0] in (1003, 1010, 10017) and r[5] < 400]
    assert sorted(r["order_id"] for r in picked.collect()) == sorted(r[0] for r in want)
    reader = DatabaseTable({"module": "sqlite3", "connection": "{}", "table": "t", "key": "k", "partitions": "2"}).reader(frame.schema)
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringContains

    left = list(reader.pushFilters([EqualTo(("city",), "x"), StringContains(("city",), "y"), GreaterThan(("day",), date(2024, 1, 1))]))
    assert [type(f).__name__ for f in left] == ["StringContains", "GreaterThan"] and reader.conditions == [('"city" = ?', ["x"])]
    assert frame.where("city LIKE '%brien' AND day > DATE '2024-01-01'").count() == sum(1 for r in rows if r[1] == "o'brien")


def test_empty_table_odd_name_and_text_key(spark, tmp_path, database):
    path = str(tmp_path / "empty.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE orders (order_id INTEGER, city TEXT, total TEXT, day TEXT, at TEXT, km REAL, done INTEGER)")
    db.close()
    assert scan(spark, path).count() == 0
    by_text = read_database(spark, "sqlite3", {"database": database[0]}, "orders", 'city string, `odd "name` int', "city", 4)
    assert by_text.count() == len(database[1]) and by_text.where("`odd \"name` = -1").count() == 3000
