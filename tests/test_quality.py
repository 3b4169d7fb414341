from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from platewise.operators.audit import cleaning_audit, with_load_time
from platewise.plans import quality
from platewise.plans.warehouse import Sources


@pytest.fixture
def clean(spark):
    """Small data set that passes every check."""
    users = spark.createDataFrame([(1, "U", "e", "08", "a", 1.0, 2.0)],
                                  "user_id int, full_name string, email string, phone string, city string, lat double, lon double")
    drivers = spark.createDataFrame([(1, "D", "08", "Motor", 4.0)],
                                    "driver_id int, full_name string, phone string, vehicle_type string, rating double")
    merchants = spark.createDataFrame([(1, "M", "a", 1.0, 2.0, 3.5)],
                                      "merchant_id int, merchant_name string, city string, lat double, lon double, rating double")
    products = spark.createDataFrame([(1, 1, "P", D(10))], "product_id int, merchant_id int, product_name string, price decimal(18,2)")
    orders = spark.createDataFrame(
        [(1, 1, 1, 1, "a", "delivered", D(10), D(2000), D(0), D(2010), 2.0, "2024-12-31 00:00:00", datetime(2024, 12, 31, 0, 30),
          1.0, 1.0, 1.5, 1.0),
         (2, 1, 1, 1, "a", "cancelled_by_driver", D(10), D(2000), D(9000), D(0), None, "2023-01-01 00:00:00", None,
          1.0, 1.0, 1.5, 1.0)],
        "order_id int, user_id int, driver_id int, merchant_id int, city string, status string, subtotal decimal(18,2), "
        "delivery_fee decimal(18,2), discount decimal(18,2), total_amount decimal(18,2), distance_km double, order_time string, "
        "delivered_time timestamp_ntz, delivery_lat double, delivery_lon double, pickup_lat double, pickup_lon double")
    items = spark.createDataFrame([(1, 1, 1, 1, D(10), D(10)), (2, 2, 1, 1, D(10), D(10))],
                                  "order_item_id int, order_id int, product_id int, quantity int, unit_price decimal(18,2), "
                                  "subtotal decimal(18,2)")
    reviews = spark.createDataFrame([(1, 1, 1, 5)], "review_id int, order_id int, merchant_id int, merchant_rating int")
    return Sources(users, drivers, merchants, products, orders, items, reviews, users)


def lines(df):
    return {r["check_name"]: r for r in df.collect()}


def swap(sources, **tables):
    from dataclasses import replace

    return replace(sources, **tables)


def test_clean_data_passes_all_66(clean):
    report = quality.dq_report(clean)
    got = report.collect()
    assert len(got) == 66 and len({r["check_name"] for r in got}) == 66
    assert [r for r in got if r["status"] != "PASS"] == []
    assert [tuple(r) for r in quality.dq_summary(report).collect()] == [("PASS", 66)]


BROKEN = {
    "distance not negative": {"distance_km": -1.0},
    "distance within radius": {"distance_km": 15.1},
    "no cross-city distance": {"distance_km": 100.5},
    "delivery point differs from pickup": {"pickup_lat": 1.0},
    "order city equals merchant city": {"city": "b"},
    "order city equals user city": {"city": "b"},
    "delivery fee in range": {"delivery_fee": D(1999)},
    "total not negative": {"total_amount": D(-1)},
    "subtotal positive": {"subtotal": D(0)},
    "subtotal equals sum of lines": {"subtotal": D(11)},
    "total equals subtotal + fee - discount": {"total_amount": D(1)},
    "order time in period": {"order_time": "2024-12-31 10:00:00"},
    "delivered orders have a delivery time": {"delivered_time": None},
    "delivery takes 10 to 120 minutes": {"delivered_time": datetime(2024, 12, 31, 0, 9)},
    "delivered after ordered": {"delivered_time": datetime(2024, 12, 30)},
    "order status known": {"status": "lost"},
    "reviews only of delivered orders": {"status": "cancelled_by_customer"},
    "cancelled orders have no delivery time": {"status": "cancelled_by_customer"},
    "orders.user_id -> users": {"user_id": 9},
    "orders.driver_id -> drivers": {"driver_id": None},
    "orders.merchant_id -> merchants": {"merchant_id": 9},
    "reviews.order_id -> orders": {"order_id": 9},
    "orders.total_amount not null": {"total_amount": None},
}


def section_of(name):
    if "->" in name:
        return quality.fk_orphans
    if name.endswith("not null"):
        return quality.dq_nulls
    if "city equals" in name:
        return quality.city_consistency
    if "distance" in name or "delivery point" in name:
        return quality.dq_distance
    if "total" in name or "fee" in name:
        return quality.dq_money
    return quality.dq_ratings if "status" in name or "reviews" in name else quality.dq_time


@pytest.mark.parametrize("name", BROKEN)
def test_one_broken_order_is_counted_once(clean, name):
    changed = clean.orders
    first = F.col("order_id") == 1
    for column, value in reversed(list(BROKEN[name].items())):
        kind = changed.schema[column].dataType
        changed = changed.withColumn(column, F.when(first, F.lit(value).cast(kind)).otherwise(F.col(column)))
    row = lines(section_of(name)(swap(clean, orders=changed)))[name]
    assert (row["status"], row["failing"]) == ("FAIL", 1)


def test_broken_ratings_and_prices(clean):
    s = swap(
        clean,
        merchants=clean.merchants.withColumn("rating", F.lit(3.4)),
        drivers=clean.drivers.withColumn("rating", F.lit(None).cast("double")),
        reviews=clean.reviews.withColumn("merchant_rating", F.lit(6)),
        products=clean.products.withColumn("price", F.lit(0).cast("decimal(18,2)")),
        users=clean.users.limit(0),
    )
    got = lines(quality.dq_report(s))
    for name in ("merchants rating in range", "reviews merchant_rating in range", "product price positive"):
        assert (got[name]["failing"], got[name]["violations"]) == (1, 1)
    # a missing value fails the range but is no real violation
    assert (got["drivers rating in range"]["failing"], got["drivers rating in range"]["violations"]) == (1, 0)
    assert got["users not empty"]["status"] == "FAIL" and got["orders.user_id -> users"]["failing"] == 2


def test_order_without_lines_is_a_mismatch(clean):
    got = quality.subtotal_reconcile(swap(clean, order_items=clean.order_items.where("order_id = 1"))).first()
    assert got["failing"] == 1


def test_repeated_parents_count_twice(clean):
    users = clean.users.withColumn("city", F.lit("b"))
    got = lines(quality.city_consistency(swap(clean, users=users.unionByName(users))))
    assert got["order city equals user city"]["failing"] == 4


def test_missing_columns_skip_their_checks(clean):
    got = lines(quality.dq_distance(swap(clean, orders=clean.orders.drop("distance_km", "pickup_lat"))))
    assert list(got) == ["distance_km present"] and got["distance_km present"]["status"] == "FAIL"
    assert len(quality.null_checks(clean.users.drop("email"), "users")) == 5


def test_soft_checks_warn(spark):
    one = F.count(F.lit(1))
    check = quality.Check("s", "n", one, level="soft")
    assert quality.report_lines(spark.range(1), [check]).first()["status"] == "WARN"


def test_one_scan_per_table(clean, plan):
    text = plan(quality.report_lines(clean.orders, [*quality.distance_checks(clean.orders), *quality.order_money_checks()]))
    assert text.count("Scan ") == 1


def test_column_profile(clean):
    row = quality.column_profile(clean.orders, ["distance_km"]).first()
    assert tuple(row) == ("distance_km", 1, 1, 2.0, 2.0, 2.0)


def test_audit(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    got = [tuple(r) for r in cleaning_audit(df, "t", "k", ["k", "v"]).collect()]
    # the first row of key 1 has a null value, so the whole key is dropped
    assert got == [("t", "dedup", 5, 3, 2, 40.0), ("t", "drop_null_keys", 3, 1, 2, 66.7)]
    empty = cleaning_audit(df.limit(0), "t", "k", ["k"], F.lit(True)).collect()
    assert [tuple(r)[2:] for r in empty] == [(0, 0, 0, 0.0)] * 3


def test_load_time(spark):
    assert with_load_time(spark.range(1), "2024-05-06 07:08:09").first()["dwh_load_time"] == datetime(2024, 5, 6, 7, 8, 9)
