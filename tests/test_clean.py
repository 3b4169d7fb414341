from datetime import date, datetime
from decimal import Decimal as D

import pytest

from pyspark.sql import functions as F

from platewise.plans import clean

USERS = (
    "user_id int, full_name string, city string, gender string, date_of_birth date, address_area string, lat double, "
    "lon double, is_active int"
)
ORDERS = (
    "order_id int, user_id int, driver_id int, merchant_id int, city string, status string, payment_method string, "
    "subtotal decimal(18,2), delivery_fee decimal(18,2), discount decimal(18,2), total_amount decimal(18,2), "
    "distance_km double, order_time string, delivery_area string"
)
ITEMS = (
    "order_item_id int, order_id int, product_id int, merchant_id int, product_name string, category string, "
    "quantity int, unit_price decimal(18,2), subtotal decimal(18,2)"
)
T = "2024-01-06 10:30:00"


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def order(i, **kw):
    base = dict(order_id=i, user_id=1, driver_id=1, merchant_id=1, city="a", status="delivered", payment_method="x",
                subtotal=D(10), delivery_fee=D(2), discount=D(0), total_amount=D(12), distance_km=1.0, order_time=T,
                delivery_area="n")
    return tuple((base | kw).values())


def test_users(spark):
    born = date(1990, 1, 1)
    df = spark.createDataFrame(
        [(1, "A", "a", "M", born, "n", 1.0, 10.0, 1), (1, "B", "a", "F", born, "n", 9.0, 9.0, 0),
         (2, "C", "a", None, None, None, None, None, None), (3, None, "a", "M", born, "n", 1.0, 1.0, 1),
         (4, "D", None, None, None, None, None, None, 0), (5, "E", "b", None, born, None, None, 3.0, 1)],
        USERS,
    )
    out = by_id(clean.clean_users(df), "user_id")
    assert set(out) == {1, 2, 5}  # 3 has no name; 4 has no birth date and no city to take one from
    assert out[1]["full_name"] == "A"
    assert out[2][2:] == ("a", "M", born, "n", 1.0, 10.0, 1)
    assert out[5]["gender"] == "Unknown" and out[5]["address_area"] == "Unknown" and out[5]["lat"] == 1.0


def test_orders_drop_and_fill(spark):
    df = spark.createDataFrame(
        [order(1), order(1, subtotal=D(99)), order(2, user_id=None), order(3, order_time="not a date"),
         order(4, payment_method=None, subtotal=None, delivery_fee=None, discount=None, total_amount=None,
               distance_km=None, delivery_area=None),
         order(5, merchant_id=2, subtotal=None, total_amount=None, discount=D(500)),
         order(6, order_time=None), order(7, order_time="2024-01-06"), order(8, city=None, payment_method=None)],
        ORDERS,
    )
    out = by_id(clean.clean_orders(df), "order_id")
    assert set(out) == {1, 4, 5, 7, 8}  # a date alone is a time at midnight
    four = out[4]
    assert four["payment_method"] == "x" and four["subtotal"] == D(10) and four["delivery_fee"] == D(2)
    assert four["discount"] == 0 and four["total_amount"] == D(12)
    assert four["delivery_area"] == "n" and four["distance_km"] == 1.0
    assert four["order_time"] == datetime(2024, 1, 6, 10, 30)
    # a merchant without any subtotal takes the overall mean; a recomputed total is not clipped at zero
    assert out[5]["subtotal"] == D(10) and out[5]["total_amount"] == D(-488)
    assert out[8]["payment_method"] == "cash"


def test_orders_without_any_subtotal_take_the_mean_total(spark):
    df = spark.createDataFrame([order(1, subtotal=None), order(2, subtotal=None, total_amount=None)], ORDERS)
    out = by_id(clean.clean_orders(df), "order_id")
    assert out[2]["subtotal"] is None and out[2]["total_amount"] == D(12)


@pytest.mark.parametrize("quantity,expected", [(None, 1), (0, 1), (-2, 1), (3, 3)])
def test_item_quantity(spark, quantity, expected):
    df = spark.createDataFrame([(1, 1, 1, 1, "p", "c", quantity, D(5), D(70))], ITEMS)
    row = clean.clean_order_items(df).first()
    assert row["quantity"] == expected and row["subtotal"] == D(70)


def test_item_price_and_subtotal(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, "p", "c", 2, D(5), None), (2, 1, 1, 1, "p", "c", 3, None, None), (3, 1, 2, 1, "p", "c", 1, None, None),
         (4, None, 1, 1, "p", "c", 1, D(5), D(5)), (5, 1, None, 1, "p", "c", 1, D(5), D(5))],
        ITEMS,
    )
    out = by_id(clean.clean_order_items(df), "order_item_id")
    assert {k: (r["unit_price"], r["subtotal"]) for k, r in out.items()} == {
        1: (D(5), D(10)), 2: (D(5), D(15)), 3: (D(5), D(5))}


def test_drivers_merchants_products(spark):
    drivers = spark.createDataFrame(
        [(1, "A", None, "a", "z", 4.0, None, None), (2, "B", "Mobil", "a", "z", None, 3, 0), (3, None, "x", "a", "z", 5.0, 1, 1)],
        "driver_id int, full_name string, vehicle_type string, city string, current_area string, rating double, "
        "total_trips int, is_active int",
    )
    out = by_id(clean.clean_drivers(drivers), "driver_id")
    assert out[1][2:] == ("Mobil", "a", "z", 4.0, 0, 1) and out[2]["rating"] == 4.0 and set(out) == {1, 2}

    merchants = spark.createDataFrame(
        [(1, "A", "c", "n", "a", 1.0, 2.0, 4.0, 1), (2, "B", "c", None, "a", None, None, None, None)],
        "merchant_id int, merchant_name string, category string, area string, city string, lat double, lon double, "
        "rating double, is_active int",
    )
    assert by_id(clean.clean_merchants(merchants), "merchant_id")[2][2:] == ("c", "n", "a", 1.0, 2.0, 4.0, 1)

    products = spark.createDataFrame(
        [(1, 1, None, None, None, None), (2, 1, "p", "x", D("3.00"), 0), (3, None, "p", "x", D(9), 1)],
        "product_id int, merchant_id int, product_name string, category string, price decimal(18,2), is_available int",
    )
    out = by_id(clean.clean_products(products), "product_id")
    # the price is filled before the category, so a product without category takes the overall mean
    assert out[1][2:] == ("Unknown Product", "x", D("3.00"), 1) and set(out) == {1, 2}


def test_transactions(spark):
    df = spark.createDataFrame(
        [("t1", None, 4.0), ("t1", 5.0, 4.0), ("t2", 3.0, None)], "transaction_id string, rating_merchant double, rating_driver double"
    )
    out = by_id(clean.clean_transactions(df, "2024-01-01 00:00:00"), "transaction_id")
    assert out["t1"][1:3] == (0.0, 4.0) and out["t2"]["rating_driver"] == 0.0
    assert out["t1"]["dwh_load_time"] == datetime(2024, 1, 1)


@pytest.mark.parametrize("job,schema", [(clean.clean_users, USERS), (clean.clean_orders, ORDERS), (clean.clean_order_items, ITEMS)])
def test_empty_tables(spark, job, schema):
    df = spark.createDataFrame([], schema)
    out = job(df)
    assert out.collect() == [] and out.columns == df.columns


def test_rerun_gives_the_same_rows(spark, rows):
    df = spark.createDataFrame([order(i % 7, subtotal=D(i), order_time=T) for i in range(40)], ORDERS)
    assert rows(clean.clean_orders(df.repartition(4))) == rows(clean.clean_orders(df.repartition(2)))


def test_users_without_a_birth_date_go_before_the_coordinates_are_learnt(spark):
    base = {"user_id": 1, "full_name": "n", "city": "A", "gender": "f", "address_area": "x", "is_active": 1}
    people = [
        base | {"date_of_birth": "2000-01-01", "lat": 10.0, "lon": 1.0},
        base | {"user_id": 2, "city": None, "date_of_birth": None, "lat": 100.0, "lon": 1.0},
        base | {"user_id": 3, "city": None, "date_of_birth": "2000-01-01", "lat": None, "lon": 1.0},
    ]
    schema = "user_id int, full_name string, city string, gender string, address_area string, is_active int, date_of_birth string, lat double, lon double"
    df = spark.createDataFrame([tuple(p[n.split()[0]] for n in schema.split(", ")) for p in people], schema)
    df = df.withColumn("date_of_birth", F.to_date("date_of_birth"))
    out = {r["user_id"]: r["lat"] for r in clean.clean_users(df).collect()}
    assert out == {1: 10.0, 3: 10.0}


def test_order_times_in_all_forms(spark):
    df = spark.createDataFrame(
        [(1, "2023-01-01 10:00:00"), (2, "2023-01-01T10:00:00.5"), (3, "2023-01-01"), (4, "01/02/2023"), (5, None), (6, "2023-13-01 10:00:00")],
        "order_id int, order_time string")
    assert sorted(r["order_id"] for r in clean.coerce_order_time(df).collect()) == [1, 2, 3]
    stamps = spark.sql("SELECT 1 AS order_id, TIMESTAMP '2023-01-01 10:00:00.123' AS order_time")
    assert str(clean.coerce_order_time(stamps).first()["order_time"]) == "2023-01-01 10:00:00.123000"
    plain = spark.sql("SELECT 1 AS order_id, TIMESTAMP_NTZ '2023-01-01 10:00:00.123' AS order_time")
    assert clean.coerce_order_time(plain).count() == 1


def test_orders_are_read_once_for_each_group_key(spark, plan):
    from platewise.operators.impute import group_statistics
    from verification.queries import Data

    orders = Data(spark, "/root/testdata/sf0.001").sources.orders
    assert plan(clean.clean_orders(orders)).count("/orders-") == 1  # the written base; all else are statistics
    both = group_statistics(orders, "city", {"delivery_fee": 2}, {"payment_method": "cash", "delivery_area": None})
    assert plan(both).count("orders.parquet") == 1
