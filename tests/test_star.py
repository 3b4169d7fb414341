from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from platewise.plans import dims, facts, reports, warehouse, weather
from platewise.sources import readers


@pytest.fixture
def readings(spark):
    t = datetime
    return spark.createDataFrame(
        [("jakarta", t(2024, 1, 6, 10, 5), 295.0, 280.0, 0.01), ("jakarta", t(2024, 1, 6, 10, 40), 310.0, 280.0, 0.0),
         ("jakarta", t(2024, 1, 6, 11, 0), 310.0, 280.0, 0.0), ("medan", t(2024, 1, 6, 10, 0), 295.0, 295.0, 0.0),
         ("bogor", t(2024, 1, 6, 10, 0), 295.0, 295.0, 0.0)],
        "city string, time timestamp_ntz, temp_k double, dewpoint_k double, rain double",
    )


@pytest.fixture
def dim_weather(readings):
    return weather.dim_weather(weather.hourly_weather(readings))


def test_first_class_of_each_hour(dim_weather, rows):
    assert rows(dim_weather, "weather_id", "wilayah", "date_id", "hour", "kondisi_cuaca") == [
        ("jakarta_2024010610", "DKI Jakarta", 20240106, 10, "Hujan"),
        ("jakarta_2024010611", "DKI Jakarta", 20240106, 11, "Panas"),
        ("medan_2024010610", "Medan", 20240106, 10, "Berawan"),
    ]


def test_hour_of_only_nulls_stays(spark, rows):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 1, 5), None), ("a", datetime(2024, 1, 1, 2, 5), None), ("a", datetime(2024, 1, 1, 2, 6), "x"),
         ("a", datetime(2024, 1, 1, 2, 7), "y")], "k string, ts timestamp_ntz, v string")
    assert rows(weather.hourly_first(df, ["k"], "ts", "v"), "ts", "v") == [
        (datetime(2024, 1, 1, 1), None), (datetime(2024, 1, 1, 2), "x")]


def test_weather_range_is_half_open(readings):
    got = readers.weather_observations(readings, ["jakarta"], F.lit(datetime(2024, 1, 6, 10, 5)), F.lit(datetime(2024, 1, 6, 11)))
    assert got.count() == 2


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(1, 1, 1, 1, "jakarta", "delivered", datetime(2024, 1, 6, 10, 59), D(100)),
         (2, 2, 1, 2, "medan", "cancelled_by_driver", datetime(2024, 1, 6, 10, 0), D(50)),
         (3, 1, 1, 1, "jakarta", "delivered", datetime(2024, 1, 8, 10, 0), D(30)),
         (4, 3, 1, 2, None, None, datetime(2024, 1, 8, 10, 0), D(30))],
        "order_id int, user_id int, driver_id int, merchant_id int, city string, status string, order_time timestamp_ntz, "
        "total_amount decimal(18,2)",
    ).withColumns({
        "payment_method": F.lit("x"), "subtotal": F.col("total_amount"), "delivery_fee": F.lit(0).cast("decimal(18,2)"),
        "discount": F.lit(0).cast("decimal(18,2)"), "distance_km": F.lit(1.0), "delivery_area": F.lit("n"),
    })


@pytest.mark.parametrize("spread", [{}, {"hot_rows": 1}], ids=["plain", "spread"])
def test_fact_orders(orders, dim_weather, rows, spread):
    out = facts.fact_orders(orders, dim_weather, **spread)
    got = rows(out, "order_id", "date_id", "order_hour", "is_weekend", "is_delivered", "is_cancelled", "weather_id",
               "kondisi_cuaca")
    assert got == [
        (1, 20240106, 10, 1, 1, 0, "jakarta_2024010610", "Hujan"),
        (2, 20240106, 10, 1, 0, 1, "medan_2024010610", "Berawan"),
        (3, 20240108, 10, 0, 1, 0, None, "Tidak Diketahui"),
        (4, 20240108, 10, 0, 0, 0, None, "Tidak Diketahui"),
    ]
    assert weather.unmatched_orders(orders, dim_weather).first()[0] == 2


def test_clock_offset_shifts_the_match(orders, dim_weather):
    out = facts.fact_orders(orders, dim_weather, {"medan": -1, "jakarta": 0})
    assert out.where("order_id = 2").first()["weather_id"] is None
    out = facts.fact_orders(orders, dim_weather, {"jakarta": -1})
    assert out.where("order_id = 1").first()["weather_id"] == "jakarta_2024010611"


@pytest.mark.parametrize("spread", [{}, {"hot_rows": 1}], ids=["plain", "spread"])
def test_fact_order_items_drops_orphans(spark, orders, dim_weather, rows, spread):
    items = spark.createDataFrame(
        [(10, 1, 1, 1, "p", "c", 1, D(5), D(5)), (11, 1, 1, 1, "p", "c", 1, D(5), D(5)), (12, 99, 1, 1, "p", "c", 1, D(5), D(5))],
        "order_item_id int, order_id int, product_id int, merchant_id int, product_name string, category string, quantity int, "
        "unit_price decimal(18,2), subtotal decimal(18,2)",
    )
    fo = facts.fact_orders(orders, dim_weather)
    out = facts.fact_order_items(items, fo, **spread)
    assert rows(out, "order_item_id", "user_id", "kondisi_cuaca") == [(10, 1, "Hujan"), (11, 1, "Hujan")]
    assert out.columns[:3] == ["order_item_id", "order_id", "product_id"]
    assert tuple(facts.lines_without_order(items, fo).first()) == (3, 2)


def test_dim_date_only_days_with_orders(orders, spark, rows):
    out = dims.dim_date(orders)
    assert rows(out, "date_id", "day_name", "day_of_week", "is_weekend") == [
        (20240106, "Saturday", 6, 1), (20240108, "Monday", 1, 0)]
    raw = spark.createDataFrame([("2024-01-06 10:00:00",), ("bad",), (None,)], "order_time string")
    assert rows(dims.dim_date(raw), "full_date") == [(date(2024, 1, 6),)]


def test_dim_merchant_falls_back_to_own_rating(spark, rows):
    merchants = spark.createDataFrame(
        [(1, "A", "c", "a", "n", 1.0, 1.0, 4.5, 1), (2, "B", "c", "a", "n", 1.0, 1.0, 3.5, 1)],
        "merchant_id int, merchant_name string, category string, city string, area string, lat double, lon double, rating double, "
        "is_active int")
    reviews = spark.createDataFrame([(1, 3), (1, 3), (1, 4), (None, 1)], "merchant_id int, merchant_rating int")
    assert rows(dims.dim_merchant(merchants, reviews), "merchant_id", "avg_review_rating") == [(1, 3.33), (2, 3.5)]


def test_calendar(spark):
    span = spark.createDataFrame([(date(2024, 4, 30), date(2024, 5, 2))], "start_date date, end_date date")
    got = [tuple(r) for r in dims.dim_time(span).orderBy("date_id").select("date_id", "month_name", "is_holiday").collect()]
    assert got == [(20240430, "Apr", False), (20240501, "Mei", True), (20240502, "Mei", False)]


def test_month_ranges_cover_the_end(spark, rows):
    span = spark.createDataFrame([(date(2023, 11, 20), date(2024, 1, 1))], "start_date date, end_date date")
    assert rows(readers.month_ranges(span)) == [
        (date(2023, 11, 1), date(2023, 12, 1)), (date(2023, 12, 1), date(2024, 1, 1)), (date(2024, 1, 1), date(2024, 2, 1))]


def test_no_orders_no_months(spark):
    empty = readers.order_date_range(spark.createDataFrame([], "order_time string"))
    assert tuple(empty.first()) == (None, None) and readers.month_ranges(empty).count() == 0


# ---------------------------------------------------------------- reports


@pytest.fixture
def facts_small(spark):
    data = [
        # id, merchant, user, date, hour, weekend, city, status, total, weather
        (1, 1, 1, 20240106, 10, 1, "jakarta", "delivered", D(100), "Hujan"),
        (2, 1, 1, 20240106, 10, 1, "jakarta", "delivered", D(200), "Cerah"),
        (3, 2, 2, 20240108, 12, 0, "medan", "delivered", D(300), "Hujan"),
        (4, 2, 2, 20240108, 12, 0, "medan", "cancelled_by_driver", D(999), "Hujan"),
        (5, 9, 3, 20240109, 12, 0, "surabaya", "delivered", D(50), "Tidak Diketahui"),
        (6, 3, 3, 20240109, 13, 0, "medan", "lost", D(7), "Hujan"),
    ]
    return spark.createDataFrame(
        data, "order_id int, merchant_id int, user_id int, date_id int, order_hour int, is_weekend int, city string, "
        "order_status string, total_amount decimal(18,2), kondisi_cuaca string")


@pytest.fixture
def days(spark):
    return spark.createDataFrame(
        [(20240106, "Saturday", 1), (20240108, "Monday", 0)], "date_id int, day_name string, is_weekend int")


@pytest.fixture
def merchants(spark):
    return spark.createDataFrame(
        [(1, "A", "c", "x", 1.0, 2.0), (2, "B", "c", "x", 1.0, 2.0), (3, "C", "c", "y", 1.0, 2.0)],
        "merchant_id int, merchant_name string, merchant_category string, city string, merchant_lat double, merchant_lon double")


def test_top_merchants(facts_small, merchants):
    got = [tuple(r) for r in reports.top_merchants(facts_small, merchants).select("merchant_id", "total_revenue").collect()]
    assert got == [(1, D(300)), (2, D(300))]  # merchant 9 is not in the dimension; a tie goes by key
    assert reports.top_merchants(facts_small, merchants, 1).count() == 1


def test_merchant_map(facts_small, merchants, rows):
    assert rows(reports.merchant_map(facts_small, merchants), "merchant_id", "revenue", "marker_size") == [
        (1, D(300), 220.0), (2, D(300), 220.0), (3, D(0), None)]  # a city without revenue has no scale


def test_weekday_reports(facts_small, days, rows):
    got = [tuple(r) for r in reports.weekday_basket(facts_small, days).collect()]
    assert got == [(1, "Monday", "Weekday", 300.0, 0.3), (6, "Saturday", "Weekend", 150.0, 0.15)]
    assert rows(reports.weekend_stats(facts_small, days), "day_type", "mean_amount", "n_orders", "median_amount") == [
        ("Weekday", 300.0, 1, 300.0), ("Weekend", 150.0, 2, 150.0)]


def test_boxplot(spark, days, rows):
    amounts = [10, 11, 12, 13, 14, 100]
    f = spark.createDataFrame(
        [(20240106, 1, "delivered", D(a)) for a in amounts], "date_id int, is_weekend int, order_status string, total_amount decimal(18,2)")
    assert rows(reports.weekend_boxplot(f, days)) == [("Weekend", 11.25, 12.5, 13.75, 10.0, 14.0, 1)]
    assert reports.weekend_boxplot(f.limit(0), days).collect() == []


def test_hours_and_peak(facts_small, days, rows):
    assert rows(reports.orders_by_hour(facts_small, days)) == [(10, "Weekend", 2), (12, "Weekday", 2)]
    assert tuple(reports.peak_hour(facts_small, days).first()) == (10, "Weekend", 2, "10:00")


def test_weather_reports(facts_small, rows):
    assert rows(reports.weather_volume(facts_small), "kondisi_cuaca", "n_orders", "total_revenue") == [
        ("Cerah", 1, D(200)), ("Hujan", 4, D(1406))]
    share = reports.weather_status_share(facts_small).where("kondisi_cuaca = 'Hujan'").first()
    # the denominator holds the status that is not shown
    assert tuple(share) == ("Hujan", 50.0, 0.0, 25.0)
    heat = reports.weather_hour_heatmap(facts_small).where("kondisi_cuaca = 'Hujan'").first()
    assert (heat["h10"], heat["h12"], heat["h13"], heat["h00"]) == (25.0, 50.0, 25.0, 0.0)


def test_city_reports(facts_small, rows):
    assert rows(reports.avg_daily_orders(facts_small)) == [
        ("jakarta", "Cerah", 1.0), ("jakarta", "Hujan", 1.0), ("medan", "Hujan", 1.5)]
    assert rows(reports.avg_daily_orders_pivot(facts_small)) == [("Cerah", 1.0, 0.0), ("Hujan", 1.0, 1.5)]
    got = [tuple(r) for r in reports.city_revenue(facts_small).select("city", "total_revenue", "avg_daily_revenue").collect()]
    assert got == [("jakarta", D(300), 300.0), ("medan", D(300), 300.0), ("surabaya", D(50), 50.0)]


def test_completion(facts_small):
    assert tuple(reports.completion_summary(facts_small).first()) == (6, 4, 400 / 6, D(650))


def test_category_shares(spark, rows):
    items = spark.createDataFrame(
        [(1, "Pizza", "delivered"), (1, "Pizza", "delivered"), (1, "Padang", "delivered"), (2, "Pizza", "lost"), (2, "Pizza", "delivered")],
        "user_id int, product_category string, order_status string")
    users = spark.createDataFrame([(1, "18-24"), (2, "55+")], "user_id int, age_group string")
    assert rows(reports.category_share_by_age(items, users)) == [
        ("18-24", "Padang", 1, 100 / 3), ("18-24", "Pizza", 2, 200 / 3), ("55+", "Pizza", 1, 100.0)]
    wide = [tuple(r) for r in reports.category_share_by_age_pivot(items, users, ["Padang", "Pizza"]).collect()]
    assert [r[1] for r in wide] == ["<18", "18-24", "25-34", "35-44", "45-54", "55+"]
    assert wide[0][2:] == (0.0, 0.0, 0.0) and wide[5][2:] == (0.0, 100.0, 0.0)
    named = [tuple(r)[2:] for r in reports.category_share_by_age_pivot(items, users, ["Padang"]).collect()]
    assert named[5] == (0.0, 100.0)  # a category without a column is in the rest


def test_executive_summary(spark, facts_small, merchants, dim_weather):
    row = reports.executive_summary(facts_small, merchants, merchants, dim_weather).first()
    assert tuple(row) == (6, 3, 3, datetime(2024, 1, 6, 10), datetime(2024, 1, 6, 11))


def test_reports_group_before_they_join(facts_small, merchants, plan):
    text = plan(reports.top_merchants(facts_small, merchants))
    assert "TakeOrderedAndProject" in text and "CartesianProduct" not in text
    join = next(i for i, line in enumerate(text.splitlines()) if "Join" in line)
    aggregate = next(i for i, line in enumerate(text.splitlines()) if "HashAggregate" in line)
    assert aggregate > join  # deeper in the tree: runs first


def test_hours_are_counted_before_the_day_join(spark, facts_small, days, plan):
    text = plan(reports.orders_by_hour(facts_small, days))
    assert "partial_count(1)" in text[text.index("Join"):]


def test_reports_read_only_their_columns(spark, tmp_path, plan, facts_small, merchants):
    facts_small.write.parquet(str(tmp_path / "f"))
    text = plan(reports.top_merchants(spark.read.parquet(str(tmp_path / "f")), merchants))
    assert "FileScan parquet [merchant_id" in text and "kondisi_cuaca" not in text
    assert "EqualTo(order_status,delivered)" in text


FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def source(spark):
    """The staged sources, with all orders in one month."""
    from dataclasses import replace

    from verification.queries import Data

    whole = Data(spark, FOLDER).sources
    return replace(whole, orders=whole.orders.withColumn("order_time", F.concat(F.lit("1996-03-"), F.expr("substring(order_time, 9)"))))


def test_warehouse_end_to_end(spark, tmp_path, source):
    from verification.queries import as_of

    out = warehouse.build_warehouse(source, as_of(), str(tmp_path / "w"))
    assert set(out) == {"dim_date", "dim_user", "dim_driver", "dim_merchant", "dim_product", "dim_weather", "fact_orders",
                        "fact_order_items", "load_audit"}
    assert out["fact_orders"].count() == out["fact_orders"].select("order_id").distinct().count() > 0
    assert out["fact_order_items"].join(out["fact_orders"], "order_id", "left_anti").count() == 0
    days = warehouse.build_warehouse(source, as_of(), str(tmp_path / "d"), partition_facts=True)
    for name in ("fact_orders", "fact_order_items"):  # the same rows and the same order of columns, in one folder a day
        assert days[name].columns == out[name].columns
        assert sorted(map(str, days[name].collect())) == sorted(map(str, out[name].collect()))


def test_a_late_order_rewrites_its_day_alone(spark, tmp_path, source):
    from dataclasses import replace

    from platewise.sources.store import Store
    from verification.queries import as_of

    store = Store(spark, str(tmp_path / "w"))
    warehouse.build_warehouse(source, as_of(), store.folder, partition_facts=True, loaded_at="2024-01-01 00:00:00")
    before = store.entries()
    # Complete, and of a city that has no other order: no mean and no mode of another row changes.
    values = {"order_id": "9000001", "user_id": "1", "city": "'elsewhere'", "delivery_area": "'elsewhere'", "merchant_id": "-5",
              "order_time": "'1996-03-02 10:00:00'", "discount": "0", "payment_method": "'cash'", "subtotal": "5", "delivery_fee": "7",
              "total_amount": "12", "distance_km": "1e0", "status": "'delivered'"}
    late = spark.range(1).selectExpr(*[f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in source.orders.schema.fields])
    again = replace(source, orders=source.orders.unionByName(late).unionByName(late))  # once too often: the second one is a duplicate
    warehouse.build_warehouse(again, as_of(), store.folder, partition_facts=True, loaded_at="2024-01-02 00:00:00")
    after = store.entries()
    changed = {day for day, part in after["fact_orders"].parts.items() if before["fact_orders"].parts.get(day) != part}
    assert changed == {"19960302"} and len(after["fact_orders"].parts) == 31
    assert after["fact_order_items"].parts == before["fact_order_items"].parts
    full = warehouse.build_warehouse(again, as_of(), str(tmp_path / "full"))
    for name in ("fact_orders", "fact_order_items"):
        assert sorted(map(str, store.read(name).collect())) == sorted(map(str, full[name].collect()))
    assert store.read("fact_orders", version=1).count() == store.read("fact_orders").count() - 1
    runs = {(r["run"], r["table_name"], r["step"]): r for r in store.read("load_audit").collect()}
    assert {run for run, *_ in runs} == {1, 2}
    assert runs[2, "orders", "dedup"]["removed"] == runs[1, "orders", "dedup"]["removed"] + 1
    assert runs[1, "users", "drop_missing_birth_date"]["rows_before"] == runs[1, "users", "drop_null_keys"]["rows_after"]
    store.clean()
    assert sorted(map(str, store.read("fact_orders").collect())) == sorted(map(str, full["fact_orders"].collect()))


def test_weather_of_the_first_hours_with_a_clock_offset(spark, tmp_path):
    readings = spark.sql(
        "SELECT 'jakarta' AS city, TIMESTAMP_NTZ '2022-12-31 20:00:00' AS time, 300e0 AS temp_k, 290e0 AS dewpoint_k, 0e0 AS rain"
    )
    orders = spark.createDataFrame([("2023-01-01 03:10:00",)], "order_time string")
    empty = {n: None for n in ("users", "drivers", "merchants", "products", "order_items", "reviews")}
    sources = warehouse.Sources(orders=orders, weather_readings=readings, **empty)
    assert warehouse.weather_for(sources).count() == 0
    assert warehouse.weather_for(sources, {"jakarta": 7}).count() == 1
