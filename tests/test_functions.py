import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from platewise.functions import calendar, geo, money, people, text, weather


def apply(spark, value, kind, fn):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value", ["", "not a date", None, "2024-01", "2024-02-30 10:00:00", "2024-01-01 10:00"])
def test_unreadable_times_are_null(spark, value):
    assert apply(spark, value, "string", calendar.parse_timestamp) is None


def test_readable_time_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This wall-clock time does not exist in that zone.
        got = apply(spark, "2024-03-10 02:30:00", "string", calendar.parse_timestamp)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == datetime(2024, 3, 10, 2, 30)


def test_other_time_format(spark):
    got = apply(spark, "05/03/2024 07:08", "string", lambda c: calendar.parse_timestamp(c, "dd/MM/yyyy HH:mm"))
    assert got == datetime(2024, 3, 5, 7, 8)


@pytest.mark.parametrize(
    "day,iso,weekend,name",
    [(5, 5, 0, "Friday"), (6, 6, 1, "Saturday"), (7, 7, 1, "Sunday"), (8, 1, 0, "Monday")],
)
def test_weekday_parts(spark, day, iso, weekend, name):
    row = spark.createDataFrame([(date(2024, 1, day),)], "v date").select(
        calendar.iso_weekday(F.col("v")), calendar.is_weekend(F.col("v")), calendar.day_name(F.col("v")),
        calendar.weekday_rank(calendar.day_name(F.col("v"))), calendar.date_id(F.col("v")),
        calendar.date_from_id(calendar.date_id(F.col("v"))),
    ).first()
    assert tuple(row) == (iso, weekend, name, iso, 20240100 + day, date(2024, 1, day))


def test_hour_parts(spark):
    row = spark.createDataFrame([(datetime(2024, 5, 6, 7, 59, 59),)], "v timestamp_ntz").select(
        calendar.hour_floor(F.col("v")), calendar.hour_stamp(F.col("v")), calendar.hour_label(F.hour("v")),
        calendar.month_abbreviation(F.col("v")), calendar.month_name(F.col("v")),
        weather.weather_key(F.lit("medan"), F.col("v")),
    ).first()
    assert tuple(row) == (datetime(2024, 5, 6, 7), "2024050607", "07:00", "Mei", "May", "medan_2024050607")


def test_minutes_between(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 1, 30))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(calendar.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1.5


def test_day_type(spark):
    assert [apply(spark, v, "int", calendar.day_type) for v in (1, 0, None)] == ["Weekend", "Weekday", None]


@pytest.mark.parametrize("days,age", [(18 * 365 - 1, 17), (18 * 365, 18), (0, 0), (-1, 0), (-365, -1)])
def test_age_uses_365_day_years(spark, days, age):
    born = date.fromordinal(date(2024, 1, 1).toordinal() - days)
    assert apply(spark, born, "date", lambda c: people.age_years(c, F.lit("2024-01-01").cast("date"))) == age


@pytest.mark.parametrize(
    "age,group",
    [(17, "<18"), (18, "18-24"), (24, "18-24"), (25, "25-34"), (35, "35-44"), (45, "45-54"), (54, "45-54"), (55, "55+")],
)
def test_age_groups(spark, age, group):
    assert apply(spark, age, "int", people.age_group) == group


@pytest.mark.parametrize("km,fee", [(0.0, 2000), (0.1, 2000), (0.3, 3000), (8.38, 23000), (50.0, 25000), (None, None)])
def test_delivery_fee(spark, km, fee):
    assert apply(spark, km, "double", money.delivery_fee) == fee


@pytest.mark.parametrize("level,fee,minimum", [(1, 3000, 0), (2, 5000, 10000), (3, 9000, 20000), (9, 5000, 0), (None, 5000, 0)])
def test_price_levels(spark, level, fee, minimum):
    assert apply(spark, level, "int", money.level_fee) == fee
    assert apply(spark, level, "int", money.level_min_order) == minimum


def test_floor_at_zero_keeps_null(spark):
    assert [apply(spark, v, "int", money.floor_at_zero) for v in (-5, 0, 5, None)] == [0, 0, 5, None]


def test_haversine(spark):
    df = spark.createDataFrame([(-6.2, 106.8, -7.25, 112.75)], "a double, b double, c double, d double")
    km = df.select(geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0]
    a = math.sin(math.radians(-1.05) / 2) ** 2 + math.cos(math.radians(-6.2)) * math.cos(math.radians(-7.25)) * math.sin(
        math.radians(5.95) / 2) ** 2
    assert km == pytest.approx(6371 * 2 * math.asin(math.sqrt(a)), rel=1e-12)


@pytest.mark.parametrize(
    "area,city",
    [("South Jakarta", "jakarta"), ("SBY East", "surabaya"), ("MEDAN kota", "medan"), ("surabaya, jakarta", "jakarta"),
     ("elsewhere", "jakarta"), (None, "jakarta")],
)
def test_area_to_city(spark, area, city):
    assert apply(spark, area, "string", geo.area_to_city) == city


def test_city_label(spark):
    assert [apply(spark, c, "string", geo.city_label) for c in ("jakarta", "bogor", None)] == ["DKI Jakarta", "bogor", None]


@pytest.mark.parametrize(
    "temp,rain,rh,label",
    [(295.0, 0.0, 50.0, "Cerah"), (295.0, 0.002, 50.0, "Cerah"), (295.0, 0.0021, 50.0, "Hujan"),
     (295.0, 0.0, 85.0, "Cerah"), (295.0, 0.0, 85.1, "Berawan"), (303.15, 0.0, 50.0, "Cerah"),
     (303.25, 0.0, 50.0, "Panas"), (None, None, None, "Cerah"), (303.25, None, 90.0, "Berawan"), (0.0, 0.0, 0.0, "Cerah")],
)
def test_weather_classes(spark, temp, rain, rh, label):
    df = spark.createDataFrame([(temp, rain, rh)], "t double, r double, h double")
    assert df.select(weather.classify(F.col("t"), F.col("r"), F.col("h"))).first()[0] == label


def test_humidity(spark):
    df = spark.createDataFrame([(300.0, 300.0), (303.15, 293.15), (300.0, None)], "t double, d double")
    got = [r[0] for r in df.select(weather.relative_humidity(F.col("t"), F.col("d"))).collect()]
    assert got[0] == 100.0 and got[1] == pytest.approx(55.08, abs=0.05) and got[2] is None


@pytest.mark.parametrize(
    "raw,category",
    [(" Ayam Geprek ", "Ayam & Bebek"), ("nasi ikan", "Seafood"), ("Ramen", "Mie & Pasta"), ("mi", "Unknown"),
     ("mi goreng", "Mie & Pasta"), ("mi ", "Unknown"), ("sub way", "Burger & Sandwich"), ("rendang", "Nasi & Lauk"),
     ("FISH & CHIPS", "Western"), ("gulai", "Padang"), (None, "Unknown"), ("plain", "Unknown"), ("pempek", "Bakso & Soto")],
)
def test_product_categories(spark, raw, category):
    assert apply(spark, raw, "string", text.product_category) == category


@pytest.mark.parametrize(
    "tags,category",
    [("['Ayam', 'Nasi']", "Ayam & Unggas"), ("['Indonesia']", "Nasi & Lauk"), ("['ICE CREAM']", "Dessert & Snack"),
     ("['Soto', 'Bakmi']", "Mie & Pasta"), ("[]", "Unknown"), (None, "Unknown")],
)
def test_tag_categories(spark, tags, category):
    assert apply(spark, tags, "string", text.tag_category) == category


@pytest.mark.parametrize(
    "city,area",
    [(" kota DEPOK baru", "Depok"), ("Yogyakarta, Sleman", "Sleman"), (" nan ", "Unknown"), (None, "Unknown"), ("", "Unknown"),
     ("bandung barat", "Bandung Barat")],
)
def test_area_names(spark, city, area):
    assert apply(spark, city, "string", text.area_name) == area


@pytest.mark.parametrize("value", ["medan's", "BARAT-daya", "3rd street", "a  b", "", "x1y2"])
def test_title_case_capitalises_after_any_non_letter(spark, value):
    assert apply(spark, value, "string", text.title_case) == value.title()


@pytest.mark.parametrize(
    "literal,expected",
    [("{'average': 4.6, 'total': 12}", (4.6, 12)), ("{'average': 0, 'total': 0}", (None, None)), ("broken", (None, None)),
     (None, (None, None)), ("{'average': 5}", (5.0, None))],
)
def test_ratings(spark, literal, expected):
    df = spark.createDataFrame([(literal,)], "v string")
    assert tuple(df.select(*text.rating_fields(F.col("v"))).first()) == expected


def test_small_text_helpers(spark):
    assert apply(spark, "ab-cd-efghij", "string", text.merchant_key) == "MRCABCDEFGH"
    assert [apply(spark, v, "string", text.blank_to_null) for v in (" nan ", "", "None", " x ", None)] == [
        None, None, None, "x", None]
    assert [apply(spark, v, "string", text.is_active_status) for v in (" 1 ", "0", None)] == [True, False, False]
    assert [apply(spark, v, "string", lambda c: text.cast_or(c, "double", -7.8)) for v in ("1.5", "n/a", None)] == [
        1.5, -7.8, -7.8]
    assert apply(spark, "[{'startTime': {'hours': 0}, 'endTime': {'hours': 23}}]", "string", text.open_all_day) is True
    assert apply(spark, None, "string", text.open_all_day) is False
    assert apply(spark, "\t x \n", "string", text.strip) == "x"


def test_surrogate_key_tells_its_parts_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", "a")], "x string, y string")
    keys = [r[0] for r in df.select(text.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 3  # a missing part is not an empty one


def test_unreadable_numbers_are_null_and_raise_nothing(spark):
    df = spark.createDataFrame([("{'average': 4.5, 'total': 9999999999}", float("nan")), ("{'average': NaN, 'total': 3}", 1.0), ("x", 1e300)],
                               "literal string, distance double")
    average, total = text.rating_fields(F.col("literal"))
    out = [tuple(r) for r in df.select(average, total, money.delivery_fee(F.col("distance"))).collect()]
    assert out == [(4.5, None, None), (None, 3, 4500), (None, None, 25000)]
