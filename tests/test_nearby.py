import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from platewise.operators.nearby import within
from platewise.plans import weather
from platewise.sources import readers


def circle(a, b, c, d):
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(x))


@pytest.mark.parametrize("km", [0.5, 30.0, 400.0])
def test_equals_all_distances(spark, km):
    rng = random.Random(int(km))
    centres = [(-6.2, 106.8), (0.0, 0.0), (60.1, -179.99), (59.9, 179.98), (-80.0, 10.0), (0.0, 180.0), (45.0, -180.0), (7.0, 359.0)]
    points = [(f"p{i}", *c) for i, c in enumerate(centres)] + [("none", None, 1.0)]
    spread = 2 * km / 111
    rows = []
    for i in range(900):
        lat, lon = rng.choice(centres)
        rows.append((i, lat + rng.uniform(-spread, spread), lon + rng.uniform(-spread, spread) / math.cos(math.radians(lat))))
    rows.append((9999, None, 5.0))
    found = within(spark.createDataFrame(rows, "id int, lat double, lon double"), spark.createDataFrame(points, "name string, lat double, lon double"), km)
    got = {(r["id"], r["name"]) for r in found.collect()}
    want = {(i, n) for i, a, b in rows for n, c, d in points if None not in (a, c) and circle(a, b, c, d) <= km}
    assert got == want and len(want) > 100 and found.columns == ["id", "lat", "lon", "name", "distance_km"]


def test_no_nested_loop(spark, plan):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        text = plan(within(spark.range(10).selectExpr("id", "id * 1e0 AS lat", "id * 1e0 AS lon"), readers.city_points(spark), 5.0))
        assert "NestedLoop" not in text and "Cartesian" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_readings_by_place_give_the_weather_of_the_city(spark, rows):
    at = datetime(2024, 1, 6, 10, 5)
    named = spark.createDataFrame(
        [("jakarta", at, 295.0, 280.0, 0.01), ("jakarta", at, 300.0, 280.0, 0.0), ("medan", at, 310.0, 280.0, 0.0), ("bogor", at, 310.0, 280.0, 0.0)],
        "city string, time timestamp_ntz, temp_k double, dewpoint_k double, rain double")
    places = {"jakarta": (-6.22, 106.83), "medan": (3.6, 98.65), "bogor": (-6.6, 106.8)}
    lat, lon = (F.create_map(*[x for c, p in places.items() for x in (F.lit(c), F.lit(p[i]))])[F.col("city")] for i in (0, 1))
    placed = named.withColumns({"lat": lat, "lon": lon}).drop("city")
    got = weather.hourly_weather(readers.readings_at(placed, readers.city_points(spark)))
    assert rows(got) == rows(weather.hourly_weather(named)) and got.count() == 2
