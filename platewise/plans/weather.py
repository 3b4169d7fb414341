"""Hourly weather per city, its dimension, and the match to orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.functions import calendar, geo, weather
from platewise.operators.lookup import lookup, rows_without_partner
from platewise.sources.readers import weather_observations


def hourly_first(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """First non-null ``value`` by time in every (keys, hour); an hour of only nulls stays, as null."""
    earliest = F.min(F.when(F.col(value).isNotNull(), F.struct(F.col(time), F.col(value))))[value]
    return df.groupBy(*keys, calendar.hour_floor(F.col(time)).alias("_hour")).agg(earliest.alias(value)).select(
        *keys, F.col("_hour").alias(time), value
    )


def hourly_weather(
    readings: DataFrame,
    cities: Sequence[str] = tuple(geo.CITY_LABELS),
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Readings -> humidity -> weather class -> first class of each hour."""
    seen = weather_observations(readings, cities, start, end)
    classed = seen.select(
        "city",
        geo.city_label(F.col("city")).alias("wilayah"),
        F.col("time").alias("waktu"),
        weather.classify(F.col("temp_k"), F.col("rain"), F.col("humidity")).alias("cuaca"),
    )
    return hourly_first(classed, ["city", "wilayah"], "waktu", "cuaca")


def dim_weather(hourly: DataFrame) -> DataFrame:
    return hourly.select(
        weather.weather_key(F.col("city"), F.col("waktu")).alias("weather_id"),
        "city",
        "wilayah",
        "waktu",
        calendar.date_id(F.col("waktu")).alias("date_id"),
        F.hour("waktu").alias("hour"),
        F.col("cuaca").alias("kondisi_cuaca"),
    )


def _service_hour(order_time: Column, city: Column, utc_offset_hours: Mapping[str, int] | None) -> Column:
    """Hour of the weather service clock; by default equal to the order's own clock."""
    if not utc_offset_hours:
        return calendar.hour_floor(order_time)
    offset = F
    for key, hours in utc_offset_hours.items():
        offset = offset.when(city == key, hours)
    shifted = order_time - F.make_dt_interval(hours=offset.otherwise(0))
    return calendar.hour_floor(shifted)


def order_hours(orders: DataFrame, utc_offset_hours: Mapping[str, int] | None = None) -> DataFrame:
    """City and weather-clock hour of every order; the order time may be parsed or text."""
    time = F.col("order_time")
    if orders.schema["order_time"].dataType.typeName() == "string":
        time = calendar.parse_timestamp(time)
    return orders.select("city", _service_hour(time, F.col("city"), utc_offset_hours).alias("waktu"))


def with_weather(
    orders: DataFrame, dim: DataFrame, utc_offset_hours: Mapping[str, int] | None = None, **spread
) -> DataFrame:
    """Add ``weather_id`` (null without a match) and ``kondisi_cuaca`` (unknown without one) to the orders."""
    hours = dim.select("city", "waktu", "weather_id", "kondisi_cuaca")
    keyed = orders.withColumn("waktu", _service_hour(F.col("order_time"), F.col("city"), utc_offset_hours))
    matched = lookup(keyed, hours, ["city", "waktu"], **spread).drop("waktu")
    return matched.withColumn("kondisi_cuaca", F.coalesce(F.col("kondisi_cuaca"), F.lit(weather.UNKNOWN)))


def unmatched_orders(
    orders: DataFrame, dim: DataFrame, utc_offset_hours: Mapping[str, int] | None = None
) -> DataFrame:
    """One row: number of orders without weather, from counts per city and hour."""
    return rows_without_partner(order_hours(orders, utc_offset_hours), ["city", "waktu"], dim, "unmatched_orders")
