"""Dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.functions import calendar, people


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day that has an order; ``orders`` needs only an ``order_time``, parsed or as text."""
    time = F.col("order_time")
    if orders.schema["order_time"].dataType.typeName() == "string":
        time = calendar.parse_timestamp(time)
    days = orders.select(F.to_date(time).alias("full_date")).dropna().distinct()
    day = F.col("full_date")
    return days.select(
        calendar.date_id(day).alias("date_id"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        calendar.month_name(day).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        calendar.day_name(day).alias("day_name"),
        calendar.iso_weekday(day).alias("day_of_week"),
        calendar.is_weekend(day).alias("is_weekend"),
    )


def dim_user(users: DataFrame, as_of: Column) -> DataFrame:
    aged = users.withColumn("age", people.age_years(F.col("date_of_birth"), as_of))
    return aged.select(
        "user_id",
        F.col("full_name").alias("user_name"),
        "gender",
        "age",
        people.age_group(F.col("age")).alias("age_group"),
        "city",
        F.col("address_area").alias("user_area"),
        F.col("lat").alias("user_lat"),
        F.col("lon").alias("user_lon"),
        F.col("is_active").alias("user_is_active"),
    )


def dim_driver(drivers: DataFrame) -> DataFrame:
    return drivers.select(
        "driver_id",
        F.col("full_name").alias("driver_name"),
        "vehicle_type",
        "city",
        F.col("current_area").alias("driver_area"),
        F.col("rating").alias("driver_rating"),
        "total_trips",
        F.col("is_active").alias("driver_is_active"),
    )


def merchant_review_avg(reviews: DataFrame) -> DataFrame:
    """Mean review rating per merchant to two decimals; whole-number ratings are summed exactly."""
    mean = F.try_divide(F.sum("merchant_rating").cast("decimal(20,0)"), F.count("merchant_rating"))
    return (
        reviews.where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.bround(mean, 2).cast("double").alias("avg_review_rating"))
    )


def dim_merchant(merchants: DataFrame, reviews: DataFrame) -> DataFrame:
    """Merchants with their mean review rating, or their own rating if nobody reviewed them."""
    rated = merchants.join(merchant_review_avg(reviews), "merchant_id", "left")
    return rated.select(
        "merchant_id",
        "merchant_name",
        F.col("category").alias("merchant_category"),
        "city",
        F.col("area").alias("merchant_area"),
        F.col("lat").alias("merchant_lat"),
        F.col("lon").alias("merchant_lon"),
        F.col("rating").alias("merchant_rating"),
        F.coalesce(F.col("avg_review_rating"), F.col("rating")).alias("avg_review_rating"),
        F.col("is_active").alias("merchant_is_active"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "merchant_id", "product_name", F.col("category").alias("product_category"), "price",
        "is_available",
    )


def dim_time(date_range: DataFrame, holidays: Sequence[str] = calendar.HOLIDAYS_2024) -> DataFrame:
    """Every day of [start_date, end_date], with local month abbreviations and a holiday flag."""
    days = date_range.where(F.col("start_date").isNotNull()).select(
        F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        calendar.date_id(day).alias("date_id"),
        "full_date",
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        calendar.month_abbreviation(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        calendar.day_name(day).alias("day_of_week"),
        (calendar.is_weekend(day) == 1).alias("is_weekend"),
        day.cast("string").isin(*holidays).alias("is_holiday"),
    )
