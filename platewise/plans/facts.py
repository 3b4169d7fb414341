"""Fact tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.functions import calendar
from platewise.operators.lookup import lookup
from platewise.plans.weather import with_weather
from platewise.sources.buckets import Bucketed, join_in_place

DELIVERED = "delivered"


def is_cancelled(status: Column) -> Column:
    return F.coalesce(F.contains(status, F.lit("cancel")), F.lit(False)).cast("int")


def is_delivered(status: Column) -> Column:
    return F.coalesce(status == DELIVERED, F.lit(False)).cast("int")


def fact_orders(
    orders: DataFrame, dim_weather: DataFrame, utc_offset_hours: Mapping[str, int] | None = None, **spread
) -> DataFrame:
    """One row per clean order. The columns of the order fact."""
    time, status = F.col("order_time"), F.col("status")
    return with_weather(orders, dim_weather, utc_offset_hours, **spread).select(
        "order_id",
        "user_id",
        "driver_id",
        "merchant_id",
        calendar.date_id(time).alias("date_id"),
        F.hour(time).alias("order_hour"),
        calendar.is_weekend(time).alias("is_weekend"),
        "city",
        status.alias("order_status"),
        "payment_method",
        "subtotal",
        "delivery_fee",
        "discount",
        "total_amount",
        "distance_km",
        "delivery_area",
        is_delivered(status).alias("is_delivered"),
        is_cancelled(status).alias("is_cancelled"),
        "weather_id",
        "kondisi_cuaca",
    )


def fact_order_items(items: DataFrame, facts: DataFrame, **spread) -> DataFrame:
    """One row per clean order line that belongs to a fact order; lines without one are dropped."""
    return _lines(lookup(items, order_side(facts), ["order_id"], how="inner", **spread))


def fact_order_items_in_place(items: Bucketed, facts: Bucketed) -> tuple[DataFrame, DataFrame | None]:
    """The same from tables in buckets of the order id, without a shuffle: lines of ordinary orders, and of the hot ones."""
    side = Bucketed(order_side(facts.ordinary), facts.key, facts.buckets)
    ordinary, hot = join_in_place(items, side)
    return _lines(ordinary), None if hot is None else _lines(hot)


def order_side(facts: DataFrame) -> DataFrame:
    """What a line gets from its order."""
    return facts.select(
        "order_id", "user_id", "date_id", "city", "order_status", "weather_id", "kondisi_cuaca"
    ).dropna(subset=["user_id", "date_id"])


def _lines(joined: DataFrame) -> DataFrame:
    """The columns of the line fact."""
    return joined.select(
        "order_item_id",
        "order_id",
        "product_id",
        "merchant_id",
        "user_id",
        "date_id",
        "city",
        "product_name",
        F.col("category").alias("product_category"),
        "quantity",
        "unit_price",
        F.col("subtotal").alias("item_subtotal"),
        "order_status",
        "weather_id",
        "kondisi_cuaca",
    )


def lines_without_order(items: DataFrame, facts: DataFrame) -> DataFrame:
    """One row: lines before and after the look-up of :func:`fact_order_items`, from counts per order."""
    counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows"))
    known = facts.select("order_id", F.lit(1).alias("_known"))
    kept = counts.join(known, "order_id", "left")
    return kept.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.when(F.col("_known") == 1, F.col("_rows"))), F.lit(0)).alias("rows_after"),
    )
