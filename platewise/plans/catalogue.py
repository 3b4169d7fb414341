"""Merchant and product catalogues, and comma-joined basket lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.functions import geo, money, text
from platewise.operators.dedup import keep_first
from platewise.workspace import materialise

LIST_LENGTH = 1_000  # positions in one row of a basket list


def catalogue_v1(raw: DataFrame) -> DataFrame:
    """Normalised merchant list from the older catalogue, one row per merchant key.

    Where a rating cannot be read the field is null; no value is invented.
    """
    average, total = text.rating_fields(F.col("ratings"))
    level = text.cast_or(F.col("priceLevel"), "int", 1)
    parsed = raw.select(
        text.merchant_key(F.col("uid")).alias("merchant_id"),
        text.strip(F.col("displayName")).alias("merchant_name"),
        text.tag_category(F.col("tags")).alias("category"),
        text.area_name(F.col("city")).alias("area"),
        average.alias("rating"),
        total.alias("total_reviews"),
        level.alias("price_level"),
        money.level_min_order(level).alias("min_order"),
        money.level_fee(level).alias("delivery_fee"),
        text.open_all_day(F.col("openPeriods")).alias("is_open_24h"),
        text.is_active_status(F.col("status")).alias("is_active"),
        text.cast_or(F.col("`location.latitude`"), "double", text.DEFAULT_LATITUDE).alias("latitude"),
        text.cast_or(F.col("`location.longitude`"), "double", text.DEFAULT_LONGITUDE).alias("longitude"),
        text.blank_to_null(F.col("`brand.displayName`")).alias("brand"),
    )
    return keep_first(parsed, ["merchant_id"])


def with_merchant_key(raw: DataFrame) -> DataFrame:
    """Clean the natural key (name, area) and attach its surrogate, computed in place."""
    cleaned = raw.withColumns(
        {
            "merchant_name": text.strip(F.col("merchant_name")),
            "merchant_area": text.title_case(text.strip(F.col("merchant_area"))),
        }
    )
    return cleaned.withColumn("merchant_id", text.surrogate_key(F.col("merchant_name"), F.col("merchant_area")))


def catalogue_merchants(raw: DataFrame) -> DataFrame:
    merchants = with_merchant_key(raw).select("merchant_id", "merchant_name", "merchant_area").distinct()
    return merchants.withColumn("city", geo.area_to_city(F.col("merchant_area")))


def catalogue_products(raw: DataFrame) -> DataFrame:
    """Distinct products with the category brought to the fixed list."""
    columns = ["category", "display", "product", "price", "discount_price", "isDiscount", "description"]
    distinct = with_merchant_key(raw).select("merchant_id", *columns).distinct()
    return distinct.withColumn("category", text.product_category(F.col("category")))


def catalogue_v2(raw: DataFrame) -> DataFrame:
    """Distinct products together with their merchant's name, area and city.

    The merchant columns are part of the key that made ``merchant_id``, so they ride along without a join.
    """
    columns = ["category", "display", "product", "price", "discount_price", "isDiscount", "description"]
    distinct = with_merchant_key(raw).select("merchant_id", "merchant_name", "merchant_area", *columns).distinct()
    return distinct.withColumns(
        {
            "city": geo.area_to_city(F.col("merchant_area")),
            "category": text.product_category(F.col("category")),
        }
    )


def category_profile(products: DataFrame) -> DataFrame:
    """Rows per category, and the number of categories on every row."""
    counts = products.where(F.col("category").isNotNull()).groupBy("category").agg(
        F.count(F.lit(1)).alias("n_products")
    )
    return counts.withColumn("n_categories", counts.agg(F.count(F.lit(1))).scalar())


def basket_positions(lines: DataFrame, basket: str, item: str, label: str) -> DataFrame:
    """One row per line of a basket: its position from 0 in order of item and label, and the basket's ``n_items``.

    ``lines`` has no exact copies. Rows are laid out in ranges of (basket, item, label), so a huge basket spans several ranges and
    no task holds it whole. Positions are counted within a range; baskets that continue from an earlier range, at most one for
    each range, get its counts added.
    """
    order = [basket, item, label]
    ranged = lines.where(F.col(basket).isNotNull()).select(*order).repartitionByRange(*order)
    ranged = materialise(ranged.withColumn("_range", F.spark_partition_id()), "basket-ranges")
    counts = ranged.groupBy(basket, "_range").agg(F.count(F.lit(1)).alias("_n"))
    over = counts.groupBy(basket).agg(F.count(F.lit(1)).alias("_ranges"), F.sum("_n").alias("_total")).where("_ranges > 1")
    earlier = F.sum("_n").over(Window.partitionBy(basket).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    # At most two rows for each range.
    offsets = counts.join(F.broadcast(over), basket).select(
        basket, "_range", F.coalesce(earlier, F.lit(0)).alias("_before"), "_total"
    )
    within = Window.partitionBy("_range", basket)
    placed = ranged.select(
        *order,
        "_range",
        (F.row_number().over(within.orderBy(item, label)) - 1).alias("_at"),
        F.count(F.lit(1)).over(within).alias("_here"),
    )
    return placed.join(F.broadcast(offsets), [basket, "_range"], "left").select(
        basket,
        (F.col("_at") + F.coalesce("_before", F.lit(0))).cast("bigint").alias("position"),
        item,
        label,
        F.coalesce("_total", "_here").cast("bigint").alias("n_items"),
    )


def basket_list(lines: DataFrame, basket: str, item: str, label: str, *, per_row: int = LIST_LENGTH) -> DataFrame:
    """Comma-joined item ids and names per basket, sorted by item, ``per_row`` positions in each row.

    Every basket follows the same rule: position p stands in row ``part`` = p / per_row. ``n_items`` is the basket's total.
    """
    entry = F.struct("position", F.col(item).cast("string").alias("item"), F.col(label).alias("label"))
    parts = basket_positions(lines, basket, item, label).withColumn("part", F.floor(F.col("position") / per_row).cast("int"))
    grouped = parts.groupBy(basket, "part").agg(F.sort_array(F.collect_list(entry)).alias("entries"), F.max("n_items").alias("n_items"))
    return grouped.select(
        basket,
        "part",
        F.array_join(F.transform("entries", lambda e: e["item"]), ",").alias("product_ids"),
        F.array_join(F.transform("entries", lambda e: e["label"]), ",").alias("product_names"),
        "n_items",
    )


def basket_explode(lines: DataFrame, basket: str, item: str, label: str) -> DataFrame:
    """One row per listed item with its position. Names stay with their items, whatever signs they hold."""
    return basket_positions(lines, basket, item, label).select(
        basket, "position", F.col(item).cast("string").alias("product_id"), F.col(label).alias("product_name")
    )


def basket_totals(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Subtotal from price x quantity per order, and the total after fee and discount, not below zero.

    ``orders`` has one row per order, so both sides of the join are unique.
    """
    value = F.col("unit_price") * F.col("quantity")
    sums = lines.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.coalesce(F.sum(value), F.lit(0)).cast(money.MONEY).alias("items_subtotal")
    )
    joined = sums.join(orders.select("order_id", "delivery_fee", "discount"), "order_id")
    total = money.order_total(F.col("items_subtotal"), F.col("delivery_fee"), F.col("discount"))
    return joined.withColumn("basket_total", money.floor_at_zero(total).cast(money.MONEY))
