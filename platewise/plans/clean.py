"""Cleaning jobs, one per source table.

Each job removes duplicates and rows without their critical columns, writes that base once to the shared folder, and
fills the remaining nulls from group statistics that scan only the columns they need.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from platewise.functions import calendar, money, text
from platewise.operators.audit import Trail, with_load_time
from platewise.operators.dedup import keep_first, keep_first_of_many
from platewise.operators.impute import fill_by_group, fill_constants, fill_global_mode
from platewise.workspace import materialise

# What an attribute gets if no other row can tell.
UNKNOWN = "Unknown"
UNKNOWN_PRODUCT = "Unknown Product"
DEFAULT_PAYMENT = "cash"
DEFAULT_VEHICLE = "motor"
DEFAULT_CATEGORY = "Lainnya"

REQUIRED = {
    "users": ("user_id", "full_name"),
    "drivers": ("driver_id", "full_name"),
    "merchants": ("merchant_id", "merchant_name"),
    "products": ("product_id", "merchant_id"),
    "orders": ("order_id", "user_id", "merchant_id"),
    "order_items": ("order_item_id", "order_id", "product_id"),
}


def drop_null_keys(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


def unique_complete(df: DataFrame, table: str, order_by: Sequence[str] = ()) -> DataFrame:
    """First row of every key, if its critical columns are present. Null keys leave before the shuffle."""
    key, *_ = REQUIRED[table]
    return drop_null_keys(keep_first(df.where(F.col(key).isNotNull()), [key], order_by), REQUIRED[table])


def _base(df: DataFrame, table: str, order_by: Sequence[str], trail: Trail | None, valid: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows that cleaning starts from, written once; ``valid`` drops further ones, and the trail gets the rows of each step."""
    key, *_ = REQUIRED[table]
    note = (lambda rows, step: trail.observe(rows, table, step)) if trail else (lambda rows, step: rows)
    if trail:
        trail.raw(df, table, key)
    unique = note(keep_first_of_many(df.where(F.col(key).isNotNull()), key, order_by), "dedup")
    rows = note(drop_null_keys(unique, REQUIRED[table]), "drop_null_keys")
    return materialise(note(valid(rows), "drop_invalid") if valid else rows, table)


def clean_users(df: DataFrame, order_by: Sequence[str] = (), trail: Trail | None = None) -> DataFrame:
    """Users whose birth date stays missing go before the coordinates and areas of the others are learnt."""
    base = _base(df, "users", order_by, trail)
    dated = fill_by_group(base, "city", modes={"gender": UNKNOWN, "date_of_birth": None}).dropna(subset=["date_of_birth"])
    filled = fill_by_group(dated, "city", means={"lat": None, "lon": None}, modes={"address_area": UNKNOWN})
    return fill_constants(filled, {"is_active": 1})


def coerce_order_time(df: DataFrame, fmt: str = calendar.ORDER_TIME_FORMAT) -> DataFrame:
    """Parse the order time; rows whose time cannot be read are dropped."""
    return df.withColumn("order_time", calendar.parse_timestamp(F.col("order_time"), fmt)).dropna(
        subset=["order_time"]
    )


def clean_orders(df: DataFrame, order_by: Sequence[str] = (), trail: Trail | None = None) -> DataFrame:
    """Distances are filled from the completed area; merchants, which can be many, come last."""
    totals = Observation()
    given = (F.sum("total_amount").alias("sum"), F.count("total_amount").alias("n"))
    base = _base(df, "orders", order_by, trail, lambda rows: coerce_order_time(rows).observe(totals, *given))
    filled = fill_by_group(
        base, "city", means={"delivery_fee": 2}, modes={"payment_method": DEFAULT_PAYMENT, "delivery_area": UNKNOWN}
    )
    filled = fill_by_group(filled, "delivery_area", means={"distance_km": 2})
    filled = fill_by_group(filled, "merchant_id", means={"subtotal": 2}, learn_from=base)
    filled = fill_constants(filled, {"discount": 0})
    total = money.order_total(F.col("subtotal"), F.col("delivery_fee"), F.col("discount"))
    # Still null only where the whole subtotal or fee column is empty; the mean is then that of the given totals, seen while the base was written.
    seen = totals.get
    mean = F.bround(F.lit(seen["sum"]).cast("decimal(28,2)") / F.lit(seen["n"]).cast("decimal(19,0)"), 2) if seen["n"] else F.lit(None)
    return filled.withColumn("total_amount", F.coalesce(F.col("total_amount"), total, mean.cast(money.MONEY)))


def clean_order_items(df: DataFrame, order_by: Sequence[str] = (), trail: Trail | None = None) -> DataFrame:
    """A line subtotal is worked out only where it is missing, also if the quantity was corrected."""
    base = _base(df, "order_items", order_by, trail)
    filled = fill_by_group(base, "product_id", means={"unit_price": 2})
    quantity = F.when(F.col("quantity") > 0, F.col("quantity")).otherwise(1)
    return filled.withColumn("quantity", quantity).withColumn(
        "subtotal", F.coalesce(F.col("subtotal"), (F.col("quantity") * F.col("unit_price")).cast(money.MONEY))
    )


def clean_drivers(df: DataFrame, order_by: Sequence[str] = (), trail: Trail | None = None) -> DataFrame:
    base = _base(df, "drivers", order_by, trail)
    filled = fill_by_group(base, "city", means={"rating": 2})
    filled = fill_global_mode(filled, "vehicle_type", DEFAULT_VEHICLE)
    return fill_constants(filled, {"total_trips": 0, "is_active": 1})


def clean_merchants(df: DataFrame, order_by: Sequence[str] = (), trail: Trail | None = None) -> DataFrame:
    base = _base(df, "merchants", order_by, trail)
    filled = fill_by_group(base, "city", means={"lat": 6, "lon": 6}, modes={"area": UNKNOWN})
    filled = fill_by_group(filled, "category", means={"rating": 2}, learn_from=base)
    return fill_constants(filled, {"is_active": 1})


def clean_products(df: DataFrame, order_by: Sequence[str] = (), trail: Trail | None = None) -> DataFrame:
    """Prices are filled from the category before missing categories are filled."""
    base = _base(df, "products", order_by, trail)
    filled = fill_by_group(base, "category", means={"price": 2})
    filled = fill_global_mode(filled, "category", DEFAULT_CATEGORY)
    return fill_constants(filled, {"product_name": UNKNOWN_PRODUCT, "is_available": 1})


def clean_transactions(df: DataFrame, loaded_at, order_by: Sequence[str] = ()) -> DataFrame:
    """Older basket feed: ratings of unfinished baskets are 0, one row per transaction."""
    filled = fill_constants(df, {"rating_merchant": 0.0, "rating_driver": 0.0})
    return with_load_time(keep_first(filled, ["transaction_id"], order_by), loaded_at)


def clean_older_tables(tables: Mapping[str, DataFrame], loaded_at, facts: str = "fact_transaction") -> dict[str, DataFrame]:
    """The older warehouse in one step: the fact cleaned, city names in title case, the load time on every table."""
    out = {}
    for name, df in tables.items():
        if name == facts:
            out[name] = clean_transactions(df, loaded_at)
        else:
            df = standardise_city(df) if name == "dim_customer" else df
            out[name] = with_load_time(df, loaded_at)
    return out


def standardise_city(df: DataFrame, column: str = "city") -> DataFrame:
    return df.withColumn(column, text.title_case(F.col(column)))
