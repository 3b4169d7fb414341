"""Fees, totals and price terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Delivery tariff.
FEE_BASE = 2000
FEE_PER_KM = 2500
FEE_STEP = 500
FEE_CAP = 25000

# Delivery fee and minimum order by price level.
PRICE_LEVEL_FEE = {1: 3000, 2: 5000, 3: 9000}
PRICE_LEVEL_MIN_ORDER = {1: 0, 2: 10000, 3: 20000}
DEFAULT_LEVEL_FEE = 5000
DEFAULT_LEVEL_MIN_ORDER = 0


def delivery_fee(distance_km: Column) -> Column:
    """Base fee plus the distance charge rounded half-even to whole steps, capped."""
    steps = F.bround(distance_km * F.lit(float(FEE_PER_KM)) / F.lit(float(FEE_STEP)), 0)
    # NaN is above all numbers; it counts as missing. Beyond the cap the distance does not matter.
    fee = F.lit(FEE_BASE) + F.least(steps, F.lit(float(FEE_CAP))).try_cast("bigint") * FEE_STEP
    known = distance_km.isNotNull() & ~F.isnan(distance_km.cast("double"))
    return F.when(known, F.least(fee, F.lit(FEE_CAP)).cast("int"))


def floor_at_zero(amount: Column) -> Column:
    """Clip negatives to zero and keep nulls (``greatest`` alone would turn a null into zero)."""
    return F.when(amount < 0, F.lit(0)).otherwise(amount)


def order_total(subtotal: Column, fee: Column, discount: Column) -> Column:
    return (subtotal + fee - discount).cast(MONEY)


def _by_level(level: Column, values: dict[int, int], default: int) -> Column:
    out = F
    for key, value in values.items():
        out = out.when(level == key, value)
    return out.otherwise(default)


def level_fee(level: Column) -> Column:
    return _by_level(level, PRICE_LEVEL_FEE, DEFAULT_LEVEL_FEE)


def level_min_order(level: Column) -> Column:
    return _by_level(level, PRICE_LEVEL_MIN_ORDER, DEFAULT_LEVEL_MIN_ORDER)


def in_thousands(amount: Column) -> Column:
    return amount / F.lit(1_000)


def in_millions(amount: Column) -> Column:
    return amount / F.lit(1_000_000)
