"""Data-quality report: 66 checks over the source tables.

Every column check of a table is part of one aggregation, so a table is scanned once, however many checks it has. The
cross-table checks count rows per key before they join.

``failing`` counts the rows that do not pass (a null does not pass); ``violations`` counts the rows whose value is
really wrong. A check passes when nothing fails, unless it has a condition of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.functions import calendar, money
from platewise.operators.keysets import Relation, orphans, rows_without_parent
from platewise.operators.lookup import hot_keys, lookup
from platewise.operators.reshape import stacked
from platewise.plans.facts import DELIVERED
from platewise.plans.reports import STATUSES
from platewise.plans.warehouse import Sources

# Accepted ranges.
PERIOD = ("2023-01-01", "2024-12-31")
MAX_KM = 15
CROSS_CITY_KM = 100
MEAN_KM = (1, 8)
FEE = (2000, 25000)
DELIVERY_MINUTES = (10, 120)
RATING = (3.5, 5.0)
REVIEW_RATING = (1, 5)

# Columns that must not be null.
CRITICAL_COLUMNS = {
    "orders": ("order_id", "user_id", "driver_id", "merchant_id", "status", "total_amount", "order_time"),
    "users": ("user_id", "full_name", "email", "phone", "lat", "lon"),
    "drivers": ("driver_id", "full_name", "phone", "vehicle_type"),
    "merchants": ("merchant_id", "merchant_name", "lat", "lon"),
    "products": ("product_id", "merchant_id", "product_name", "price"),
    "order_items": ("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
}

# Child column and parent table of every foreign key.
FOREIGN_KEYS = (
    ("orders", "user_id", "users", "user_id"),
    ("orders", "driver_id", "drivers", "driver_id"),
    ("orders", "merchant_id", "merchants", "merchant_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("reviews", "order_id", "orders", "order_id"),
)

PASS, FAIL, WARN = "PASS", "FAIL", "WARN"
COLUMNS = ("section", "check_name", "status", "failing", "violations", "detail")


@dataclass(frozen=True)
class Check:
    """One line of the report, from aggregate expressions over the checked rows.

    ``violations`` is left out where it equals ``failing``. ``detail`` is an aggregate text, or a word to be put after
    the number of violations. ``passed`` is left out where it means that nothing fails.
    """

    section: str
    name: str
    failing: Column
    violations: Column | None = None
    detail: Column | str = "rows"
    passed: Column | None = None
    level: str = "hard"


def _not_passing(condition: Column) -> Column:
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def _wrong(condition: Column) -> Column:
    return F.count_if(~condition)


def _number(col: Column) -> Column:
    return F.coalesce(F.bround(col.cast("decimal(28,6)"), 2).cast("decimal(28,2)").cast("string"), F.lit("none"))


def _range_text(col: Column) -> Column:
    return F.concat(F.lit("min="), _number(F.min(col)), F.lit(" max="), _number(F.max(col)))


def _rule(
    section: str, name: str, condition: Column, detail: Column | str = "rows", within: Column | None = None
) -> Check:
    """Check that ``condition`` holds on every row (or on the rows ``within``)."""
    if within is None:
        return Check(section, name, _not_passing(condition), _wrong(condition), detail)
    scope = F.coalesce(within, F.lit(False))
    failing = F.count_if(scope & ~F.coalesce(condition, F.lit(False)))
    return Check(section, name, failing, F.count_if(scope & ~condition), detail)


def report_lines(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Run all ``checks`` as one aggregation over ``df`` and return one row per check."""
    measures, lines = [], []
    for i, check in enumerate(checks):
        failing = violations = F.col(f"failing_{i}")
        measures.append(check.failing.cast("bigint").alias(f"failing_{i}"))
        if check.violations is not None:
            violations = F.col(f"violations_{i}")
            measures.append(check.violations.cast("bigint").alias(f"violations_{i}"))
        if isinstance(check.detail, str):
            detail = F.concat(violations.cast("string"), F.lit(f" {check.detail}"))
        else:
            detail = F.col(f"detail_{i}")
            measures.append(check.detail.alias(f"detail_{i}"))
        passed = failing == 0
        if check.passed is not None:
            passed = F.col(f"passed_{i}")
            measures.append(check.passed.alias(f"passed_{i}"))
        otherwise = FAIL if check.level == "hard" else WARN
        lines.append(
            F.struct(
                F.lit(check.section).alias("section"),
                F.lit(check.name).alias("check_name"),
                F.when(passed, PASS).otherwise(otherwise).alias("status"),
                failing.alias("failing"),
                violations.alias("violations"),
                detail.alias("detail"),
            )
        )
    return stacked(df.agg(*measures), lines)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_empty(table: str) -> Check:
    rows = F.count(F.lit(1))
    empty = F.when(rows == 0, F.lit(1)).otherwise(0)
    return Check("completeness", f"{table} not empty", empty, detail=F.concat(rows.cast("string"), F.lit(" rows")))


def null_checks(df: DataFrame, table: str) -> list[Check]:
    """Null counts of the critical columns that the table has."""
    checks = []
    for name in CRITICAL_COLUMNS.get(table, ()):
        if name in df.columns:
            nulls = F.count_if(F.col(name).isNull())
            checks.append(Check("nulls", f"{table}.{name} not null", nulls, detail="null values"))
    return checks


def distance_checks(orders: DataFrame) -> list[Check]:
    """Distance rules ignore missing distances; the last one needs all four coordinates."""
    section = "distance"
    present = "distance_km" in orders.columns
    checks = [Check(section, "distance_km present", F.lit(0 if present else 1), detail=F.lit(""))]
    if present:
        km = F.col("distance_km")
        given = km.isNotNull()
        mean = F.try_divide(F.sum(km.try_cast("decimal(28,10)")), F.count(km))
        out_of_range = F.when(mean.between(*MEAN_KM), F.lit(0)).otherwise(1)
        checks += [
            _rule(section, "distance not negative", km >= 0, F.concat(F.lit("min="), _number(F.min(km))), given),
            _rule(section, "distance within radius", km <= MAX_KM, F.concat(F.lit("max="), _number(F.max(km))), given),
            Check(section, "mean distance plausible", out_of_range, detail=F.concat(F.lit("mean="), _number(mean))),
            _rule(section, "no cross-city distance", km <= CROSS_CITY_KM, within=given),
        ]
    points = ("delivery_lat", "delivery_lon", "pickup_lat", "pickup_lon")
    if all(name in orders.columns for name in points):
        same = (F.col(points[0]) == F.col(points[2])) & (F.col(points[1]) == F.col(points[3]))
        count = F.count_if(F.coalesce(same, F.lit(False)))
        checks.append(Check(section, "delivery point differs from pickup", count))
    return checks


def total_mismatch() -> Column:
    """True where the total differs from subtotal + fee - discount, clipped at zero; a null on either side differs."""
    expected = money.floor_at_zero(money.order_total(F.col("subtotal"), F.col("delivery_fee"), F.col("discount")))
    return F.coalesce(F.col("total_amount") != expected, F.lit(True))


def order_money_checks() -> list[Check]:
    section = "money"
    fee, total, subtotal = F.col("delivery_fee"), F.col("total_amount"), F.col("subtotal")
    mismatch = F.count_if(total_mismatch())
    return [
        _rule(section, "delivery fee in range", fee.between(*FEE), _range_text(fee)),
        _rule(section, "total not negative", total >= 0),
        _rule(section, "subtotal positive", subtotal > 0),
        Check(section, "total equals subtotal + fee - discount", mismatch),
    ]


def product_money_checks() -> list[Check]:
    return [_rule("money", "product price positive", F.col("price") > 0)]


def with_order_instant(orders: DataFrame) -> DataFrame:
    """Parse the order time once per row, for all the checks that use it."""
    return orders.withColumn("_ordered_at", calendar.parse_timestamp(F.col("order_time")))


def order_time_checks(start: str = PERIOD[0], end: str = PERIOD[1]) -> list[Check]:
    """Checks over :func:`with_order_instant`.

    ``end`` is an instant (its midnight), so orders later on that day fail.
    """
    section = "time"
    ordered, arrived = F.col("_ordered_at"), F.col("delivered_time")
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    minutes = calendar.minutes_between(ordered, arrived)
    done = F.col("status") == DELIVERED
    cancelled = F.startswith(F.col("status"), F.lit("cancelled"))
    days = F.concat(
        F.lit("min="), F.coalesce(F.to_date(F.min(ordered)).cast("string"), F.lit("none")),
        F.lit(" max="), F.coalesce(F.to_date(F.max(ordered)).cast("string"), F.lit("none")),
    )
    return [
        _rule(section, "order time in period", ordered.between(first, last), days),
        _rule(section, "delivered orders have a delivery time", arrived.isNotNull(), within=done),
        _rule(section, "delivery takes 10 to 120 minutes", minutes.between(*DELIVERY_MINUTES),
              _range_text(F.when(done, minutes)), done),
        _rule(section, "delivered after ordered", arrived > ordered, within=done),
        _rule(section, "cancelled orders have no delivery time", arrived.isNull(), within=cancelled),
    ]


def order_status_checks() -> list[Check]:
    return [_rule("status", "order status known", F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)))]


def rating_check(table: str, column: str, bounds: tuple[float, float]) -> Check:
    value = F.col(column)
    return _rule("status", f"{table} {column} in range", value.between(*bounds), _range_text(value))


def fk_orphans(sources: Sources, skip: Sequence[str] = ()) -> DataFrame:
    """Rows of every foreign key that have no parent, all keys together; ``skip`` names keys that are checked elsewhere."""
    relations = [
        Relation(f"{child}.{key} -> {parent}", getattr(sources, child), key, getattr(sources, parent), parent_key)
        for child, key, parent, parent_key in FOREIGN_KEYS
        if key not in skip
    ]
    checks = [
        Check("references", r.name, F.coalesce(F.max(F.when(F.col("name") == r.name, F.col("orphans"))), F.lit(0)), detail="orphan rows")
        for r in relations
    ]
    return report_lines(orphans(relations), checks)


def city_consistency(sources: Sources) -> DataFrame:
    """Orders whose city differs from that of the merchant, and of the user.

    Both sides follow the row-level left joins: a parent listed twice counts twice, a missing city differs.
    """
    orders = sources.orders.groupBy("user_id", "merchant_id", "city").agg(F.count(F.lit(1)).alias("_rows"))
    users = sources.users.groupBy("user_id", F.col("city").alias("_user_city")).agg(F.count(F.lit(1)).alias("_users"))
    merchants = sources.merchants.groupBy("merchant_id", F.col("city").alias("_merchant_city")).agg(
        F.count(F.lit(1)).alias("_merchants")
    )
    hot_users, hot_merchants = (hot_keys(sources.orders, [key]) for key in ("user_id", "merchant_id"))
    joined = lookup(orders, users, ["user_id"], hot=hot_users)
    joined = lookup(joined, merchants, ["merchant_id"], hot=hot_merchants)
    weight = F.col("_rows") * F.coalesce(F.col("_users"), F.lit(1)) * F.coalesce(F.col("_merchants"), F.lit(1))

    def check(name: str, other: str) -> Check:
        differs = F.coalesce(F.col("city") != F.col(other), F.lit(True))
        n = F.coalesce(F.sum(F.when(differs, weight)), F.lit(0))
        return Check("city", name, n)

    return report_lines(joined, [
        check("order city equals merchant city", "_merchant_city"),
        check("order city equals user city", "_user_city"),
    ])


def subtotal_reconcile(sources: Sources) -> DataFrame:
    """Orders whose subtotal is not the sum of their lines; an order without lines differs."""
    sums = (
        sources.order_items.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.coalesce(F.sum("subtotal"), F.lit(0)).alias("_items"))
    )
    orders = sources.orders.groupBy("order_id", "subtotal").agg(F.count(F.lit(1)).alias("_rows"))
    differs = F.coalesce(F.col("subtotal") != F.col("_items"), F.lit(True))
    n = F.coalesce(F.sum(F.when(differs, F.col("_rows"))), F.lit(0))
    joined = lookup(orders, sums, ["order_id"], hot={})  # both sides are counted by id: no id is hot
    return report_lines(joined, [
        Check("money", "subtotal equals sum of lines", n)
    ])


def order_id_checks(sources: Sources) -> DataFrame:
    """The four checks that meet on the order id, from one count per id over orders, lines and reviews.

    Each table is reduced to its ids first, so a hot or missing id is a row or two of the window.
    """
    n, missing = F.count(F.lit(1)).alias("n"), F.lit(None).cast("decimal(28,2)")
    orders = sources.orders.groupBy("order_id", F.col("subtotal").cast("decimal(28,2)").alias("amount")).agg(
        n, F.count_if(F.col("status") == DELIVERED).alias("done")
    )
    lines = sources.order_items.groupBy("order_id").agg(
        n, F.coalesce(F.sum("subtotal"), F.lit(0)).cast("decimal(28,2)").alias("amount")
    )
    reviews = sources.reviews.groupBy("order_id").agg(n).withColumn("amount", missing)
    parts = [
        df.withColumn("done", F.lit(0).cast("bigint")).withColumn("of", F.lit(name)) for name, df in (("line", lines), ("review", reviews))
    ]
    rows = reduce(DataFrame.unionByName, [orders.withColumn("of", F.lit("order")), *parts])
    same = Window.partitionBy("order_id")
    rows = rows.select(
        "of",
        "n",
        "amount",
        (F.col("order_id").isNotNull() & (F.count_if(F.col("of") == "order").over(same) > 0)).alias("known"),
        (F.col("order_id").isNotNull() & (F.sum("done").over(same) > 0)).alias("delivered"),
        F.when(F.col("order_id").isNotNull(), F.sum(F.when(F.col("of") == "line", F.col("amount"))).over(same)).alias("items"),
    )

    def failing(of: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("of") == of) & condition, F.col("n"))), F.lit(0))

    differs = F.coalesce(F.col("amount") != F.col("items"), F.lit(True))
    return report_lines(rows, [
        Check("references", "order_items.order_id -> orders", failing("line", ~F.col("known")), detail="orphan rows"),
        Check("references", "reviews.order_id -> orders", failing("review", ~F.col("known")), detail="orphan rows"),
        Check("money", "subtotal equals sum of lines", failing("order", differs)),
        Check("status", "reviews only of delivered orders", failing("review", ~F.col("delivered"))),
    ])


def total_reconcile(orders: DataFrame) -> DataFrame:
    return report_lines(orders, [c for c in order_money_checks() if c.name.startswith("total equals")])


def reviews_not_delivered(sources: Sources) -> DataFrame:
    done = sources.orders.where(F.col("status") == DELIVERED)
    n = F.max("orphans")
    return report_lines(rows_without_parent(sources.reviews, "order_id", done, "order_id"), [
        Check("status", "reviews only of delivered orders", n)
    ])


def dq_row_counts(sources: Sources) -> DataFrame:
    tables = ("orders", "users", "drivers", "merchants", "products", "order_items")
    return _union([report_lines(getattr(sources, t), [not_empty(t)]) for t in tables])


def dq_nulls(sources: Sources) -> DataFrame:
    tables = [getattr(sources, t) for t in CRITICAL_COLUMNS]
    return _union([report_lines(df, null_checks(df, t)) for t, df in zip(CRITICAL_COLUMNS, tables, strict=True)])


def dq_distance(sources: Sources) -> DataFrame:
    return report_lines(sources.orders, distance_checks(sources.orders))


def dq_money(sources: Sources) -> DataFrame:
    return _union([
        report_lines(sources.products, product_money_checks()),
        report_lines(sources.orders, order_money_checks()),
        subtotal_reconcile(sources),
    ])


def dq_time(sources: Sources, start: str = PERIOD[0], end: str = PERIOD[1]) -> DataFrame:
    return report_lines(with_order_instant(sources.orders), order_time_checks(start, end))


def dq_ratings(sources: Sources) -> DataFrame:
    return _union([
        report_lines(sources.orders, order_status_checks()),
        report_lines(sources.merchants, [rating_check("merchants", "rating", RATING)]),
        report_lines(sources.drivers, [rating_check("drivers", "rating", RATING)]),
        report_lines(sources.reviews, [rating_check("reviews", "merchant_rating", REVIEW_RATING)]),
        reviews_not_delivered(sources),
    ])


def dq_report(sources: Sources, start: str = PERIOD[0], end: str = PERIOD[1]) -> DataFrame:
    """All checks: one aggregation per table, one over the order ids of three tables, plus the other cross-table checks."""
    s = sources
    order_checks = [
        *distance_checks(s.orders), *order_money_checks(), *order_time_checks(start, end), *order_status_checks()
    ]
    per_table = {
        "orders": (with_order_instant(s.orders), order_checks),
        "users": (s.users, []),
        "drivers": (s.drivers, [rating_check("drivers", "rating", RATING)]),
        "merchants": (s.merchants, [rating_check("merchants", "rating", RATING)]),
        "products": (s.products, product_money_checks()),
        "order_items": (s.order_items, []),
    }
    parts = [
        report_lines(df, [not_empty(table), *checks, *null_checks(df, table)])
        for table, (df, checks) in per_table.items()
    ]
    parts += [
        report_lines(s.reviews, [rating_check("reviews", "merchant_rating", REVIEW_RATING)]),
        fk_orphans(s, skip=("order_id",)),
        city_consistency(s),
        order_id_checks(s),
    ]
    return _union(parts)


def dq_summary(report: DataFrame) -> DataFrame:
    """Number of checks by outcome."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, minimum, maximum and mean of numeric columns, from one aggregation."""
    measures, lines = [], []
    for name in columns:
        value = F.col(name)
        exact = value.try_cast("decimal(28,10)")
        measures += [
            F.count(value).alias(f"{name}__n"),
            F.count_if(value.isNull()).alias(f"{name}__nulls"),
            F.min(value).cast("double").alias(f"{name}__min"),
            F.max(value).cast("double").alias(f"{name}__max"),
            F.try_divide(F.sum(exact), F.count(exact)).cast("double").alias(f"{name}__mean"),
        ]
        lines.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"{name}__n").alias("n_values"),
                F.col(f"{name}__nulls").alias("n_nulls"),
                F.col(f"{name}__min").alias("min_value"),
                F.col(f"{name}__max").alias("max_value"),
                F.col(f"{name}__mean").alias("mean_value"),
            )
        )
    return stacked(df.agg(*measures), lines)
