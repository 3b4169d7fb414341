"""Report data sets over the star schema.

Facts are reduced to their group keys before any dimension is joined, so what is shuffled is the number of groups, not
the number of orders, and no hot merchant, user or day reaches a join as more than one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.functions import calendar, geo, money, people, weather
from platewise.operators import reshape
from platewise.operators.impute import attach_group_value
from platewise.operators.quantiles import counted, quantile_table
from platewise.plans.facts import DELIVERED
from platewise.workspace import materialise

TOP_MERCHANTS = 15
COMPARED_CITIES = ("jakarta", "medan")
STATUSES = ("delivered", "cancelled_by_customer", "cancelled_by_driver")
DAY_TYPES = ("Weekday", "Weekend")

_WHISKER = 1.5
_MARKER_SCALE = 200
_MARKER_BASE = 20


def delivered(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("order_status") == DELIVERED)


def known_weather(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("kondisi_cuaca") != weather.UNKNOWN)


def merchant_revenue(facts: DataFrame) -> DataFrame:
    return (
        delivered(facts)
        .where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.coalesce(F.sum("total_amount"), F.lit(0)).cast("decimal(28,2)").alias("total_revenue"))
    )


def top_merchants(facts: DataFrame, dim_merchant: DataFrame, n: int = TOP_MERCHANTS) -> DataFrame:
    names = dim_merchant.select("merchant_id", "merchant_name", "merchant_category", "city")
    ranked = merchant_revenue(facts).join(names, "merchant_id").orderBy(F.desc("total_revenue"), "merchant_id")
    return ranked.limit(n).withColumn("revenue_millions", money.in_millions(F.col("total_revenue")).cast("double"))


def merchant_map(facts: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Every merchant with coordinates, revenue (0 without orders) and a marker size relative to its city's best."""
    rows = dim_merchant.select(
        "merchant_id", "merchant_name", "city", "merchant_lat", "merchant_lon"
    ).join(merchant_revenue(facts), "merchant_id", "left")
    rows = rows.withColumn("revenue", F.coalesce(F.col("total_revenue"), F.lit(0)).cast("decimal(28,2)"))
    rows = materialise(rows.drop("total_revenue"), "merchant-revenue")  # read twice: for the cities' best and for the rows
    best = rows.groupBy("city").agg(F.max("revenue").alias("_best"))
    share = F.try_divide(F.col("revenue").cast("double"), F.col("_best").cast("double"))
    return attach_group_value(rows, best, "city").select(
        "merchant_id",
        "merchant_name",
        "city",
        geo.city_label(F.col("city")).alias("city_label"),
        "merchant_lat",
        "merchant_lon",
        "revenue",
        (share * F.lit(float(_MARKER_SCALE)) + F.lit(float(_MARKER_BASE))).alias("marker_size"),
    )


def weekday_basket(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Mean delivered basket per weekday and day type, Monday first. The day type is the fact's own flag."""
    per_day = delivered(facts).groupBy("date_id", "is_weekend").agg(
        F.sum("total_amount").alias("_sum"), F.count("total_amount").alias("_n")
    )
    named = per_day.join(dim_date.select("date_id", "day_name"), "date_id").withColumn(
        "day_type", calendar.day_type(F.col("is_weekend"))
    )
    mean = F.try_divide(F.sum("_sum").cast("double"), F.sum("_n"))
    return (
        named.dropna(subset=["day_name", "day_type"])
        .groupBy("day_name", "day_type")
        .agg(mean.alias("avg_amount"))
        .select(
            calendar.weekday_rank(F.col("day_name")).alias("day_rank"),
            "day_name",
            "day_type",
            "avg_amount",
            money.in_thousands(F.col("avg_amount")).alias("avg_thousands"),
        )
        .orderBy("day_rank", "day_type")
    )


def _delivered_amounts(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Delivered orders on known days with their day type.

    The list of days is bounded by the calendar (366 small integers a year), so it is broadcast and no order moves.
    """
    rows = delivered(facts).select("date_id", "is_weekend", "total_amount")
    days = F.broadcast(dim_date.select("date_id"))
    return rows.join(days, "date_id", "left_semi").select(
        calendar.day_type(F.col("is_weekend")).alias("day_type"), "total_amount"
    )


def weekend_stats(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Mean, exact median and count of the delivered basket per day type, all from one table of counted amounts."""
    counts = counted(_delivered_amounts(facts, dim_date), "day_type", "total_amount")
    total = F.sum(F.col("unit").cast("decimal(28,0)") * F.col("n")) / F.lit(100)
    means = counts.groupBy("group").agg(F.try_divide(total.cast("double"), F.sum("n")).alias("mean_amount"), F.sum("n").alias("n_orders"))
    return means.join(quantile_table(counts, {"median_amount": 0.5}), "group").withColumnRenamed("group", "day_type")


def weekend_boxplot(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Quartiles, whiskers (furthest amounts within 1.5 IQR of the box) and outlier counts per day type."""
    counts = counted(_delivered_amounts(facts, dim_date), "day_type", "total_amount")
    return box_plot(counts).withColumnRenamed("group", "day_type")


def box_plot(counts: DataFrame) -> DataFrame:
    """One row per group of counted amounts (in hundredths)."""
    box = quantile_table(counts, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = F.lit(_WHISKER) * (F.col("q3") - F.col("q1"))
    amount = (F.col("unit").cast("decimal(28,0)") / F.lit(100)).cast("double")
    inside = (amount >= F.col("q1") - reach) & (amount <= F.col("q3") + reach)
    return (
        counts.join(box, "group")
        .groupBy("group", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, amount)).alias("whisker_low"),
            F.max(F.when(inside, amount)).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("n_outliers"),
        )
    )


def category_share_by_age(fact_items: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Share of delivered order lines per food category within each age group, in percent."""
    per_user = (
        delivered(fact_items)
        .dropna(subset=["user_id", "product_category"])
        .groupBy("user_id", "product_category")
        .agg(F.count(F.lit(1)).alias("_lines"))
    )
    counted = (
        per_user.join(dim_user.select("user_id", "age_group"), "user_id")
        .groupBy("age_group", "product_category")
        .agg(F.sum("_lines").cast("bigint").alias("n_lines"))
    )
    return reshape.share_of_group(counted, "age_group", "n_lines")


def category_share_by_age_pivot(
    fact_items: DataFrame, dim_user: DataFrame, categories: Sequence[str]
) -> DataFrame:
    """Age groups in display order (absent ones as 0) by category; ``other`` holds the categories without a column."""
    names = {c: c for c in categories}
    shares = category_share_by_age(fact_items, dim_user)
    wide = reshape.widen(shares, "age_group", "product_category", "pct", names, rest="other")
    groups = [name for name, _ in people.AGE_GROUPS]
    return reshape.on_domain(wide, "age_group", groups, [*categories, "other"]).orderBy("position")


def orders_by_hour(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Orders of every status per hour and day type, on days of the date dimension.

    An inner join on the unique days, not a semi-join: the optimizer would move that one below the count.
    """
    counts = facts.groupBy("date_id", "order_hour", "is_weekend").agg(F.count(F.lit(1)).alias("_n"))
    known = counts.join(dim_date.select("date_id"), "date_id")
    return (
        known.withColumn("day_type", calendar.day_type(F.col("is_weekend")))
        .dropna(subset=["order_hour", "day_type"])
        .groupBy("order_hour", "day_type")
        .agg(F.sum("_n").cast("bigint").alias("n_orders"))
        .orderBy("day_type", "order_hour")
    )


def peak_hour(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The busiest (hour, day type); the earliest hour wins a tie."""
    busiest = orders_by_hour(facts, dim_date).orderBy(F.desc("n_orders"), "order_hour", "day_type").limit(1)
    return busiest.withColumn("hour_label", calendar.hour_label(F.col("order_hour")))


def weather_volume(facts: DataFrame) -> DataFrame:
    """Orders, mean amount and revenue per weather class, all statuses."""
    mean = F.try_divide(F.sum("total_amount").cast("double"), F.count("total_amount"))
    return (
        known_weather(facts)
        .groupBy("kondisi_cuaca")
        .agg(
            F.count("order_id").alias("n_orders"),
            mean.alias("avg_amount"),
            F.coalesce(F.sum("total_amount"), F.lit(0)).cast("decimal(28,2)").alias("total_revenue"),
        )
        .orderBy(F.desc("n_orders"), "kondisi_cuaca")
    )


def weather_hours(facts: DataFrame) -> DataFrame:
    """Share of each hour within a weather class, long form."""
    counts = (
        known_weather(facts)
        .where(F.col("order_hour").isNotNull())
        .groupBy("kondisi_cuaca", "order_hour")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return reshape.share_of_group(counts, "kondisi_cuaca", "n_orders")


def weather_hour_heatmap(facts: DataFrame) -> DataFrame:
    """One row per weather class, one percentage column per hour (``h00`` .. ``h23``)."""
    names = {hour: f"h{hour:02d}" for hour in range(24)}
    return reshape.widen(weather_hours(facts), "kondisi_cuaca", "order_hour", "pct", names)


def weather_status_share(facts: DataFrame) -> DataFrame:
    """Percentage of each shown status per weather class; the denominator holds every status."""
    counts = (
        known_weather(facts)
        .where(F.col("order_status").isNotNull())
        .groupBy("kondisi_cuaca", "order_status")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    shares = reshape.share_of_group(counts, "kondisi_cuaca", "n_orders")
    return reshape.widen(shares, "kondisi_cuaca", "order_status", "pct", {s: s for s in STATUSES})


def avg_daily_orders(facts: DataFrame, cities: Sequence[str] = COMPARED_CITIES) -> DataFrame:
    """Mean orders per day by city and weather; only days that have orders count."""
    daily = (
        known_weather(facts)
        .where(F.col("city").isin(*cities))
        .groupBy("city", "kondisi_cuaca", calendar.date_from_id(F.col("date_id")).alias("date"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return daily.groupBy("city", "kondisi_cuaca").agg(F.avg("n_orders").alias("avg_orders"))


def avg_daily_orders_pivot(facts: DataFrame, cities: Sequence[str] = COMPARED_CITIES) -> DataFrame:
    names = {city: city for city in cities}
    return reshape.widen(avg_daily_orders(facts, cities), "kondisi_cuaca", "city", "avg_orders", names)


def city_revenue(facts: DataFrame, cities: Sequence[str] = tuple(geo.CITY_LABELS)) -> DataFrame:
    """Delivered revenue per city: total, and mean over the days that have deliveries."""
    daily = (
        delivered(facts)
        .where(F.col("city").isin(*cities))
        .groupBy("city", calendar.date_from_id(F.col("date_id")).alias("date"))
        .agg(F.coalesce(F.sum("total_amount"), F.lit(0)).alias("_day"))
    )
    total = F.sum("_day").cast("decimal(28,2)")
    return (
        daily.groupBy("city")
        .agg(
            total.alias("total_revenue"),
            F.try_divide(total.cast("double"), F.count("_day")).alias("avg_daily_revenue"),
        )
        .withColumn("total_millions", money.in_millions(F.col("total_revenue")).cast("double"))
        .orderBy(F.desc("total_revenue"), "city")
    )


def completion_summary(facts: DataFrame) -> DataFrame:
    """Orders, delivered share in percent, and revenue of delivered orders."""
    done = F.col("order_status") == DELIVERED
    n, n_done = F.count(F.lit(1)), F.count_if(done)
    return facts.agg(
        n.alias("n_orders"),
        n_done.alias("n_delivered"),
        F.try_divide(n_done * F.lit(100.0), n).alias("delivered_pct"),
        F.coalesce(F.sum(F.when(done, F.col("total_amount"))), F.lit(0)).cast("decimal(28,2)").alias(
            "delivered_revenue"
        ),
    )


def executive_summary(
    facts: DataFrame, dim_merchant: DataFrame, dim_user: DataFrame, dim_weather: DataFrame
) -> DataFrame:
    """Row counts and the span of the weather data, as one row of scalar subqueries."""
    rows = F.count(F.lit(1))
    return dim_weather.agg(F.min("waktu").alias("weather_from"), F.max("waktu").alias("weather_to")).select(
        facts.agg(rows).scalar().alias("n_orders"),
        dim_merchant.agg(rows).scalar().alias("n_merchants"),
        dim_user.agg(rows).scalar().alias("n_users"),
        "weather_from",
        "weather_to",
    )
