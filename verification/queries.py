"""One query per operator, over the staging views of a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.functions import calendar, geo, money, people, text, weather
from platewise.operators import impute
from platewise.operators.dedup import keep_first
from platewise.operators.lookup import hot_keys
from platewise.plans import catalogue, clean, dims, facts, quality, reports, warehouse
from platewise.plans import weather as weather_plans
from platewise.sources import readers, schemas, writers
from platewise.sources.staging import stage
from platewise.sources.store import Store
from platewise.workspace import new_path

AS_OF = "2020-06-30"
PERIOD = ("1995-01-01", "2001-06-30")
LOADED_AT = "2024-01-01 00:00:00"
CATEGORIES = ("Padang", "Pizza", "Seafood")
# The fixed-date national holidays, for the years of the given orders.
HOLIDAYS = tuple(f"{year}-{day}" for year in range(1995, 2002) for day in ("01-01", "05-01", "08-17", "12-25"))

Query = Callable[[SparkSession, str], DataFrame]


class Data:
    """Staging views of one folder, and the warehouse built from them once per session."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def view(self, name: str) -> DataFrame:
        return stage(self.spark, self.folder, name)

    @cached_property
    def sources(self) -> warehouse.Sources:
        names = ("users", "drivers", "merchants", "products", "orders", "order_items", "reviews", "weather_readings")
        return warehouse.Sources(**{name: self.view(name) for name in names})

    @cached_property
    def warehouse(self) -> dict[str, DataFrame]:
        return warehouse.build_warehouse(self.sources, as_of(), self.store.folder, loaded_at=LOADED_AT)

    @cached_property
    def store(self) -> Store:
        return Store(self.spark, new_path(self.spark, "warehouse"))


_DATA: dict[tuple[str, str], Data] = {}


def data(spark: SparkSession, folder: str) -> Data:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _DATA:
        _DATA[key] = Data(spark, folder)
    return _DATA[key]


def as_of():
    return F.lit(AS_OF).cast("date")


def _source(build: Callable[[warehouse.Sources], DataFrame]) -> Query:
    return lambda spark, folder: build(data(spark, folder).sources)


def _view(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(data(spark, folder).view(name))


def _report(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: build(data(spark, folder).warehouse)


# ---------------------------------------------------------------- sources


def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The sampled rows of every source and warehouse table, all columns in one text."""
    d = data(spark, folder)
    tables = {name: getattr(d.sources, name) for name in schemas.SOURCE_TABLES} | {t: d.warehouse[t] for t in warehouse.TABLES}
    out = None
    for name, sample in readers.sample_rows(tables, schemas.PRIMARY_KEYS).items():
        part = sample.select(F.lit(name).alias("table_name"), row_text(sample).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def row_text(df: DataFrame) -> Column:
    """All columns, by name, as text; numbers with a fraction in ten-thousandths, so that no engine's way to print them matters."""
    fields = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        value = F.col(field.name)
        if field.dataType.typeName() in ("double", "float", "decimal"):
            value = F.round(value.cast("double") * 10000).cast("bigint")
        fields.append(F.concat(F.lit(f"{field.name}="), F.coalesce(value.cast("string"), F.lit("~"))))
    return F.concat_ws("|", *fields)


def clean_audit(d: dict[str, DataFrame], s: warehouse.Sources) -> DataFrame:
    """The cleaning steps of the daily job, as it has written them down."""
    return d[warehouse.AUDIT].where("run = 1").drop("run", "loaded_at")


def fact_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Clean lines with their orders, both read from their buckets."""
    d = data(spark, folder)
    d.warehouse  # the buckets are written by the daily job
    ordinary, hot = facts.fact_order_items_in_place(d.store.bucketed(warehouse.LINES), d.store.bucketed("fact_orders"))
    return ordinary if hot is None else ordinary.unionByName(hot)


# ---------------------------------------------------------------- rows


def dedup_keep_first(s: warehouse.Sources) -> DataFrame:
    return rounded_coordinates(keep_first(s.users, ["user_id"]))


def rounded_coordinates(df: DataFrame) -> DataFrame:
    return df.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


def fill_constants(s: warehouse.Sources) -> DataFrame:
    orders = impute.fill_constants(s.orders, {"discount": 0}).select(
        F.lit("orders").alias("table_name"), F.col("order_id").alias("id"), F.col("discount").cast("double").alias("value")
    )
    drivers = impute.fill_constants(s.drivers, {"total_trips": 0, "is_active": 1}).select(
        F.lit("drivers").alias("table_name"),
        F.col("driver_id").alias("id"),
        (F.col("total_trips") * 10 + F.col("is_active")).cast("double").alias("value"),
    )
    return orders.unionByName(drivers)


def impute_mode_by_group(s: warehouse.Sources) -> DataFrame:
    orders = s.orders.select("order_id", "city", "payment_method")
    return impute.fill_by_group(orders, "city", modes={"payment_method": "cash"})


def impute_mode_global(s: warehouse.Sources) -> DataFrame:
    return impute.fill_global_mode(s.drivers.select("driver_id", "vehicle_type"), "vehicle_type", "motor")


def impute_mean_by_group(s: warehouse.Sources) -> DataFrame:
    orders = s.orders.select("order_id", "merchant_id", "subtotal")
    return impute.fill_by_group(orders, "merchant_id", means={"subtotal": 2})


def coerce_timestamp(s: warehouse.Sources) -> DataFrame:
    return clean.coerce_order_time(s.orders.select("order_id", "order_time"))


def city_labels(s: warehouse.Sources) -> DataFrame:
    return s.users.groupBy("city").agg(F.count(F.lit(1)).alias("n_users")).withColumn(
        "city_label", geo.city_label(F.col("city"))
    )


def order_flags(s: warehouse.Sources) -> DataFrame:
    status = F.col("status")
    return s.orders.select(
        "order_id", facts.is_delivered(status).alias("is_delivered"), facts.is_cancelled(status).alias("is_cancelled")
    )


def delivery_duration(s: warehouse.Sources) -> DataFrame:
    minutes = calendar.minutes_between(calendar.parse_timestamp(F.col("order_time")), F.col("delivered_time"))
    return reports.delivered(s.orders.withColumnRenamed("status", "order_status")).select(
        "order_id", F.round(minutes, 4).alias("minutes")
    )


def haversine_km(s: warehouse.Sources) -> DataFrame:
    points = [F.col(c) for c in ("pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon")]
    return s.orders.select("order_id", F.round(geo.haversine_km(*points), 6).alias("km"))


def delivery_fee(s: warehouse.Sources) -> DataFrame:
    return s.orders.select("order_id", money.delivery_fee(F.col("distance_km")).alias("fee"))


# ---------------------------------------------------------------- weather


def weather_humidity(s: warehouse.Sources) -> DataFrame:
    rh = weather.relative_humidity(F.col("temp_k"), F.col("dewpoint_k"))
    return s.weather_readings.select("city", "time", F.round(rh, 6).alias("humidity"))


def weather_classify(s: warehouse.Sources) -> DataFrame:
    rh = weather.relative_humidity(F.col("temp_k"), F.col("dewpoint_k"))
    return s.weather_readings.select(
        "city", "time", weather.classify(F.col("temp_k"), F.col("rain"), rh).alias("cuaca")
    )


def weather_by_place(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather from readings that have coordinates and no city."""
    points = data(spark, folder).view("weather_points")
    return weather_plans.hourly_weather(readers.readings_at(points, readers.city_points(spark)))


def weather_lookup_join(d: dict[str, DataFrame], s: warehouse.Sources) -> DataFrame:
    orders = clean.coerce_order_time(s.orders.select("order_id", "city", "order_time"))
    hot = hot_keys(weather_plans.order_hours(orders), ["city", "waktu"])
    return weather_plans.with_weather(orders, d["dim_weather"], hot=hot).drop("order_time", "city")


def weather_unmatched(d: dict[str, DataFrame], s: warehouse.Sources) -> DataFrame:
    return weather_plans.unmatched_orders(clean.coerce_order_time(s.orders), d["dim_weather"])


def _with_warehouse(build) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        d = data(spark, folder)
        return build(d.warehouse, d.sources)

    return run


# ---------------------------------------------------------------- catalogue


def parse_ratings(raw: DataFrame) -> DataFrame:
    average, total = text.rating_fields(F.col("ratings"))
    return raw.select("uid", average.alias("rating"), total.alias("total_reviews"))


def price_level_terms(raw: DataFrame) -> DataFrame:
    level = text.cast_or(F.col("priceLevel"), "int", 1)
    return raw.select(
        "uid",
        level.alias("price_level"),
        money.level_fee(level).alias("fee"),
        money.level_min_order(level).alias("min_order"),
    )


def catalogue_keys(raw: DataFrame) -> DataFrame:
    return catalogue.with_merchant_key(raw).select("product", "merchant_id", "merchant_name", "merchant_area")


def basket_lines(lines: DataFrame) -> tuple[DataFrame, str, str, str]:
    columns = ("transaction_id", "product_id", "product_name")
    return (lines.select(*columns).distinct(), *columns)


def standardise_city(lines: DataFrame) -> DataFrame:
    return clean.standardise_city(lines.select("transaction_id", "product_id", "customer_id", "city"))


def older_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by city and load time of the older warehouse's tables, loaded in one step."""
    d = data(spark, folder)
    tables = {
        "dim_merchant": d.view("merchants"),
        "dim_product": d.view("products").withColumn("city", F.lit(None).cast("string")),
        "dim_customer": d.view("users"),
        "dim_driver": d.view("drivers"),
        "dim_time": d.view("orders").select(F.lit(None).cast("string").alias("city"), "order_time").distinct(),
        "fact_transaction": d.view("transactions"),
    }
    parts = [
        df.groupBy(F.lit(name).alias("table_name"), "city", "dwh_load_time").agg(F.count(F.lit(1)).alias("n_rows"))
        for name, df in clean.clean_older_tables(tables, LOADED_AT).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers written as CSV and read back with their declared types."""
    drivers, path = data(spark, folder).view("drivers"), new_path(spark, "drivers-csv")
    writers.write_csv(drivers, path)
    return readers.read_csv(spark, path, drivers.schema)


def reload_table(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers reloaded from a CSV file into a table that has its own columns and types."""
    drivers, path = data(spark, folder).view("drivers"), new_path(spark, "drivers-csv")
    writers.write_csv(drivers, path)
    store = Store(spark, new_path(spark, "store"))
    own = drivers.select("total_trips", F.col("driver_id").cast("string").alias("driver_id"), F.col("rating").cast("decimal(3,1)").alias("rating"))
    store.commit({"drivers": store.write("drivers", own.withColumn("total_trips", F.lit(-1).cast("bigint")))})
    writers.reload_from_csv(store, path, drivers.schema, "drivers")
    return store.read("drivers")


def replaced_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Months of the order fact, and whether a second load has written them again: those whose rows it finds changed."""
    facts_now = data(spark, folder).warehouse["fact_orders"].withColumn("month", F.expr("date_id div 100").cast("int"))
    late = (F.col("city") == "medan") & (F.col("date_id") % 100 == 31) & (F.col("order_hour") >= 22)
    store = Store(spark, new_path(spark, "store"))
    first = store.write_parts("fact_orders", facts_now.withColumn("is_delivered", F.when(late, -1).otherwise(F.col("is_delivered"))), "month")
    store.commit({"fact_orders": first})
    second = store.write_parts("fact_orders", facts_now, "month")
    store.commit({"fact_orders": second})
    flags = [(int(month), int(part != first.parts.get(month))) for month, part in second.parts.items()]  # one row for each month
    rewritten = spark.createDataFrame(flags, "month int, rewritten int")
    rows = store.read("fact_orders").groupBy("month").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("is_delivered").alias("n_delivered"))
    return rows.join(rewritten, "month")


def dropped_lines(d: dict[str, DataFrame], s: warehouse.Sources) -> DataFrame:
    return facts.lines_without_order(clean.clean_order_items(s.order_items), d["fact_orders"])


# ---------------------------------------------------------------- reports


def _rounded(df: DataFrame, scale: int = 4) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({name: F.round(name, scale) for name in doubles})


def weekend_stats(w: dict[str, DataFrame]) -> DataFrame:
    return _rounded(reports.weekend_stats(w["fact_orders"], w["dim_date"]))


# Whole numbers that can be missing in a result.
OPTIONAL_INTS = {
    "reload_table": ("total_trips",),
    "dedup_keep_first": ("is_active",),
    "delivery_fee": ("fee",),
    "parse_ratings": ("total_reviews",),
    "catalogue_v1": ("total_reviews",),
}


def _portable(name: str, query: Query) -> Query:
    """Amounts and optional whole numbers as doubles and dates as ISO text, so that a comparison does not depend on how
    a client maps them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = query(spark, folder)
        kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
        targets = {"decimal": "double", "date": "string"}
        casts = {n: targets[k] for n, k in kinds.items() if k in targets}
        casts |= {n: "double" for n in OPTIONAL_INTS.get(name, ())}
        return df.withColumns({n: F.col(n).cast(kind) for n, kind in casts.items()})

    return run


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return {name: _portable(name, query) for name, query in _registered().items()}


def _registered() -> dict[str, Query]:
    return {
        # sources and audit
        "sample_rows": sample_rows,
        "weather_date_range": _source(lambda s: readers.order_date_range(s.orders)),
        "month_ranges": _source(lambda s: readers.month_ranges(readers.order_date_range(s.orders))),
        "clean_audit": _with_warehouse(clean_audit),
        # rows
        "drop_null_keys": _source(lambda s: clean.drop_null_keys(s.orders, clean.REQUIRED["orders"]).select("order_id")),
        "coerce_timestamp": _source(coerce_timestamp),
        "fill_constants": _source(fill_constants),
        "city_labels": _source(city_labels),
        "dedup_keep_first": _source(dedup_keep_first),
        "impute_mode_by_group": _source(impute_mode_by_group),
        "impute_mode_global": _source(impute_mode_global),
        "impute_mean_by_group": _source(impute_mean_by_group),
        "order_flags": _source(order_flags),
        "delivery_duration": _source(delivery_duration),
        "haversine_km": _source(haversine_km),
        "delivery_fee": _source(delivery_fee),
        # cleaning
        "clean_users": _source(lambda s: rounded_coordinates(clean.clean_users(s.users))),
        "clean_orders": _source(lambda s: clean.clean_orders(s.orders)),
        "clean_order_items": _source(lambda s: clean.clean_order_items(s.order_items)),
        "clean_drivers": _source(lambda s: clean.clean_drivers(s.drivers)),
        "clean_merchants": _source(lambda s: clean.clean_merchants(s.merchants)),
        "clean_products": _source(lambda s: clean.clean_products(s.products)),
        "clean_transactions": _view("transactions", lambda t: clean.clean_transactions(t, LOADED_AT)),
        "standardise_city": _view("transactions", standardise_city),
        "older_tables": older_tables,
        "csv_round_trip": csv_round_trip,
        "reload_table": reload_table,
        "replaced_parts": replaced_parts,
        "dropped_lines": _with_warehouse(dropped_lines),
        # weather
        "weather_humidity": _source(weather_humidity),
        "weather_classify": _source(weather_classify),
        "hourly_weather": _source(warehouse.weather_for),
        "weather_by_place": weather_by_place,
        "dim_weather": _source(lambda s: weather_plans.dim_weather(warehouse.weather_for(s))),
        "weather_lookup_join": _with_warehouse(weather_lookup_join),
        "weather_unmatched": _with_warehouse(weather_unmatched),
        # dimensions and facts
        "dim_date": _source(lambda s: dims.dim_date(s.orders)),
        "dim_user": _source(lambda s: _rounded(dims.dim_user(clean.clean_users(s.users), as_of()), 6)),
        "dim_driver": _source(lambda s: dims.dim_driver(clean.clean_drivers(s.drivers))),
        "dim_merchant": _source(lambda s: dims.dim_merchant(clean.clean_merchants(s.merchants), s.reviews)),
        "merchant_review_avg": _source(lambda s: dims.merchant_review_avg(s.reviews)),
        "dim_product": _source(lambda s: dims.dim_product(clean.clean_products(s.products))),
        "dim_time_calendar": _source(lambda s: dims.dim_time(readers.order_date_range(s.orders), HOLIDAYS)),
        "fact_orders": _with_warehouse(lambda w, s: facts.fact_orders(clean.clean_orders(s.orders), w["dim_weather"])),
        "fact_order_items": fact_order_items,
        # reports
        "top_merchants": _report(lambda w: _rounded(reports.top_merchants(w["fact_orders"], w["dim_merchant"]), 6)),
        "weekday_basket": _report(lambda w: _rounded(reports.weekday_basket(w["fact_orders"], w["dim_date"]))),
        "weekend_stats": _report(weekend_stats),
        "weekend_boxplot": _report(lambda w: _rounded(reports.weekend_boxplot(w["fact_orders"], w["dim_date"]))),
        "category_share_by_age": _report(
            lambda w: _rounded(reports.category_share_by_age(w["fact_order_items"], w["dim_user"]))
        ),
        "category_share_by_age_pivot": _report(
            lambda w: _rounded(reports.category_share_by_age_pivot(w["fact_order_items"], w["dim_user"], CATEGORIES))
        ),
        "merchant_map": _report(lambda w: _rounded(reports.merchant_map(w["fact_orders"], w["dim_merchant"]))),
        "orders_by_hour": _report(lambda w: reports.orders_by_hour(w["fact_orders"], w["dim_date"])),
        "peak_hour": _report(lambda w: reports.peak_hour(w["fact_orders"], w["dim_date"])),
        "weather_volume": _report(lambda w: _rounded(reports.weather_volume(w["fact_orders"]))),
        "weather_hour_heatmap": _report(lambda w: _rounded(reports.weather_hour_heatmap(w["fact_orders"]))),
        "weather_status_share": _report(lambda w: _rounded(reports.weather_status_share(w["fact_orders"]))),
        "avg_daily_orders": _report(lambda w: _rounded(reports.avg_daily_orders(w["fact_orders"]))),
        "avg_daily_orders_pivot": _report(lambda w: _rounded(reports.avg_daily_orders_pivot(w["fact_orders"]))),
        "city_revenue": _report(lambda w: _rounded(reports.city_revenue(w["fact_orders"]))),
        "completion_summary": _report(lambda w: _rounded(reports.completion_summary(w["fact_orders"]))),
        "executive_summary": _report(
            lambda w: reports.executive_summary(w["fact_orders"], w["dim_merchant"], w["dim_user"], w["dim_weather"])
        ),
        # quality
        "dq_row_counts": _source(quality.dq_row_counts),
        "fk_orphans": _source(quality.fk_orphans),
        "dq_distance": _source(quality.dq_distance),
        "city_consistency": _source(quality.city_consistency),
        "dq_money": _source(quality.dq_money),
        "subtotal_reconcile": _source(quality.subtotal_reconcile),
        "total_reconcile": _source(lambda s: quality.total_reconcile(s.orders)),
        "dq_time": _source(lambda s: quality.dq_time(s, *PERIOD)),
        "dq_ratings": _source(quality.dq_ratings),
        "reviews_not_delivered": _source(quality.reviews_not_delivered),
        "dq_nulls": _source(quality.dq_nulls),
        "dq_report": _source(lambda s: quality.dq_report(s, *PERIOD)),
        "dq_summary": _source(lambda s: quality.dq_summary(quality.dq_report(s, *PERIOD))),
        "column_profile": _source(
            lambda s: _rounded(quality.column_profile(s.orders, ["total_amount", "delivery_fee", "distance_km"]))
        ),
        # catalogue and baskets
        "area_to_city": _view(
            "catalogue_v2", lambda c: c.select("product", geo.area_to_city(F.col("merchant_area")).alias("city"))
        ),
        "normalise_category": _view(
            "catalogue_v2", lambda c: c.select("product", text.product_category(F.col("category")).alias("category"))
        ),
        "category_profile": _view(
            "catalogue_v2", lambda c: catalogue.category_profile(catalogue.catalogue_products(c))
        ),
        "catalogue_keys": _view("catalogue_v2", catalogue_keys),
        "catalogue_merchants": _view("catalogue_v2", catalogue.catalogue_merchants),
        "catalogue_v2": _view("catalogue_v2", catalogue.catalogue_v2),
        "parse_ratings": _view("catalogue_v1", parse_ratings),
        "tags_to_category": _view(
            "catalogue_v1", lambda c: c.select("uid", text.tag_category(F.col("tags")).alias("category"))
        ),
        "open_24h": _view(
            "catalogue_v1", lambda c: c.select("uid", text.open_all_day(F.col("openPeriods")).alias("is_open_24h"))
        ),
        "extract_area": _view("catalogue_v1", lambda c: c.select("uid", text.area_name(F.col("city")).alias("area"))),
        "price_level_terms": _view("catalogue_v1", price_level_terms),
        "merchant_key": _view(
            "catalogue_v1", lambda c: c.select("uid", text.merchant_key(F.col("uid")).alias("merchant_id"))
        ),
        "catalogue_v1": _view("catalogue_v1", catalogue.catalogue_v1),
        "basket_list": _view("transactions", lambda t: catalogue.basket_list(*basket_lines(t))),
        "basket_explode": _view("transactions", lambda t: catalogue.basket_explode(*basket_lines(t))),
        "basket_totals": _source(lambda s: catalogue.basket_totals(s.order_items, keep_first(s.orders, ["order_id"]))),
    }
