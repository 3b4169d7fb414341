"""The daily job: sources -> clean tables -> star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.operators.audit import Trail
from platewise.operators.lookup import hot_keys
from platewise.plans import clean, dims, facts, weather
from platewise.sources.buckets import default_buckets
from platewise.sources.readers import city_points, month_ranges, order_date_range, readings_at
from platewise.sources.store import Entry, Store

DAY = "date_id"  # the facts' parts, where they have parts
LINES, SIDE, AUDIT = "clean_order_items", "order_side", "load_audit"
TABLES = ("dim_date", "dim_user", "dim_driver", "dim_merchant", "dim_product", "dim_weather", "fact_orders", "fact_order_items")


@dataclass(frozen=True)
class Sources:
    """Raw inputs of one run."""

    users: DataFrame
    drivers: DataFrame
    merchants: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    reviews: DataFrame
    weather_readings: DataFrame


def weather_for(sources: Sources, utc_offset_hours: Mapping[str, int] | None = None) -> DataFrame:
    """Hourly weather over the calendar months that have orders, widened by the clock offsets of the look-up.

    The two dates come back to the driver, so that the scan of the readings gets them as pushed-down literals. Readings that have
    coordinates instead of a city are brought to the cities by place.
    """
    months = month_ranges(order_date_range(sources.orders))
    span = months.agg(F.min("range_start").alias("start"), F.max("range_end").alias("end")).first()
    offsets = [0, *(utc_offset_hours or {}).values()]
    start = F.lit(span["start"]).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(max(offsets)))
    end = F.lit(span["end"]).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(min(offsets)))
    readings = sources.weather_readings
    if "city" not in readings.columns:
        readings = readings_at(readings.where((F.col("time") >= start) & (F.col("time") < end)), city_points(readings.sparkSession))
    return weather.hourly_weather(readings, start=start, end=end)


def build_warehouse(
    sources: Sources,
    as_of: Column,
    folder: str,
    *,
    partition_facts: bool = False,
    utc_offset_hours: Mapping[str, int] | None = None,
    concurrent_tables: int = 6,
    buckets: int | None = None,
    loaded_at: str | None = None,
) -> dict[str, DataFrame]:
    """Build all tables in the store ``folder`` and return scans of the new version, which begins with the last step.

    Tables that do not depend on each other are submitted together, so that the tail of one job does not leave the
    executors idle. Clean lines and orders lie in buckets of the order id (``buckets``, by default as many as the session has shuffle partitions, and more for many lines), so the line fact is joined without
    a shuffle, and so is whatever else brings lines and orders together. Hot orders are looked for in the raw lines: one narrow scan.

    With ``partition_facts`` the facts have a folder for each day, and only days whose rows differ from the current version's are written again.
    ``load_audit`` gets a line for each cleaning step of the run, and keeps those of earlier runs; ``loaded_at`` is its time, now by default.
    """
    spark = sources.orders.sparkSession
    store, trail = Store(spark, folder), Trail()
    onto, number = store.version(), buckets or default_buckets(spark, sources.order_items.count())

    def load(name: str, build: Callable[[], DataFrame]) -> Entry:
        return store.write(name, build())

    builders: dict[str, Callable[[], DataFrame]] = {
        "dim_weather": lambda: weather.dim_weather(weather_for(sources, utc_offset_hours)),
        "dim_date": lambda: dims.dim_date(sources.orders),
        "dim_user": lambda: dims.dim_user(clean.clean_users(sources.users, trail=trail), as_of),
        "dim_driver": lambda: dims.dim_driver(clean.clean_drivers(sources.drivers, trail=trail)),
        "dim_merchant": lambda: dims.dim_merchant(clean.clean_merchants(sources.merchants, trail=trail), sources.reviews),
        "dim_product": lambda: dims.dim_product(clean.clean_products(sources.products, trail=trail)),
    }
    with ThreadPoolExecutor(concurrent_tables) as pool:

        def submit(job: Callable, *args) -> Future:
            return pool.submit(inheritable_thread_target(spark)(job), *args)

        def clean_lines() -> Entry:
            hot = hot_keys(sources.order_items, ["order_id"])
            return store.write_buckets(LINES, clean.clean_order_items(sources.order_items, trail=trail), "order_id", number, hot)

        items = submit(clean_lines)
        orders = submit(lambda: clean.clean_orders(sources.orders, trail=trail))
        loads = {name: submit(load, name, build) for name, build in builders.items()}
        hot_hours = submit(hot_keys, weather.order_hours(sources.orders, utc_offset_hours), ["city", "waktu"])
        known = store.scan("dim_weather", loads["dim_weather"].result())
        order_facts = facts.fact_orders(orders.result(), known, utc_offset_hours, hot=hot_hours.result())
        if partition_facts:
            done = {"fact_orders": store.write_parts("fact_orders", order_facts, DAY)}
            side = facts.order_side(store.scan("fact_orders", done["fact_orders"]))
            done[SIDE] = store.write_buckets(SIDE, side, "order_id", number)
        else:
            done = {"fact_orders": store.write_buckets("fact_orders", order_facts, "order_id", number)}
        done[LINES] = items.result()
        known_orders = SIDE if partition_facts else "fact_orders"
        ordinary, hot = facts.fact_order_items_in_place(
            store.bucketed(LINES, done[LINES]), store.bucketed(known_orders, done[known_orders])
        )
        if partition_facts:
            lines = ordinary if hot is None else ordinary.unionByName(hot)
            done["fact_order_items"] = store.write_parts("fact_order_items", lines, DAY)
        else:
            done["fact_order_items"] = store.write_dealt("fact_order_items", ordinary, "order_id", number, hot, done[LINES].hot)
        done |= {name: finished.result() for name, finished in loads.items()}
    trail.left("users", "drop_missing_birth_date", done["dim_user"].rows)
    trail.left("order_items", "drop_orphan_lines", done["fact_order_items"].rows)
    time = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    run = trail.lines(spark).select(F.lit(onto + 1).alias("run"), time.cast("timestamp_ntz").alias("loaded_at"), "*")
    done[AUDIT] = store.append(AUDIT, run)
    store.commit(done, onto)
    return {name: store.scan(name, done[name]) for name in (*TABLES, AUDIT)}
