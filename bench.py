"""Time the headline queries and print one JSON line.

Every query is run once to warm up and then ``BENCH_RUNS`` times (default 3); the median counts. All result columns are
computed (``noop`` sink). ``warehouse_build`` is the whole daily job from the raw tables to the eight written tables; the
reports read the warehouse it built.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from platewise.workspace import discard  # noqa: E402
from verification.queries import Data, queries  # noqa: E402

HEADLINE = (
    "dedup_keep_first",
    "impute_mode_by_group",
    "impute_mean_by_group",
    "clean_users",
    "clean_orders",
    "clean_order_items",
    "hourly_weather",
    "weather_lookup_join",
    "fact_orders",
    "fact_order_items",
    "top_merchants",
    "weekday_basket",
    "weekend_stats",
    "weekend_boxplot",
    "category_share_by_age",
    "merchant_map",
    "orders_by_hour",
    "weather_volume",
    "weather_hour_heatmap",
    "avg_daily_orders",
    "city_revenue",
    "fk_orphans",
    "city_consistency",
    "subtotal_reconcile",
    "dq_report",
    "catalogue_v1",
    "catalogue_v2",
    "basket_list",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    started = time.perf_counter()
    job()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    Data(spark, folder).warehouse
    seconds = {"warehouse_build": timed(lambda: Data(spark, folder).warehouse)}
    for name in HEADLINE:
        job = lambda query=known[name]: run(query(spark, folder))
        job()
        seconds[name] = statistics.median(timed(job) for _ in range(runs))
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    discard(spark)
    spark.stop()


if __name__ == "__main__":
    main()
