"""Table scans and the weather source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from platewise.functions import calendar, geo, weather
from platewise.operators.nearby import within
from platewise.sources import schemas


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 64,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan of a database table. Pass ``partition_column`` and its bounds for large tables, to read in parallel.

    Connection settings are the caller's; credentials belong in ``options``, never in code.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**dict(options or {}))
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=str(partitions)
        )
    return reader.load()


def read_csv_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All source tables of a folder of ``<table>.csv`` files."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in schemas.SOURCE_TABLES.items()}


def sample_rows(tables: Mapping[str, DataFrame], keys: Mapping[str, str], n: int = 20) -> dict[str, DataFrame]:
    """First ``n`` rows of every table by its key (``TakeOrderedAndProject``, no full sort)."""
    return {name: df.orderBy(keys[name], *[c for c in df.columns if c != keys[name]]).limit(n)
            for name, df in tables.items()}


def order_date_range(orders: DataFrame) -> DataFrame:
    """One row: first order date and the day after the last one, over the order times that can be read."""
    ts = calendar.parse_timestamp(F.col("order_time"))
    span = orders.agg(F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))
    return span.select(
        F.to_date("first_time").alias("start_date"), F.date_add(F.to_date("last_time"), 1).alias("end_date")
    )


def month_ranges(date_range: DataFrame) -> DataFrame:
    """Half-open calendar months that cover [start_date, end_date]."""
    first = F.trunc("start_date", "month").cast("date")
    months = F.explode(F.sequence(first, F.col("end_date"), F.expr("interval 1 month")))
    return date_range.where(F.col("start_date").isNotNull()).select(months.alias("range_start")).select(
        "range_start", F.add_months("range_start", 1).alias("range_end")
    )


def readings_at(readings: DataFrame, points: DataFrame, km: float = geo.CELL_KM / 2) -> DataFrame:
    """Readings with coordinates (``lat``, ``lon``) that lie in the cell around a point, with the ``city`` of the point.

    ``points`` has ``city``, ``lat`` and ``lon``. Readings of one instant are averaged by :func:`weather_observations`.
    """
    return within(readings.drop("city"), points, km).drop("lat", "lon", "distance_km")


def city_points(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(city, *place) for city, place in geo.CITY_POINTS.items()], "city string, lat double, lon double")


def weather_observations(
    readings: DataFrame, cities: Sequence[str], start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Mean temperature, rain and humidity per city and instant, ``start <= time < end``.

    Humidity is worked out per reading, before the mean. Sums are decimals, so a mean does not depend on partitioning.
    """
    rows = readings.where(F.col("city").isin(*cities))
    if start is not None:
        rows = rows.where(F.col("time") >= start)
    if end is not None:
        rows = rows.where(F.col("time") < end)
    rows = rows.withColumn("humidity", weather.relative_humidity(F.col("temp_k"), F.col("dewpoint_k")))
    means = [_exact_mean(name).alias(name) for name in ("temp_k", "rain", "humidity")]
    return rows.groupBy("city", "time").agg(*means)


def _exact_mean(name: str) -> Column:
    exact = F.col(name).try_cast("decimal(28,12)")
    return (F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))).cast("double")
