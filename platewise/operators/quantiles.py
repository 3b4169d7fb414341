"""Exact quantiles of any number of groups of any size.

``median`` and ``percentile`` gather every distinct value of a group in one aggregation buffer. Here values are counted first. The counted values are
laid out once in ranges of (group, value), so that a large group spans ranges and small ones share one. Running counts within a range, and the counts of
the group's earlier ranges, tell how many rows lie below each value; the values at the wanted ranks are picked by one aggregation.
Nothing comes back to the driver, and no task holds a group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.workspace import materialise


def counted(df: DataFrame, group: str, value: str, scale: int = 2) -> DataFrame:
    """Rows (``n``) of each different value of a decimal column in each group: ``group``, ``unit`` (value x 10 ** scale), ``n``.

    One scan of ``df`` with partial aggregation, written once; every quantile, mean and extreme comes from this table.
    """
    rows = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    unit = (F.col(value) * F.lit(10**scale)).cast("bigint").alias("unit")
    return materialise(rows.groupBy(F.col(group).alias("group"), unit).agg(F.count(F.lit(1)).alias("n")), "value-counts")


def below(counts: DataFrame) -> DataFrame:
    """``counts`` with the rows of the group below each value (``below``) and in all (``total``)."""
    ranged = counts.repartitionByRange("group", "unit").withColumn("range", F.spark_partition_id())
    ranged = materialise(ranged, "ranged-counts")  # so that a range stays what it is
    parts = ranged.groupBy("range", "group").agg(F.sum("n").alias("_part"))
    group = Window.partitionBy("group")
    earlier = F.sum("_part").over(group.orderBy("range")) - F.col("_part")  # a group has at most a row for each range
    offsets = parts.select("range", "group", earlier.alias("_earlier"), F.sum("_part").over(group).alias("total"))
    within = F.sum("n").over(Window.partitionBy("range", "group").orderBy("unit")) - F.col("n")
    placed = ranged.withColumn("_within", within).join(offsets, ["range", "group"])
    return placed.select("group", "unit", "n", (F.col("_within") + F.col("_earlier")).alias("below"), "total")


def quantile_table(counts: DataFrame, probabilities: Mapping[str, float], scale: int = 2) -> DataFrame:
    """One row per group: ``group`` and, named as in ``probabilities``, its linear-interpolated quantiles."""
    upto = F.col("below") + F.col("n")
    picks, columns = [], []
    for i, (name, p) in enumerate(probabilities.items()):
        at = F.lit(str(p)).cast("decimal(10,8)") * (F.col("total") - 1).cast("decimal(19,0)")
        first = F.floor(at).cast("bigint")
        last = F.least(first + 1, F.col("total") - 1)

        def value_at(rank: Column) -> Column:
            return F.max(F.when((F.col("below") <= rank) & (rank < upto), F.col("unit")))

        picks += [value_at(first).alias(f"_low{i}"), value_at(last).alias(f"_high{i}"), F.max(at - first).alias(f"_part{i}")]
        step = (F.col(f"_high{i}") - F.col(f"_low{i}")).cast("decimal(19,0)") * F.col(f"_part{i}").cast("decimal(9,8)")
        exact = F.col(f"_low{i}").cast("decimal(19,0)") + step
        columns.append((exact * F.lit(f"1e-{scale}").cast(f"decimal({max(scale, 1)},{scale})")).cast("double").alias(name))
    return below(counts).groupBy("group").agg(*picks).select("group", *columns)


def exact_quantiles(df: DataFrame, group: str, value: str, probabilities: Mapping[str, float], scale: int = 2) -> DataFrame:
    """Linear-interpolated quantiles per group of a decimal column with ``scale`` decimals; the group keeps its name."""
    return quantile_table(counted(df, group, value, scale), probabilities, scale).withColumnRenamed("group", group)
