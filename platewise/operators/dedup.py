"""De-duplication by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise import workspace
from platewise.operators.lookup import hot_keys


def row_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> list[str]:
    """Total order of the rows that share a key: the declared columns, then every other one."""
    return [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the smallest row of every key.

    Without ``order_by`` all columns decide, ascending and nulls first, so the result does not depend on partitioning.
    Spark limits every input partition to one row per key before the shuffle (``WindowGroupLimit``), so even a key
    that holds a third of the table reaches its reducer as one row per map task.
    """
    order = row_order(df, keys, order_by) or list(keys)
    latest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")


def keep_first_of_many(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """:func:`keep_first` for tables of any size: the number of tasks grows with the rows, so that none sorts more than it has room for.

    Rows of ordinary keys are dealt out to that many tasks; those of hot keys are reduced before their shuffle.
    """
    spark = df.sparkSession
    tasks = workspace.task_count(spark, df.count())
    if tasks <= workspace.task_count(spark):
        return keep_first(df, [key], order_by)
    hot = hot_keys(df, [key], workspace.ROWS_PER_TASK)
    if not hot:
        return keep_first(df.repartition(tasks, key), [key], order_by)
    is_hot = F.xxhash64(key).isin(*hot)
    ordinary = keep_first(df.where(~is_hot).repartition(tasks, key), [key], order_by)
    return ordinary.unionByName(keep_first(df.where(is_hot), [key], order_by))
