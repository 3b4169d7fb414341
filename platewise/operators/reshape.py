"""Pivots, shares of a group total and fixed domains. All work on small, already aggregated frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_group(df: DataFrame, by: str, value: str, name: str = "pct") -> DataFrame:
    """Percentage of ``value`` within its group, for frames with one row per (group, member)."""
    total = F.sum(value).over(Window.partitionBy(by))
    return df.withColumn(name, F.try_divide(F.col(value) * F.lit(100.0), total))


def widen(
    df: DataFrame, index: str, column: str, value: str, names: dict[object, str], rest: str | None = None
) -> DataFrame:
    """Pivot with a declared list of columns, absent cells as 0. ``names`` maps a value to its column name.

    ``rest`` names a column for the sum over all values without one, so that a row's cells add up to its total.
    """
    cells = [
        F.coalesce(F.sum(F.when(F.col(column) == F.lit(key), F.col(value))), F.lit(0)).alias(alias)
        for key, alias in names.items()
    ]
    if rest is not None:
        named = F.coalesce(F.col(column).isin(*names), F.lit(False))
        cells.append(F.coalesce(F.sum(F.when(~named, F.col(value))), F.lit(0)).alias(rest))
    return df.groupBy(index).agg(*cells)


def on_domain(df: DataFrame, index: str, domain: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """One row per value of a literal domain, in its order; absent rows are 0 and values outside are dropped."""
    rows = [F.struct(F.lit(i).alias("position"), F.lit(v).alias(index)) for i, v in enumerate(domain)]
    axis = stacked(df.sparkSession.range(1), rows)
    # At most one row per value of the domain is broadcast.
    joined = axis.join(F.broadcast(df.where(F.col(index).isin(*domain))), index, "left")
    return joined.select("position", index, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in fill])


def stacked(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn the columns of a one-row aggregate into rows."""
    return df.select(F.inline(F.array(*rows)))
