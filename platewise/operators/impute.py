"""Filling nulls with the mean or the most frequent value of a group.

A group statistic needs one pass over the data before the rows can be completed. The statistics table (one row per
group) is built with map-side partial aggregation, written to the shared folder and counted. Up to
``BROADCAST_GROUPS`` groups it is broadcast. Beyond that only the rows with something to fill are joined to it by key;
complete rows never move.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.operators.lookup import HOT_ROWS, lookup
from platewise.workspace import materialise

BROADCAST_GROUPS = 100_000

_EXACT = "decimal(28,10)"
_MEAN = "decimal(22,10)"


def _exact(df: DataFrame, name: str) -> Column:
    """The column as a decimal, so that sums do not depend on the order of the rows."""
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.col(name)
    return F.col(name).try_cast(_EXACT)


def _round(col: Column, scale: int | None) -> Column:
    return col if scale is None else F.bround(col, scale)


def value_counts(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    keys = [by] if by else []
    present = df.dropna(subset=[*keys, name])
    return present.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_n"))


def _most_frequent(name: str) -> Column:
    """Value with the highest count; the smallest value wins a tie."""
    return F.min(F.struct((-F.col("_n")).alias("rank"), F.col(name).alias("value")))["value"]


def group_mode(df: DataFrame, name: str, by: str) -> DataFrame:
    """Most frequent value per group, counted per (group, value) first: no buffer holds a group's distinct values."""
    return value_counts(df, name, by).groupBy(by).agg(_most_frequent(name).alias(f"{name}__fill"))


def _sums(df: DataFrame, name: str) -> list[Column]:
    return [
        F.sum(_exact(df, name)).alias(f"{name}__sum"),
        F.count(name).alias(f"{name}__n"),
        F.count_if(F.col(name).isNull()).alias(f"{name}__gaps"),
    ]


def _with_means(sums: DataFrame, by: str, means: Mapping[str, int | None]) -> DataFrame:
    for name, scale in means.items():
        mean = _round(F.try_divide(F.col(f"{name}__sum"), F.col(f"{name}__n")), scale).cast(_MEAN)
        sums = sums.withColumn(f"{name}__fill", F.when(F.col(by).isNotNull(), mean))
    return sums


def _group_means(df: DataFrame, by: str, means: Mapping[str, int | None]) -> DataFrame:
    return _with_means(df.groupBy(by).agg(*[a for name in means for a in _sums(df, name)]), by, means)


def _overall_mean(name: str, scale: int | None) -> Column:
    """Mean of the column after the groups were filled, as an aggregate of the group statistics alone."""
    gaps = F.when(F.col(f"{name}__fill").isNotNull(), F.col(f"{name}__gaps")).otherwise(0).cast("decimal(14,0)")
    filled = gaps * F.coalesce(F.col(f"{name}__fill"), F.lit(0).cast(_MEAN))
    total = F.sum(F.coalesce(F.col(f"{name}__sum"), F.lit(0)) + filled)
    return _round(F.try_divide(total, F.sum(F.col(f"{name}__n") + gaps)), scale)


def group_statistics(
    df: DataFrame, by: str, means: Mapping[str, int | None] | None = None, modes: Mapping[str, object] | None = None
) -> DataFrame:
    """One row per group with a ``<column>__fill`` value for every requested column, from one scan.

    Rows are counted by group and, for each mode, by group and value in the same pass; what is shuffled is one row per
    task and such combination.
    """
    means, names = means or {}, list(modes or {})
    if not names:
        return _group_means(df, by, means)
    if not means and len(names) == 1:
        return group_mode(df, names[0], by)
    sums = [a for name in means for a in _sums(df, name)]
    sets = ([[by]] if means else []) + [[by, name] for name in names]
    held = df.groupingSets(sets, by, *names).agg(
        *sums, F.count(F.lit(1)).alias("_n"), *[F.grouping(name).alias(f"{name}__rest") for name in names]
    )
    whole = F.lit(True)
    for name in names:
        whole = whole & (F.col(f"{name}__rest") == 1)
    picks = [F.max(F.when(whole, F.col(f"{name}__{part}"))).alias(f"{name}__{part}") for name in means for part in ("sum", "n", "gaps")]
    for name in names:
        given = (F.col(f"{name}__rest") == 0) & F.col(name).isNotNull() & F.col(by).isNotNull()
        picks.append(F.min(F.when(given, F.struct((-F.col("_n")).alias("rank"), F.col(name).alias("value"))))["value"].alias(f"{name}__fill"))
    return _with_means(held.groupBy(by).agg(*picks), by, means)


def fill_by_group(
    df: DataFrame,
    by: str,
    means: Mapping[str, int | None] | None = None,
    modes: Mapping[str, object] | None = None,
    *,
    learn_from: DataFrame | None = None,
    broadcast_groups: int = BROADCAST_GROUPS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fill the nulls of several columns from their group.

    ``means`` maps a column to the decimals its mean is rounded to, half-even (``None``: not rounded); what is still
    missing gets the overall mean. ``modes`` maps a column to the default used where the group has no value (``None``:
    stays null). Values that are present are never changed, whatever their group. ``learn_from`` is a frame with the
    same rows that is cheaper to scan for the statistics, such as the table that ``df`` was built from.
    """
    means, modes = means or {}, modes or {}
    targets = [*means, *modes]
    source = df if learn_from is None else learn_from
    stats = materialise(group_statistics(source, by, means, modes), f"stats-{by}")
    fallback = {name: F.lit(default) for name, default in modes.items()}
    if means:
        overall = stats.agg(F.struct(*[_overall_mean(n, scale).alias(n) for n, scale in means.items()])).scalar()
        fallback |= {name: overall[name] for name in means}

    fills = stats.where(F.col(by).isNotNull()).select(by, *[f"{name}__fill" for name in targets])
    if fills.count() <= broadcast_groups:
        joined = df.join(F.broadcast(fills), by, "left")
    else:
        gap = F.lit(False)
        for name in targets:
            gap = gap | F.col(name).isNull()
        complete = df.where(~gap)
        for name in targets:
            complete = complete.withColumn(f"{name}__fill", F.lit(None).cast(fills.schema[f"{name}__fill"].dataType))
        joined = complete.unionByName(lookup(df.where(gap), fills, [by], hot_rows=hot_rows))

    def column(name: str) -> Column:
        if name not in targets:
            return F.col(name)
        kind = df.schema[name].dataType
        parts = [F.col(name), F.col(f"{name}__fill").cast(kind), fallback[name].cast(kind)]
        return F.coalesce(*parts).alias(name)

    return joined.select(*[column(name) for name in df.columns])


def fill_global_mode(df: DataFrame, name: str, default) -> DataFrame:
    """Fill nulls with the most frequent value of the whole column."""
    mode = value_counts(df, name).agg(_most_frequent(name)).scalar()
    return df.withColumn(name, F.coalesce(F.col(name), mode, F.lit(default).cast(df.schema[name].dataType)))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls with fixed values, keeping each column's type."""
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(v).cast(df.schema[name].dataType)) for name, v in values.items()}
    )


def attach_group_value(
    df: DataFrame, stats: DataFrame, by: str, *, broadcast_groups: int = BROADCAST_GROUPS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Align a per-group statistic to the rows: broadcast after counting it, else a spread join."""
    stats = materialise(stats, f"stats-{by}")
    if stats.count() <= broadcast_groups:
        return df.join(F.broadcast(stats), by, "left")
    return lookup(df, stats, [by], hot_rows=hot_rows)
