"""Equi-joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
_MOST_HOT_KEYS = 4096  # a sketch of 8,192 slots is not sure of more
_SKETCH_SIZE = 8192
_SKETCH_GROUPS = 64
_SALT = "_salt"

HotKeys = Mapping[int, int]  # hash of a key -> number of parts


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> HotKeys:
    """Hashes of the keys that hold about ``min_rows`` rows or more, each with its number of parts; a missing key is one of them.

    A key is divided into a power of two of parts, so many that none holds more than about ``min_rows / 2`` rows. One pass over the key columns
    into fixed-size frequent-items sketches, merged in two steps (per group of input partitions, then all), so nothing is
    shuffled by key and no task merges the sketches of every input task. The answer only decides how rows are spread; any
    answer gives the same join result, and keys too small for the sketch to see are left to adaptive skew-join splitting.
    """
    hashes = df.select(F.xxhash64(*keys).alias("key_hash"))
    group = F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("sketch_group")
    sketches = hashes.groupBy(group).agg(F.expr(f"approx_top_k_accumulate(key_hash, {_SKETCH_SIZE})").alias("sketch"))
    # Grouped by a constant: without any sketch to combine there is no row, instead of an error.
    merged = sketches.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(sketch, {_SKETCH_SIZE})").alias("sketch"))
    row = merged.select(F.expr(f"approx_top_k_estimate(sketch, {_MOST_HOT_KEYS})").alias("top")).first()
    found = {item["item"]: item["count"] for item in row["top"] if item["count"] >= min_rows} if row else {}
    return {key: 1 << math.ceil(math.log2(2 * n / max(1, min_rows))) for key, n in found.items()}


def _by_parts(hot: HotKeys) -> list[tuple[int, list[int]]]:
    """Hot keys grouped by their number of parts: a few groups, since the numbers are powers of two."""
    groups: dict[int, list[int]] = {}
    for key, parts in hot.items():
        groups.setdefault(parts, []).append(key)
    return sorted(groups.items())


def spread(keys: Sequence[str], hot: HotKeys, by: Sequence[str]) -> Column:
    """Part number of a row: 0 for ordinary keys, a hash of the row for hot ones (repeatable when a task is retried)."""
    part = F.lit(0)
    for parts, group in _by_parts(hot):
        part = F.when(F.xxhash64(*keys).isin(*group), F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")).otherwise(part)
    return part


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``table`` to ``df`` on equal keys (``inner`` or ``left``), spreading the hot keys of ``df``.

    Rows of a hot key are divided over its parts and the matching rows of ``table`` are repeated once for each;
    all other keys move once, unsalted. A missing key matches nothing and is spread like any other. Spark still
    broadcasts ``table`` if its size is under the session's threshold. ``df`` should have no exact copies of a row:
    copies share a sub-key, so count them first. Pass ``hot`` where a narrower scan than ``df`` can find the hot keys.
    """
    on = list(on)
    table = table.dropna(subset=on)
    for key in on:
        table = table.withColumn(key, F.col(key).cast(df.schema[key].dataType))
    hot = hot_keys(df, on, hot_rows) if hot is None else hot
    if not hot:
        return df.join(table, on, how)
    left = df.withColumn(_SALT, spread(on, hot, df.columns))
    copies = F.array(F.lit(0))
    for parts, group in _by_parts(hot):
        copies = F.when(F.xxhash64(*on).isin(*group), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(copies)
    right = table.withColumn(_SALT, F.explode(copies))
    return left.join(right, [*on, _SALT], how).drop(_SALT)


def rows_without_partner(df: DataFrame, keys: Sequence[str], table: DataFrame, name: str) -> DataFrame:
    """One row: how many rows of ``df`` have no partner in ``table``. A row with a null key has none.

    Rows are counted per key, and the table reduced to its keys, before the shuffle: a hot or null key is a single row
    in the join, on either side. It is an outer join with a test, because an anti-join would be moved back below the
    count by the optimizer and meet the hot keys there.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    known = table.select(*keys).distinct().withColumn("_known", F.lit(True))
    missing = F.when(F.col("_known").isNull(), F.col("_rows"))
    return counts.join(known, list(keys), "left").agg(F.coalesce(F.sum(missing), F.lit(0)).cast("bigint").alias(name))


def rows_without_parent(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: the number of ``orphans`` of a foreign key."""
    keys = parent.select(F.col(parent_key).alias("_key"))
    return rows_without_partner(child.select(F.col(key).alias("_key")), ["_key"], keys, "orphans")
