"""Tables that lie in buckets of a key, so that two of them meet without moving a row.

A bucketed table has as many files as buckets, each with the rows of the same keys, sorted. Two tables with one number of buckets are
joined bucket by bucket. Keys that hold too many rows for one bucket (``hot``) lie in a second folder, spread over its files; they are few,
and a look-up table has few rows for them, so these are broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.operators.lookup import HotKeys
from platewise.workspace import task_count


@dataclass(frozen=True)
class Bucketed:
    """Scan of a bucketed table, and of the rows of its hot keys."""

    ordinary: DataFrame
    key: str
    buckets: int
    hot_rows: DataFrame | None = None
    hot: Sequence[int] = field(default=())

    def all(self) -> DataFrame:
        return self.ordinary if self.hot_rows is None else self.ordinary.unionByName(self.hot_rows)

    def select(self, *columns: str) -> Bucketed:
        """The table with fewer columns; the key must stay."""
        narrow = None if self.hot_rows is None else self.hot_rows.select(*columns)
        return Bucketed(self.ordinary.select(*columns), self.key, self.buckets, narrow, self.hot)


def default_buckets(spark: SparkSession, rows: int = 0) -> int:
    """Buckets of a table of so many rows: a task sorts whole buckets, so their number grows with the rows."""
    return task_count(spark, rows)


def is_hot(key: str, hot: HotKeys | Sequence[int]) -> Column:
    return F.xxhash64(key).isin(*hot) if hot else F.lit(False)


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` in buckets of ``key``. A frame that is already dealt out like that, such as a join of two bucketed tables, is not shuffled."""
    writer = df.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet")
    writer.saveAsTable(_name(path))


def scan_buckets(spark: SparkSession, path: str, ddl: str, key: str, buckets: int) -> DataFrame:
    """Scan of a bucketed folder, which the session's catalogue gets to know if it doesn't."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def forget_buckets(spark: SparkSession, path: str) -> None:
    """Take a folder out of the catalogue; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")


def _name(path: str) -> str:
    return f"platewise_{hashlib.sha256(path.encode()).hexdigest()[:20]}"


def deal(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows by bucket, as a write in buckets wants them: one file for each."""
    return df.repartition(buckets, key)


def join_in_place(left: Bucketed, right: Bucketed, how: str = "inner") -> tuple[DataFrame, DataFrame | None]:
    """Join of two tables in equal buckets: rows of ordinary keys, which stay where they are, and rows of the hot keys of ``left``.

    ``right`` is the side with few rows for a key; its own hot keys, if any, are looked up as well.
    """
    if (left.key, left.buckets) != (right.key, right.buckets):
        raise ValueError("the tables have different buckets")
    table = right.all() if right.hot_rows is not None else right.ordinary
    ordinary = left.ordinary.join(table, left.key, how)
    if left.hot_rows is None:
        return ordinary, None
    few = table.where(is_hot(right.key, left.hot))  # rows of at most a few thousand keys
    return ordinary, left.hot_rows.join(F.broadcast(few), left.key, how)
