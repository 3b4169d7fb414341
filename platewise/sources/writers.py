"""Table loads and CSV export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from platewise.sources.readers import read_csv
from platewise.sources.store import Store


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a plain Parquet folder, for files that others take away. Tables that are read meanwhile belong in a ``Store``.

    With ``partition_by`` the rows are rebalanced on those columns first, so that a task does not write to every
    folder; adaptive execution splits a partition value that holds too many rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_table(df: DataFrame, name: str) -> None:
    """Replace a catalogue table."""
    df.write.mode("overwrite").saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> None:
    """Replace the rows of a database table and keep its definition."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", True)
    writer.options(**dict(options or {})).mode("overwrite").save()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def reload_from_csv(store: Store, path: str, schema: str, table: str) -> int | None:
    """Replace the rows of a store's table with a CSV file, keep the table's own columns and types and return the number of rows.

    A missing file is skipped (``None``); a missing table is created. The new rows are seen in one step, when all of them are
    there; a reload that fails leaves the old ones.
    """
    try:
        rows = read_csv(store.spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    onto = store.version()
    target = store.entries(onto).get(table)
    if target is not None:
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in StructType.fromDDL(target.ddl).fields])
    entry = store.write(table, rows)
    store.commit({table: entry}, onto)
    return entry.rows
