"""Row counts before and after each cleaning step, and the load-time column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from platewise.operators.dedup import row_order


def removal(step: str, before: Column, after: Column) -> Column:
    """Struct of one audit line; the percentage is 0 when there was nothing before."""
    removed = before - after
    percent = F.coalesce(F.try_divide(removed * F.lit(100.0), before), F.lit(0.0))
    return F.struct(
        F.lit(step).alias("step"),
        before.cast("bigint").alias("rows_before"),
        after.cast("bigint").alias("rows_after"),
        removed.cast("bigint").alias("removed"),
        F.round(percent, 1).alias("removed_pct"),
    )


def cleaning_audit(
    df: DataFrame,
    table: str,
    key: str,
    required: Sequence[str],
    valid: Column | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Audit of de-duplication, null-key removal and an optional validity test, from one aggregation by key.

    ``valid`` is tested on the surviving row of each key, as the cleaning job does.
    """
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    usable = complete if valid is None else complete & F.coalesce(valid, F.lit(False))
    order = F.struct(*row_order(df, [key], order_by))
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(F.struct(order.alias("order"), complete.alias("complete"), usable.alias("usable"))).alias("_first"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_raw"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_first.complete")).alias("n_complete"),
        F.count_if(F.col("_first.usable")).alias("n_usable"),
    )
    steps = [
        removal("dedup", F.col("n_raw"), F.col("n_keys")),
        removal("drop_null_keys", F.col("n_keys"), F.col("n_complete")),
    ]
    if valid is not None:
        steps.append(removal("drop_invalid", F.col("n_complete"), F.col("n_usable")))
    return totals.select(F.lit(table).alias("table_name"), F.inline(F.array(*steps)))


class Trail:
    """Row counts of the cleaning steps of one run, observed in the writes that the run makes anyway.

    Counts after a step are observed behind the last shuffle of a write, where a repeated task counts once. Rows before the first
    shuffle could be counted twice there if an executor is lost, so these come from one scan of the key columns alone. Nothing is shuffled
    but one row for each task.
    """

    def __init__(self) -> None:
        self._raw: list[tuple[str, DataFrame, str]] = []
        self._steps: list[tuple[str, str, Observation | int]] = []
        self._lock = Lock()

    def raw(self, df: DataFrame, table: str, key: str) -> None:
        """Rows as they come, for a table that is then reduced to one row of each key."""
        with self._lock:
            self._raw.append((table, df, key))

    def observe(self, df: DataFrame, table: str, step: str) -> DataFrame:
        """``df``, whose rows are what the step has left; it must be written once."""
        seen = Observation()
        with self._lock:
            self._steps.append((table, step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def left(self, table: str, step: str, rows: int) -> None:
        """What a step has left, where the number is known already."""
        with self._lock:
            self._steps.append((table, step, rows))

    def lines(self, spark: SparkSession) -> DataFrame:
        """One line for each table and step. Waits for the writes whose rows are observed.

        A missing key counts as one key, as in :func:`cleaning_audit`, and goes with the next step.
        """
        before: dict[str, int] = {}
        one_missing: dict[str, int] = {}
        if self._raw:
            counts = [
                df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("missing")).select(F.lit(table).alias("table"), "*")
                for table, df, key in self._raw
            ]
            for row in reduce(DataFrame.unionByName, counts).collect():  # one row for each table
                before[row["table"]], one_missing[row["table"]] = row["n"], int(row["missing"] > 0)
        out = []
        for table, step, seen in self._steps:
            rows = seen if isinstance(seen, int) else seen.get["n"]
            after = rows + one_missing.pop(table, 0)
            out.append((table, step, before[table], after))
            before[table] = after
        found = spark.createDataFrame(out, "table_name string, step string, rows_before bigint, rows_after bigint")
        line = removal("", F.col("rows_before"), F.col("rows_after"))
        return found.withColumns({"removed": line["removed"], "removed_pct": line["removed_pct"]})


def with_load_time(df: DataFrame, loaded_at) -> DataFrame:
    """Add the audit column ``dwh_load_time``; the caller passes the time, so that a rerun can repeat it."""
    return df.withColumn("dwh_load_time", F.lit(loaded_at).cast("timestamp_ntz"))
