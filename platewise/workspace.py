"""Intermediate tables in the folder that every executor can reach.

Cleaned rows and group statistics are written there once and read back. That cuts the lineage, survives the loss of
executors, and gives Catalyst the true file size of each statistics table when it picks a join.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR_KEY = "spark.checkpoint.dir"
ROWS_PER_TASK = 300_000  # sorted in some 100 MB, also where two tables meet and the result is written sorted


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the cluster in ``spark.checkpoint.dir``; on a local master without one, the temporary folder."""
    base = spark.conf.get(_DIR_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_DIR_KEY} to a folder that all executors can reach")
        base = f"{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/platewise/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def task_count(spark: SparkSession, rows: int = 0) -> int:
    """Tasks that ``rows`` are dealt to: the session's shuffle partitions, and more where these would each sort too much."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a scan of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; frames built on them can no longer be read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
