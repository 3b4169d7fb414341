"""Intermediate tables whose shuffle files go as soon as the table is written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from platewise.workspace import materialise

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffles that made it are deleted then, not when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return materialise(df, name)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
