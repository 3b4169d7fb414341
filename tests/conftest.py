from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from platewise.workspace import discard  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", "/tmp/platewise-test-warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    discard(session)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(out, key=lambda r: [(v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r])

    return collect


@pytest.fixture
def plan():
    """Physical plan of a frame as text."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
