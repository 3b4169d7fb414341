from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from platewise.operators import impute


def filled(df, by, **kw):
    return {r["id"]: r for r in impute.fill_by_group(df, by, **kw).collect()}


PATHS = pytest.mark.parametrize("limit", [100, 0], ids=["broadcast", "spread"])


@PATHS
def test_mode_tie_takes_the_smallest(spark, limit):
    df = spark.createDataFrame(
        [(1, "g", "a"), (2, "g", "a"), (3, "g", "b"), (4, "g", "b"), (5, "g", None)], "id int, g string, v string"
    )
    assert filled(df, "g", modes={"v": "?"}, broadcast_groups=limit)[5]["v"] == "a"


@PATHS
def test_group_of_only_nulls(spark, limit):
    df = spark.createDataFrame(
        [(1, "x", 2.0, "a"), (2, "x", 4.0, "a"), (3, "y", None, None)], "id int, g string, n double, v string"
    )
    out = filled(df, "g", means={"n": 2}, modes={"v": "?"}, broadcast_groups=limit)
    assert out[3]["n"] == 3.0 and out[3]["v"] == "?"


@PATHS
def test_null_group_keeps_values_and_uses_overall_mean(spark, limit):
    df = spark.createDataFrame(
        [(1, None, 10.0), (2, None, None), (3, "x", 1.0), (4, "x", None)], "id int, g string, n double"
    )
    out = filled(df, "g", means={"n": 2}, broadcast_groups=limit)
    assert out[1]["n"] == 10.0 and out[4]["n"] == 1.0
    # overall mean after the group fill: (10 + 1 + 1) / 3
    assert out[2]["n"] == 4.0


@PATHS
def test_mean_is_exact_and_half_even(spark, limit):
    df = spark.createDataFrame(
        [(1, "x", Decimal("2.12")), (2, "x", Decimal("2.13")), (3, "x", None),
         (4, "y", Decimal("2.13")), (5, "y", Decimal("2.14")), (6, "y", None)],
        "id int, g string, n decimal(18,2)",
    )
    out = filled(df, "g", means={"n": 2}, broadcast_groups=limit)
    assert out[3]["n"] == Decimal("2.12") and out[6]["n"] == Decimal("2.14")
    assert impute.fill_by_group(df, "g", means={"n": 2}, broadcast_groups=limit).schema == df.schema


@PATHS
def test_column_of_only_nulls_stays_null(spark, limit):
    df = spark.createDataFrame([(1, "x", None), (2, "y", None)], "id int, g string, n double")
    assert [r["n"] for r in filled(df, "g", means={"n": 2}, broadcast_groups=limit).values()] == [None, None]


@PATHS
def test_empty(spark, limit):
    df = spark.createDataFrame([], "id int, g string, n double, v string")
    out = impute.fill_by_group(df, "g", means={"n": 2}, modes={"v": "?"}, broadcast_groups=limit)
    assert out.collect() == [] and out.columns == df.columns


def test_hot_gaps_are_spread_and_equal_to_the_broadcast(spark, rows):
    df = spark.range(4000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 200).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 17).cast("decimal(18,2)").alias("n"),
    )
    small = impute.fill_by_group(df, "g", means={"n": 2})
    large = impute.fill_by_group(df, "g", means={"n": 2}, broadcast_groups=0, hot_rows=100)
    assert rows(small) == rows(large)


def test_overall_mean_over_stats_equals_mean_of_filled_column(spark):
    df = spark.createDataFrame(
        [(1, "a", Decimal(10)), (2, "a", None), (3, "a", None), (4, "b", Decimal(1)), (5, "c", None)],
        "id int, g string, n decimal(18,2)",
    )
    # group fill: 10, 10, 10, 1 -> mean 7.75
    assert filled(df, "g", means={"n": 2})[5]["n"] == Decimal("7.75")


def test_learn_from_another_frame(spark):
    base = spark.createDataFrame([(1, "x", 4.0), (2, "x", None)], "id int, g string, n double")
    out = filled(base.withColumn("extra", F.lit(1)), "g", means={"n": 2}, learn_from=base)
    assert out[2]["n"] == 4.0 and out[2]["extra"] == 1


def test_global_mode_and_default(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a"), (5, None)], "id int, v string")
    assert {r["id"]: r["v"] for r in impute.fill_global_mode(df, "v", "?").collect()}[5] == "a"
    none = spark.createDataFrame([(1, None)], "id int, v string")
    assert impute.fill_global_mode(none, "v", "?").first()["v"] == "?"


def test_constants_keep_the_type(spark):
    df = spark.createDataFrame([(None, Decimal("1.50"))], "a int, b decimal(18,2)")
    out = impute.fill_constants(df, {"a": 1, "b": 0})
    assert out.schema["a"].dataType == df.schema["a"].dataType and out.first() == (1, Decimal("1.50"))


@PATHS
def test_attach_group_value(spark, rows, limit):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, g string")
    best = spark.createDataFrame([("x", 9)], "g string, best int")
    out = impute.attach_group_value(df, best, "g", broadcast_groups=limit)
    assert rows(out, "id", "best") == [(1, 9), (2, None), (3, None)]


def test_large_group_tables_are_not_broadcast(spark, plan):
    df = spark.range(100).selectExpr("id", "id % 10 as g", "if(id % 4 = 0, null, cast(id as double)) as n")
    assert "BroadcastHashJoin" in plan(impute.fill_by_group(df, "g", means={"n": 2}))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(impute.fill_by_group(df, "g", means={"n": 2}, broadcast_groups=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the rows with a gap are shuffled to the statistics; the complete ones are a plain scan of the union.
    assert "BroadcastHashJoin" not in text and "Union" in text and "SortMergeJoin" in text
