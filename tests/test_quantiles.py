import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.operators import quantiles
from platewise.plans import reports

SCHEMA = "g string, v decimal(18,2)"


def exact(values, p):
    return float(np.quantile(np.array([int(v * 100) for v in values], dtype=float), p) / 100)


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_equals_linear_interpolation(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(3)
    data = [("a", Decimal(rng.randrange(-500, 90000)) / 100) for _ in range(301)]
    data += [("b", Decimal(rng.randrange(0, 50)) / 100) for _ in range(88)]
    data += [("b", Decimal("12345678.91")), ("c", Decimal("4.20")), (None, Decimal(1)), ("a", None)]
    levels = {"p0": 0.0, "p1": 0.25, "p2": 0.5, "p3": 0.75, "p4": 0.99, "p5": 1.0}
    got = quantiles.exact_quantiles(spark.createDataFrame(data, SCHEMA), "g", "v", levels).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["g"] for r in got} == {"a", "b", "c"} and len(got) == 3
    for row in got:
        own = [v for g, v in data if g == row["g"] and v is not None]
        for name, p in levels.items():
            assert row[name] == pytest.approx(exact(own, p), rel=1e-9, abs=1e-9)


def one(spark, data, p):
    return [tuple(r) for r in quantiles.exact_quantiles(spark.createDataFrame(data, SCHEMA), "g", "v", {"q": p}).collect()]


def test_median_of_two_is_the_midpoint(spark):
    assert one(spark, [("a", Decimal("1.01")), ("a", Decimal("1.02"))], 0.5) == [("a", 1.015)]


def test_one_value_holds_most_rows(spark):
    data = [("a", Decimal("5.00"))] * 50 + [("a", Decimal("9.00"))]
    assert one(spark, data, 0.25) == [("a", 5.0)] and one(spark, data, 0.99) == [("a", 7.0)]


def test_empty(spark):
    assert one(spark, [], 0.5) == []
    assert reports.box_plot(quantiles.counted(spark.createDataFrame([], SCHEMA), "g", "v")).collect() == []


def test_many_groups_and_one_that_spans_all_ranges(spark):
    rows = spark.range(300_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'large' ELSE concat('g', cast(id % 200000 AS string)) END AS g", "cast(pmod(id * 7919, 100003) AS decimal(18,2)) / 100 AS v"
    ).withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = quantiles.exact_quantiles(rows, "g", "v", {"q1": 0.25, "median": 0.5})
    want = rows.groupBy("g").agg(F.expr("percentile(v, 0.25)").alias("w1"), F.expr("percentile(v, 0.5)").alias("w2"))
    both = got.join(want, "g", "full")
    assert both.count() == 100_001
    assert both.where("q1 IS NULL OR w1 IS NULL OR abs(q1 - w1) > 1e-9 OR abs(median - w2) > 1e-9").count() == 0


def test_no_value_comes_back_to_the_driver(spark, monkeypatch):
    counts = quantiles.counted(spark.createDataFrame([("a", Decimal(1)), ("b", Decimal(3))], SCHEMA), "g", "v")
    for name in ("collect", "first", "toPandas", "head"):
        monkeypatch.setattr(type(counts), name, lambda *a, **b: pytest.fail("collected"))
    quantiles.quantile_table(counts, {"q": 0.5})


def test_box_plot(spark, rows):
    data = [("a", Decimal(v)) for v in (1, 2, 3, 4, 100)] + [("b", Decimal(7))]
    box = reports.box_plot(quantiles.counted(spark.createDataFrame(data, SCHEMA), "g", "v"))
    assert rows(box) == [("a", 2.0, 3.0, 4.0, 1.0, 4.0, 1), ("b", 7.0, 7.0, 7.0, 7.0, 7.0, 0)]
