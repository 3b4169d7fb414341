from pyspark.sql import functions as F

from platewise import workspace
from platewise.operators import dedup
from platewise.operators.dedup import keep_first, keep_first_of_many
from platewise.sources.buckets import default_buckets


def copies(spark):
    """Key 0 holds half of the rows, the other keys a few each."""
    return spark.range(0, 400, 1, 3).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 101).alias("k"), (-F.col("id")).alias("v"))


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 10)
    assert [default_buckets(spark, n) for n in (0, 40, 41, 1000)] == [4, 4, 5, 100]


def test_first_rows_of_many(spark, rows, plan, monkeypatch):
    df = copies(spark)
    expected = rows(keep_first(df, ["k"]))
    assert "REPARTITION_BY_NUM" not in plan(keep_first_of_many(df, "k"))
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 50)
    with_hot = keep_first_of_many(df, "k")
    assert ", 8), REPARTITION_BY_NUM" in plan(with_hot) and "Union" in plan(with_hot)
    assert rows(with_hot) == expected
    monkeypatch.setattr(dedup, "hot_keys", lambda *_: {})
    without = keep_first_of_many(df, "k")
    assert ", 8), REPARTITION_BY_NUM" in plan(without) and "Union" not in plan(without)
    assert rows(without) == expected
