import random

from platewise.operators.dedup import keep_first

SCHEMA = "k int, a string, b int"


def test_smallest_row_wins_on_any_partitioning(spark, rows):
    data = [(1, "z", 1), (1, "a", 9), (1, "a", 2), (2, None, 5), (2, "c", 0), (3, "x", 1)]
    expected = [(1, "a", 2), (2, None, 5), (3, "x", 1)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(seed + 1)
        assert rows(keep_first(df, ["k"])) == expected


def test_declared_order_comes_first(spark, rows):
    df = spark.createDataFrame([(1, "a", 9), (1, "z", 1)], SCHEMA)
    assert rows(keep_first(df, ["k"], ["b"])) == [(1, "z", 1)]


def test_null_keys_are_one_key(spark, rows):
    df = spark.createDataFrame([(None, "b", 1), (None, "a", 1)], SCHEMA)
    assert rows(keep_first(df, ["k"])) == [(None, "a", 1)]


def test_empty(spark, rows):
    df = spark.createDataFrame([], SCHEMA)
    out = keep_first(df, ["k"])
    assert rows(out) == [] and out.columns == ["k", "a", "b"]


def test_rows_per_key_are_limited_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("cast(id % 3 as int) as k", "'a' as a", "cast(id as int) as b")
    text = plan(keep_first(df, ["k"]))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Exchange hashpartitioning") < text.index("Partial")
