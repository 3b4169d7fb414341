import pytest
from pyspark.sql import functions as F

from platewise.operators.lookup import hot_keys, lookup, rows_without_parent, spread


@pytest.fixture
def lines(spark):
    # A third of the rows has key 7, some have no key, some have no partner.
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 400).alias(
            "k"
        ),
    )


@pytest.fixture
def parents(spark):
    return spark.range(300).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("p"), F.col("id")).alias("name"))


def test_hot_key_is_found(lines):
    hot = hot_keys(lines, ["k"], 900)
    assert hot == {lines.where("k = 7").select(F.xxhash64("k")).first()[0]: 4}
    assert hot_keys(lines, ["k"], 5000) == {}


def test_no_rows_no_hot_keys(spark):
    assert hot_keys(spark.createDataFrame([], "k int"), ["k"], 1) == {}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(lines, parents, rows, how):
    plain = lines.join(parents.withColumn("k", F.col("k").cast("bigint")), "k", how)
    assert rows(lookup(lines, parents, ["k"], how, hot_rows=500), "id", "k", "name") == rows(plain, "id", "k", "name")


def test_spread_join_keeps_repeated_partners(lines, spark, rows):
    twice = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c")], "k int, name string")
    plain = lines.join(twice.withColumn("k", F.col("k").cast("bigint")), "k", "left")
    assert rows(lookup(lines, twice, ["k"], hot_rows=500), "id", "name") == rows(plain, "id", "name")


def test_hot_rows_are_divided(lines):
    hot = hot_keys(lines, ["k"], 900)
    parts = lines.withColumn("part", spread(["k"], dict.fromkeys(hot, 16), lines.columns))
    sizes = {r["part"]: r["count"] for r in parts.where("k = 7").groupBy("part").count().collect()}
    assert len(sizes) == 16 and max(sizes.values()) < 150
    assert parts.where("k <> 7 or k is null").select("part").distinct().collect() == [(0,)]


def test_composite_key(spark, rows):
    left = spark.range(900).selectExpr("id", "'a' as c", "id % 2 as h")
    right = spark.createDataFrame([("a", 0, "x"), ("b", 1, "y")], "c string, h int, v string")
    got = rows(lookup(left, right, ["c", "h"], hot_rows=100), "id", "v")
    assert len(got) == 900 and sum(v == "x" for _, v in got) == 450


def test_rows_without_parent_counts_null_keys(lines, parents):
    expected = sum(
        1 for r in lines.collect() if r["k"] is None or r["k"] >= 300
    )
    assert rows_without_parent(lines, "k", parents, "k").first()["orphans"] == expected


def test_rows_without_parent_on_empty_child(spark, parents):
    assert rows_without_parent(spark.createDataFrame([], "k int"), "k", parents, "k").first()["orphans"] == 0


def test_rows_are_counted_before_the_partner_join(spark, lines, parents, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(rows_without_parent(lines, "k", parents, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("SortMergeJoin"):]
    assert "LeftOuter" in below and below.count("HashAggregate") == 4 and "partial_count(1)" in below


def test_missing_keys_are_divided_too(spark, parents, rows):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 290).alias("k"))
    hot = hot_keys(df, ["k"], 200)
    assert set(hot) == {spark.sql("SELECT xxhash64(CAST(NULL AS BIGINT))").first()[0]}
    parts = df.withColumn("part", spread(["k"], dict.fromkeys(hot, 8), df.columns)).where("k is null").groupBy("part").count()
    assert parts.count() == 8
    plain = df.join(parents.withColumn("k", F.col("k").cast("bigint")), "k", "left")
    with_null = parents.unionByName(spark.createDataFrame([(None, "none")], "k int, name string"))
    assert rows(lookup(df, with_null, ["k"], hot=hot), "id", "name") == rows(plain, "id", "name")


def test_parts_follow_the_size_and_many_hot_keys_are_divided(spark, rows):
    lines = spark.range(40_000).selectExpr("id", "if(id < 20000, -1, id % 500) as k")
    hot = hot_keys(lines, ["k"], 30)
    assert len(hot) == 501 and max(hot.values()) >= 1024 and min(hot.values()) <= 4
    table = spark.range(-1, 400).selectExpr("id as k", "id * 2 as v")
    assert lookup(lines, table, ["k"], hot=hot).where("v is not null and v = 2 * k").count() == lines.where("k < 400").count()
