import random

import pytest
from pyspark.sql import functions as F

from platewise.operators import keysets


def count(child, parent):
    return keysets.rows_without_parent(child, "k", parent, "p").first()["orphans"]


def plain(child, parent):
    known = {r["p"] for r in parent.collect()}
    return sum(1 for r in child.collect() if r["k"] is None or r["k"] not in known)


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint", "string"])
def test_equals_a_plain_count(spark, kind):
    rng = random.Random(2)
    span = [0, 1, -1, 127, -128, 5, 77] if kind == "tinyint" else [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 65536, 65537, 2**31 - 1, -(2**31)]
    child = [(rng.choice([*span, None]),) for _ in range(300)]
    parent = [(v,) for v in rng.sample(span, len(span) // 2)] * 2 + [(None,)]
    child, parent = spark.createDataFrame(child, "k bigint"), spark.createDataFrame(parent, "p bigint")
    child, parent = child.select(F.col("k").cast(kind)), parent.select(F.col("p").cast(kind))
    assert count(child, parent) == plain(child, parent) > 0


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_mixed_whole_and_clean_buckets(spark, monkeypatch, broadcast):
    monkeypatch.setattr(keysets, "BROADCAST_BUCKETS", broadcast)
    parent = spark.range(1, 100_001).selectExpr("id AS p")
    fits = spark.range(1, 200_001).selectExpr("id % 100000 + 1 AS k")
    assert count(fits, parent) == 0
    far = spark.range(3000).selectExpr("id % 500 + 5000000 AS k")  # a bucket of its own
    mixed = spark.range(4000).selectExpr("100001 + id % 40 AS k")  # beside known keys
    missing = spark.range(7).selectExpr("CAST(NULL AS bigint) AS k")
    assert count(fits.union(far).union(mixed).union(missing), parent) == 7007
    assert count(far, parent.limit(0)) == 3000 and count(far.limit(0), parent) == 0


def test_a_row_for_each_bucket_is_shuffled(spark, plan):
    keys = spark.range(0, 300_000, 1, 4).selectExpr("id % 100000 AS k")
    bitmaps = keysets.key_bitmaps([keysets.Relation("r", keys, "k", keys.limit(0), "k")])
    text = plan(bitmaps)
    assert "partial_bitmap_construct_agg" in text and text.count("Exchange hashpartitioning") == 1
    assert bitmaps.count() == 5 and bitmaps.agg(F.sum(F.bitmap_count("bits")), F.sum("rows")).first()[:] == (100_000, 300_000)
    before = keys.groupBy("k").count()
    written = [shuffled(spark, frame) for frame in (bitmaps, before)]
    assert written[0] <= 4 * 5 and written[1] >= 100_000


def test_many_relations_in_one_pass(spark, plan):
    orders = spark.sql("SELECT id AS o, id % 90 AS u, concat('m', id % 5) AS m FROM range(1000)")
    users, merchants = spark.sql("SELECT id AS u FROM range(80)"), spark.sql("SELECT concat('m', id) AS m FROM range(4)")
    relations = [keysets.Relation("user", orders, "u", users, "u"), keysets.Relation("merchant", orders, "m", merchants, "m"),
                 keysets.Relation("itself", users, "u", orders, "o")]
    assert {tuple(r) for r in keysets.orphans(relations).collect()} == {("user", 110), ("merchant", 200), ("itself", 0)}
    assert plan(keysets.key_bitmaps([relations[0], relations[2]])).count("Range (0, 1000") == 1


def shuffled(spark, frame):
    """Rows that the frame's exchange has written."""
    execution = frame._jdf.queryExecution()
    executed = execution.executedPlan()
    executed.execute().count()
    plan, rows = executed.executedPlan(), 0
    stack = [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if "QueryStage" in name:
            stack.append(node.plan())
        elif name == "Exchange":
            rows += node.metrics().apply("shuffleRecordsWritten").value()
        for i in range(node.children().size()):
            stack.append(node.children().apply(i))
    return rows
