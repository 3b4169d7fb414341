import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from platewise.operators.audit import Trail
from platewise.operators.lookup import hot_keys
from platewise.plans import clean, facts
from platewise.sources.buckets import join_in_place
from platewise.sources.store import Store

REPO = Path(__file__).resolve().parent.parent


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def ids(frame):
    return sorted(r["id"] for r in frame.select("id").collect())


def test_nothing_changes_before_a_commit(spark, store):
    assert store.version() == 0 and store.entries() == {}
    first = store.write("t", spark.range(3))
    assert store.version() == 0 and ids(store.scan("t", first)) == [0, 1, 2]
    assert store.commit({"t": first}) == 1
    second = store.write("t", spark.range(5))
    assert ids(store.read("t")) == [0, 1, 2]
    store.commit({"t": second, "u": store.write("u", spark.range(1))})
    assert ids(store.read("t")) == [0, 1, 2, 3, 4] and ids(store.read("t", version=1)) == [0, 1, 2]
    store.commit({"u": store.append("u", spark.range(7, 8))})
    assert ids(store.read("u")) == [0, 7] and ids(store.read("t")) == [0, 1, 2, 3, 4]


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, store):
    store.commit({"t": store.write("t", spark.range(3))})
    broken = spark.range(0, 1000, 1, 8).withColumn("id", F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")))
    for write in (lambda: store.write("t", broken), lambda: store.write_buckets("t", broken, "id", 2), lambda: store.write_parts("t", broken.withColumn("day", F.col("id") % 3), "day")):
        with pytest.raises(Exception, match="lost"):
            write()
    assert store.version() == 1 and ids(store.read("t")) == [0, 1, 2]
    store.clean()
    assert ids(store.read("t")) == [0, 1, 2]


def test_a_load_that_is_killed_leaves_the_old_rows(spark, store):
    store.commit({"t": store.write("t", spark.range(3))})
    script = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {str(REPO)!r})
        from pyspark.sql import SparkSession
        from platewise.sources.store import Store
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        store = Store(spark, {store.folder!r})
        entry = store.write("t", spark.range(100))
        store._publish = lambda path, text: os._exit(9)  # the rows are there, the version is not
        store.commit({{"t": entry}})
    """)
    assert subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=120).returncode == 9
    assert len(store._children(f"{store.folder}/t")) == 2
    assert store.version() == 1 and ids(store.read("t")) == [0, 1, 2]
    store.clean()
    assert len(store._children(f"{store.folder}/t")) == 1


def test_two_loads_at_a_time(spark, store):
    store.commit({"t": store.write("t", spark.range(1))})
    onto = store.version()
    store.commit({"t": store.write("t", spark.range(2))}, onto)
    with pytest.raises(RuntimeError, match="another load"):
        store.commit({"t": store.write("t", spark.range(9))}, onto)
    assert ids(store.read("t")) == [0, 1]


def test_parts_keep_their_folder_until_their_rows_change(spark, store, plan):
    rows = spark.sql("SELECT id, CAST(nullif(id % 4, 3) AS INT) AS day, CAST(id / 7 AS DOUBLE) AS x FROM range(40)")
    first = store.write_parts("t", rows, "day")
    store.commit({"t": first})
    assert set(first.parts) == {"0", "1", "2", "__HIVE_DEFAULT_PARTITION__"} and first.rows == 40
    same = store.write_parts("t", rows.orderBy(F.desc("id")).repartition(7), "day")
    assert same == first
    other = rows.where("day <=> 0 OR day <=> NULL OR day = 1").withColumn("x", F.when(F.col("id") == 5, -1e0).otherwise(F.col("x")))
    third = store.write_parts("t", other, "day")
    assert [third.parts[d] == first.parts[d] for d in ("0", "1", "__HIVE_DEFAULT_PARTITION__")] == [True, False, True]
    assert "2" not in third.parts
    store.commit({"t": third})
    assert sorted(map(str, store.read("t").collect())) == sorted(map(str, other.collect()))
    assert "PartitionFilters: [isnotnull(day" in plan(store.read("t").where("day = 1"))
    store.commit({"t": store.write_parts("t", rows.limit(0), "day")})
    assert store.read("t").columns == rows.columns and store.read("t").count() == 0


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_line_fact_is_joined_without_a_shuffle(spark, store, plan, no_broadcast):
    from verification.queries import data

    d = data(spark, "/root/testdata/sf0.001")
    d.warehouse
    lines, orders = d.store.bucketed("clean_order_items"), d.store.bucketed("fact_orders")
    joined, hot = facts.fact_order_items_in_place(lines, orders)
    text = plan(joined)
    assert hot is None and "SortMergeJoin" in text and text.count("Bucketed: true") == 2 and "Exchange" not in text
    moved = facts.fact_order_items(clean.clean_order_items(d.sources.order_items), d.warehouse["fact_orders"], hot={})
    assert sorted(map(str, joined.collect())) == sorted(map(str, moved.collect()))
    entry = store.write_dealt("again", joined, "order_id", lines.buckets)
    both = store.bucketed("again", entry).ordinary.join(orders.ordinary.select("order_id", "driver_id"), "order_id")
    assert "Exchange" not in plan(both) and both.count() == joined.count()


def test_hot_keys_lie_beside_the_buckets(spark, store, plan, no_broadcast):
    lines = spark.sql("SELECT id, CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 1200 END AS k FROM range(5000)")
    orders = spark.sql("SELECT id AS k, id % 5 AS v FROM range(1000)")
    hot = hot_keys(lines, ["k"], 1000)
    assert len(hot) == 1
    entries = {"l": store.write_buckets("l", lines, "k", 4, hot), "o": store.write_buckets("o", orders, "k", 4)}
    store.commit(entries)
    left = store.bucketed("l")
    ordinary, beside = join_in_place(left, store.bucketed("o"))
    assert "Exchange" not in plan(ordinary) and "BroadcastHashJoin" in plan(beside)
    assert sorted(ordinary.unionByName(beside).collect()) == sorted(lines.join(orders, "k").select("k", "id", "v").collect())
    assert ids(store.read("l")) == ids(lines) and beside.count() == lines.where("k = 7").count()
    with pytest.raises(ValueError):
        join_in_place(left, store.bucketed("o", store.write_buckets("o", orders, "k", 5)))


def test_a_bucketed_table_is_known_in_another_session(spark, store):
    store.commit({"t": store.write_buckets("t", spark.range(20).withColumn("d", F.lit("2024-01-01").cast("date")), "id", 3)})
    from platewise.sources.buckets import forget_buckets

    forget_buckets(spark, f"{store.folder}/t/{store.entries()['t'].parts[''].path}")
    assert ids(store.read("t")) == list(range(20)) and store.bucketed("t").ordinary.schema["d"].dataType.simpleString() == "date"


def test_trail_counts_the_steps_of_a_write(spark, tmp_path):
    orders = spark.createDataFrame(
        [(1, 1, 1, "2024-01-01 00:00:00"), (1, 1, 1, "2024-01-02 00:00:00"), (2, None, 1, "2024-01-01 00:00:00"), (3, 1, 1, "bad"), (None, 1, 1, "2024-01-01 00:00:00"),
         (None, 2, 1, "2024-01-01 00:00:00")], "order_id int, user_id int, merchant_id int, order_time string",
    )
    trail = Trail()
    clean._base(orders, "orders", (), trail, clean.coerce_order_time)
    trail.left("orders", "later", 0)
    assert [tuple(r) for r in trail.lines(spark).collect()] == [
        ("orders", "dedup", 6, 4, 2, 33.3), ("orders", "drop_null_keys", 4, 2, 2, 50.0), ("orders", "drop_invalid", 2, 1, 1, 50.0), ("orders", "later", 1, 0, 1, 100.0)]
    assert Trail().lines(spark).count() == 0
