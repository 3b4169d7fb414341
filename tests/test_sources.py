from datetime import date

import pytest

from platewise import workspace
from platewise.sources import readers, schemas, writers
from platewise.sources.staging import SQL, stage
from platewise.sources.store import Store


def test_csv_round_trip_keeps_leading_zeros(spark, tmp_path):
    users = spark.createDataFrame([("u1", "A", "e", "0812", date(1990, 1, 2), "M", "medan", "n", 1.5, 2.5, None, 1)], schemas.USERS)
    writers.write_csv(users, str(tmp_path / "users.csv"))
    back = readers.read_csv(spark, str(tmp_path / "users.csv"), schemas.USERS)
    assert back.collect() == users.collect() and back.first()["phone"] == "0812"


def test_all_source_tables_by_folder(spark, tmp_path):
    for name, schema in schemas.SOURCE_TABLES.items():
        writers.write_csv(spark.createDataFrame([], schema), str(tmp_path / f"{name}.csv"))
    tables = readers.read_csv_sources(spark, str(tmp_path))
    assert set(tables) == set(schemas.SOURCE_TABLES)


def test_reload_skips_creates_and_keeps_the_table_types(spark, tmp_path):
    path, store = str(tmp_path / "t.csv"), Store(spark, str(tmp_path / "store"))
    assert writers.reload_from_csv(store, path, "a STRING, b INT", "t") is None and store.version() == 0
    writers.write_csv(spark.createDataFrame([("x", 1), ("y", 2)], "a string, b int"), path)
    assert writers.reload_from_csv(store, path, "a STRING, b INT", "t") == 2
    store.commit({"t": store.write("t", spark.sql("SELECT CAST(9 AS BIGINT) AS b, 'old' AS a"))})
    assert writers.reload_from_csv(store, path, "a STRING, b INT", "t") == 2
    assert store.read("t").dtypes == [("b", "bigint"), ("a", "string")]
    assert sorted(store.read("t").collect()) == [(1, "x"), (2, "y")]


def test_replace_table(spark):
    for n in (3, 2):
        writers.write_table(spark.range(n), "platewise_replace_test")
    assert spark.table("platewise_replace_test").count() == 2
    spark.sql("DROP TABLE platewise_replace_test")


def test_partitioned_write(spark, tmp_path, plan):
    df = spark.range(50).selectExpr("id", "cast(id % 3 as int) as date_id")
    writers.write_parquet(df, str(tmp_path / "f"), ["date_id"])
    writers.write_parquet(df, str(tmp_path / "f"), ["date_id"])
    back = readers.read_parquet(spark, str(tmp_path / "f"))
    assert back.count() == 50 and "PartitionFilters: [isnotnull(date_id" in plan(back.where("date_id = 1"))


def test_samples_are_ordered_by_key(spark, rows):
    out = readers.sample_rows({"t": spark.range(100, 0, -1)}, {"t": "id"}, 3)["t"]
    assert rows(out) == [(1,), (2,), (3,)]


def test_intermediate_tables_go_to_the_folder_named_in_the_session(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "_DIR_KEY", "spark.platewise.test.dir")
    spark.conf.set("spark.platewise.test.dir", str(tmp_path))
    out = workspace.materialise(spark.range(5), "x")
    assert out.count() == 5 and all(str(tmp_path) in f for f in out.inputFiles())
    spark.conf.unset("spark.platewise.test.dir")
    assert workspace.shared_dir(spark).startswith("/")


@pytest.mark.parametrize("name", SQL)
def test_staging_views_keep_every_row(spark, name):
    folder = "/root/testdata/sf0.001"
    base = {"users": "customer", "drivers": "supplier", "merchants": "supplier", "products": "part", "orders": "orders",
            "order_items": "lineitem", "catalogue_v1": "part", "catalogue_v2": "part", "transactions": "lineitem"}
    n = stage(spark, folder, name).count()
    if name in base:
        assert n >= spark.read.parquet(f"{folder}/{base[name]}.parquet").count()
    assert n > 0
