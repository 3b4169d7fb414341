from decimal import Decimal as D

import pytest

from platewise.plans import catalogue
from platewise.sources import schemas


@pytest.fixture
def raw_v2(spark):
    return spark.createDataFrame(
        [(" Warung ", "sby EAST", "Nasi", "d", "p1", 1, 1, 0, "x"), ("Warung", " SBY east", "Nasi", "d", "p1", 1, 1, 0, "x"),
         ("Warung", "medan", None, "d", "p2", 2, 1, 0, "y")], schemas.CATALOGUE_V2)


def test_merchants_are_found_by_their_cleaned_name(raw_v2, rows):
    assert rows(catalogue.catalogue_merchants(raw_v2), "merchant_name", "merchant_area", "city") == [
        ("Warung", "Medan", "medan"), ("Warung", "Sby East", "surabaya")]
    assert catalogue.with_merchant_key(raw_v2).select("merchant_id").distinct().count() == 2


def test_products_are_distinct_and_classified(raw_v2, rows):
    assert rows(catalogue.catalogue_products(raw_v2), "product", "category") == [("p1", "Nasi & Lauk"), ("p2", "Unknown")]
    assert rows(catalogue.catalogue_v2(raw_v2), "product", "city") == [("p1", "surabaya"), ("p2", "medan")]
    assert rows(catalogue.category_profile(catalogue.catalogue_products(raw_v2))) == [
        ("Nasi & Lauk", 1, 2), ("Unknown", 1, 2)]


def test_keys_need_no_join(raw_v2, plan):
    assert "Join" not in plan(catalogue.with_merchant_key(raw_v2))
    assert "Exchange" not in plan(catalogue.with_merchant_key(raw_v2))


def test_catalogue_v1(spark):
    df = spark.createDataFrame(
        [("ab-cd-ef-gh-ij", "{'average': 4.6, 'total': 0}", "2", " Name ", "1", None, "['kopi']", "x", None, "nan", "bantul"),
         ("abcdefgh", "bad", "4", "Other", "0", None, None, "1.5", "2.5", "Brand", None)],
        "uid string, ratings string, priceLevel string, displayName string, status string, openPeriods string, tags string, "
        "`location.latitude` string, `location.longitude` string, `brand.displayName` string, city string")
    out = catalogue.catalogue_v1(df).collect()
    assert len(out) == 1  # same normalised key: the smaller name stays
    assert tuple(out[0]) == ("MRCABCDEFGH", "Name", "Kopi & Cafe", "Bantul", 4.6, None, 2, 10000, 5000, False, True, -7.8,
                             110.36, None)


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [("t1", 2, "b"), ("t1", 1, "a"), ("t2", 3, "c"), ("t1", 10, "z"), (None, 1, "a")],
        "basket string, item int, label string")


def test_basket_lists(lines, rows):
    out = catalogue.basket_list(lines, "basket", "item", "label")
    assert rows(out) == [("t1", 0, "1,2,10", "a,b,z", 3), ("t2", 0, "3", "c", 1)]
    again = catalogue.basket_explode(lines, "basket", "item", "label")
    assert rows(again) == [("t1", 0, "1", "a"), ("t1", 1, "2", "b"), ("t1", 2, "10", "z"), ("t2", 0, "3", "c")]


def test_a_comma_in_a_name_stays_with_its_item(spark, rows):
    lines = spark.createDataFrame([("t", 1, "Nasi, Ayam"), ("t", 2, "Es")], "basket string, item int, label string")
    assert rows(catalogue.basket_explode(lines, "basket", "item", "label")) == [("t", 0, "1", "Nasi, Ayam"), ("t", 1, "2", "Es")]


def test_a_huge_basket_follows_the_rule_of_small_ones(spark):
    lines = spark.range(5000).selectExpr("if(id % 50 = 0, concat('s', id), 't1') as basket", "id as item", "concat('n', id) as label")
    expected = sorted(i for i in range(5000) if i % 50)
    found = catalogue.basket_explode(lines, "basket", "item", "label").where("basket = 't1'").orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(len(expected)))
    assert [int(r["product_id"]) for r in found] == expected
    out = catalogue.basket_list(lines, "basket", "item", "label", per_row=100).where("basket = 't1'").orderBy("part").collect()
    assert [r["part"] for r in out] == list(range(49)) and {r["n_items"] for r in out} == {4900}
    assert [int(i) for r in out for i in r["product_ids"].split(",")] == expected
    parts = catalogue.basket_positions(lines, "basket", "item", "label")
    assert parts.count() == 5000


def test_basket_totals(spark, rows):
    lines = spark.createDataFrame([(1, D(5), 2), (1, D(1), 1), (2, D(1), 1), (3, None, 2)], "order_id int, unit_price decimal(18,2), quantity int")
    orders = spark.createDataFrame([(1, D(3), D(0)), (2, D(0), D(9)), (3, D(1), None)],
                                   "order_id int, delivery_fee decimal(18,2), discount decimal(18,2)")
    assert rows(catalogue.basket_totals(lines, orders), "order_id", "items_subtotal", "basket_total") == [
        (1, D(11), D(14)), (2, D(1), D(0)), (3, D(0), None)]
