"""Staging views: order-management tables in the shape of the delivery sources.

The text is valid in Spark SQL and in DuckDB. Defects (nulls, duplicates, orphans, unreadable times) are planted as
value rules on the keys; every view reads its whole input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("customer", "supplier", "part", "orders", "lineitem")

_CITY = "CASE WHEN {k} % 3 = 0 THEN 'jakarta' WHEN {k} % 3 = 1 THEN 'surabaya' ELSE 'medan' END"

SQL = {
    "users": f"""
SELECT c_custkey AS user_id,
  CASE WHEN c_custkey % 83 = 0 THEN NULL ELSE c_name END AS full_name,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE concat(lower(c_mktsegment), '@example.org') END AS email,
  concat('08', CAST(c_custkey + 1000000 AS STRING)) AS phone,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE {_CITY.format(k="c_custkey")} END AS city,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN c_custkey % 19 = 0 THEN NULL
       ELSE CAST(DATE '1964-01-01' + INTERVAL '1' DAY * CAST(c_custkey * 7 % 15000 AS INT) AS DATE) END AS date_of_birth,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS address_area,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE (c_custkey % 100) * 0.01e0 - 7e0 END AS lat,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE (c_custkey % 100) * 0.01e0 + 106e0 END AS lon,
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS is_active
FROM {{customer}}
UNION ALL
SELECT c_custkey, 'zz duplicate', 'dup@example.org', '0800', 'jakarta', 'M', DATE '1990-01-01', 'DUP', 0e0, 0e0, 1
FROM {{customer}} WHERE c_mktsegment = 'MACHINERY'
""",
    "drivers": f"""
SELECT s_suppkey AS driver_id, s_name AS full_name, concat('08', CAST(s_suppkey + 5000 AS STRING)) AS phone,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 6 = 0 THEN 'Mobil' ELSE 'Motor' END AS vehicle_type,
  {_CITY.format(k="s_suppkey")} AS city,
  'area' AS current_area,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 3.5e0 + (s_suppkey % 16) * 0.1e0 END AS rating,
  CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE CAST(s_suppkey * 3 AS INT) END AS total_trips,
  CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 1 END AS is_active
FROM {{supplier}}
""",
    "merchants": f"""
SELECT s_suppkey AS merchant_id, s_name AS merchant_name,
  CASE WHEN s_nationkey % 3 = 0 THEN 'Seafood' WHEN s_nationkey % 3 = 1 THEN 'Pizza' ELSE 'Padang' END AS category,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'area' END AS area,
  {_CITY.format(k="s_suppkey")} AS city,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE (s_suppkey % 100) * 0.01e0 - 7e0 END AS lat,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE (s_suppkey % 100) * 0.01e0 + 106e0 END AS lon,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 3.5e0 + (s_suppkey % 16) * 0.1e0 END AS rating,
  CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 1 END AS is_active
FROM {{supplier}}
""",
    "products": """
SELECT p_partkey AS product_id, p_partkey % (SELECT count(*) FROM {supplier}) AS merchant_id,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS product_name,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS category,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS price,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 1 END AS is_available
FROM {part}
""",
    "orders": f"""
SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE o_custkey END AS user_id,
  (o_orderkey * 5) % (SELECT count(*) FROM {{supplier}}) AS driver_id,
  (o_custkey + o_orderkey * 3) % (SELECT count(*) FROM {{supplier}}) AS merchant_id,
  {_CITY.format(k="o_custkey")} AS city,
  CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'cancelled_by_customer'
       ELSE 'cancelled_by_driver' END AS status,
  CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE o_orderpriority END AS payment_method,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS subtotal,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL
       ELSE CAST(2000 + (o_orderkey % 46) * 500 AS DECIMAL(18,2)) END AS delivery_fee,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST((o_orderkey % 4) * 5000 AS DECIMAL(18,2)) END AS discount,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(2000 + (o_orderkey % 46) * 500 AS DECIMAL(18,2))
                 AS DECIMAL(18,2)) END AS total_amount,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE (o_orderkey * 13 % 1500) * 0.01e0 END AS distance_km,
  CASE WHEN o_orderkey % 97 = 0 THEN 'not a date'
       WHEN o_orderkey % 89 = 0 THEN concat(CAST(o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 37 % 1440 AS INT) AS STRING), '.125')
       WHEN o_orderkey % 83 = 0
       THEN replace(CAST(o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 37 % 1440 AS INT) AS STRING), ' ', 'T')
       ELSE CAST(o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 37 % 1440 AS INT) AS STRING) END AS order_time,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 301 <> 0
       THEN o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 37 % 1440 + 10 + o_orderkey % 60 AS INT)
       END AS delivered_time,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'north' ELSE 'south' END AS delivery_area,
  (o_orderkey % 90) * 0.001e0 - 6.2e0 AS delivery_lat, (o_orderkey % 70) * 0.001e0 + 106.8e0 AS delivery_lon,
  (o_orderkey % 60) * 0.001e0 - 6.2e0 AS pickup_lat, (o_orderkey % 80) * 0.001e0 + 106.8e0 AS pickup_lon
FROM {{orders}}
""",
    "order_items": """
SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
  CASE WHEN l_partkey % 101 = 0 THEN l_orderkey + 10000000 ELSE l_orderkey END AS order_id,
  l_partkey AS product_id, l_suppkey AS merchant_id, 'item' AS product_name,
  CASE WHEN l_partkey % 13 = 0 THEN 'Burger' WHEN l_returnflag = 'A' THEN 'Seafood' WHEN l_returnflag = 'N' THEN 'Pizza' ELSE 'Padang' END AS category,
  CASE WHEN l_partkey % 59 = 0 THEN NULL WHEN l_partkey % 61 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
  CASE WHEN l_linenumber = 7 AND l_partkey % 3 = 0 THEN NULL
       ELSE CAST(900 + l_partkey % 1000 AS DECIMAL(18,2)) END AS unit_price,
  CASE WHEN l_linenumber = 6 AND l_partkey % 4 = 0 THEN NULL
       ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS subtotal
FROM {lineitem}
""",
    "reviews": """
SELECT o_orderkey AS review_id, o_orderkey AS order_id, o_custkey AS user_id,
  (o_custkey + o_orderkey * 3) % (SELECT count(*) FROM {supplier}) AS merchant_id,
  (o_orderkey * 5) % (SELECT count(*) FROM {supplier}) AS driver_id,
  CAST(1 + o_orderkey % 5 AS INT) AS merchant_rating, CAST(1 + o_orderkey % 4 AS INT) AS driver_rating
FROM {orders}
""",
    "weather_readings": f"""
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'bogor' ELSE {_CITY.format(k="o_custkey")} END AS city,
  o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 37 % 1440 AS INT) AS time,
  CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE 295e0 + (o_orderkey * 5) % 15 END AS temp_k,
  CASE WHEN o_orderkey % 73 = 0 THEN NULL
       ELSE 295e0 + (o_orderkey * 5) % 15 - (o_orderkey * 7) % 12 END AS dewpoint_k,
  CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE (o_orderkey % 9) * 0.0003e0 END AS rain
FROM {{orders}}
""",
    # The same readings by place: a part of a cell away from the city's point, and some of them outside of it.
    "weather_points": """
SELECT CASE o_custkey % 3 WHEN 0 THEN -6.2e0 WHEN 1 THEN -7.25e0 ELSE 3.59e0 END + (o_orderkey % 17) * 0.004e0 - 0.032e0 AS lat,
  CASE o_custkey % 3 WHEN 0 THEN 106.8e0 WHEN 1 THEN 112.75e0 ELSE 98.67e0 END + (o_orderkey % 13) * 0.006e0 - 0.036e0 AS lon,
  o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 37 % 1440 AS INT) AS time,
  CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE 295e0 + (o_orderkey * 5) % 15 END AS temp_k,
  CASE WHEN o_orderkey % 73 = 0 THEN NULL
       ELSE 295e0 + (o_orderkey * 5) % 15 - (o_orderkey * 7) % 12 END AS dewpoint_k,
  CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE (o_orderkey % 9) * 0.0003e0 END AS rain
FROM {orders}
""",
    "catalogue_v1": """
SELECT concat(CAST(10000000 + p_partkey % 1500 AS STRING), '-ab-', CAST(p_partkey AS STRING)) AS uid,
  CASE WHEN p_partkey % 23 = 0 THEN '{{''average'': 3.5, ''total'': 9999999999}}' ELSE
  CASE p_partkey % 4 WHEN 0 THEN '{{''average'': 4.6, ''total'': 12}}' WHEN 1 THEN '{{''average'': 0, ''total'': 0}}'
    WHEN 2 THEN 'broken' ELSE NULL END END AS ratings,
  CASE p_partkey % 5 WHEN 4 THEN 'x' WHEN 3 THEN NULL ELSE CAST(p_partkey % 5 + 1 AS STRING) END AS "priceLevel",
  concat(' ', p_name, ' ') AS "displayName",
  CASE p_partkey % 3 WHEN 0 THEN '1' WHEN 1 THEN ' 1 ' ELSE '0' END AS status,
  CASE p_partkey % 3 WHEN 0 THEN '[{{''startTime'': {{''hours'': 0}}, ''endTime'': {{''hours'': 23}}}}]'
    WHEN 1 THEN '[{{''startTime'': {{''hours'': 9}}, ''endTime'': {{''hours'': 23}}}}]' ELSE NULL END AS "openPeriods",
  CASE p_partkey % 7 WHEN 0 THEN '[''Ayam'', ''Nasi'']' WHEN 1 THEN '[''Kopi'']' WHEN 2 THEN '[''Indonesia'']'
    WHEN 3 THEN '[''Soto'', ''Bakmi'']' WHEN 4 THEN '[]' WHEN 5 THEN NULL ELSE '[''ICE CREAM'']' END AS tags,
  CASE WHEN p_partkey % 6 = 0 THEN 'n/a' ELSE CAST(-7 - p_partkey % 9 AS STRING) END AS "location.latitude",
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(110 + p_partkey % 9 AS STRING) END AS "location.longitude",
  CASE p_partkey % 4 WHEN 0 THEN ' nan ' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE p_brand END AS "brand.displayName",
  CASE p_partkey % 6 WHEN 0 THEN 'Sleman' WHEN 1 THEN ' kota depok baru' WHEN 2 THEN 'BANDUNG''s barat-daya'
    WHEN 3 THEN ' nan ' WHEN 4 THEN NULL ELSE 'Yogyakarta, Sleman' END AS city
FROM {part}
""",
    "catalogue_v2": """
SELECT concat(' ', p_brand, ' ') AS merchant_name,
  CASE p_partkey % 5 WHEN 0 THEN ' south jakarta' WHEN 1 THEN 'SBY east' WHEN 2 THEN 'medan kota '
    WHEN 3 THEN 'surabaya, jakarta' ELSE 'elsewhere' END AS merchant_area,
  CASE p_partkey % 18 WHEN 0 THEN ' Ayam Geprek ' WHEN 1 THEN 'Es Teh Manis' WHEN 2 THEN 'Nasi Goreng'
    WHEN 3 THEN 'Steak' WHEN 4 THEN 'Ramen' WHEN 5 THEN 'plain' WHEN 6 THEN NULL WHEN 7 THEN 'Soto Padang'
    WHEN 8 THEN 'Udang Saus' WHEN 9 THEN 'Burger Keju' WHEN 10 THEN 'Calzone' WHEN 11 THEN 'Gyoza' WHEN 12 THEN 'Bulgogi'
    WHEN 13 THEN 'Brownies' WHEN 14 THEN 'Omelette' WHEN 15 THEN 'Sayur' WHEN 16 THEN 'Gulai' ELSE 'Cilok' END AS category,
  p_type AS display, p_name AS product, CAST(floor(p_retailprice) AS INT) AS price,
  CAST(p_size * 100 AS INT) AS discount_price, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS "isDiscount",
  concat(p_name, ' / ', p_type) AS description
FROM {part}
""",
    "transactions": """
SELECT concat('TRX', CAST(l_orderkey AS STRING)) AS transaction_id, l_suppkey AS customer_id, l_partkey AS product_id,
  CASE WHEN l_partkey % 11 = 0 THEN concat(p_name, ', extra') ELSE p_name END AS product_name, CASE WHEN l_returnflag = 'R' THEN 'Dibatalkan' ELSE 'Selesai' END AS order_status,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS total_payment,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE 3e0 + (l_partkey % 20) * 0.1e0 END AS rating_merchant,
  CASE WHEN l_linestatus = 'F' THEN NULL ELSE 3.5e0 + (l_suppkey % 15) * 0.1e0 END AS rating_driver,
  CASE l_suppkey % 3 WHEN 0 THEN 'KOTA depok' WHEN 1 THEN 'barat-daya' ELSE 'medan''s timur' END AS city
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
""",
}


def spark_sql(name: str) -> str:
    """Statement in Spark's quoting."""
    return SQL[name].replace('"', "`")


def duckdb_sql(name: str) -> str:
    """Statement over the plain table names, for the reference check."""
    return SQL[name].format(**{t: t for t in BASE_TABLES}).strip()


def stage(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One staging view over the Parquet tables of ``folder``."""
    text = spark_sql(name)
    inputs = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **inputs)
