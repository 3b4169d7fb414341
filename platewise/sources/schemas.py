"""Fixed schemas of the source tables. Phones are text: read as numbers they would lose the leading zero."""

from __future__ import annotations

USERS = """
    user_id STRING, full_name STRING, email STRING, phone STRING, date_of_birth DATE, gender STRING, city STRING,
    address_area STRING, lat DOUBLE, lon DOUBLE, created_at TIMESTAMP_NTZ, is_active INT
"""
DRIVERS = """
    driver_id STRING, full_name STRING, phone STRING, vehicle_type STRING, vehicle_plate STRING, current_lat DOUBLE,
    current_lon DOUBLE, current_area STRING, city STRING, rating DOUBLE, total_trips INT, joined_at TIMESTAMP_NTZ,
    is_active INT
"""
MERCHANTS = """
    merchant_id STRING, merchant_name STRING, category STRING, address STRING, area STRING, city STRING, lat DOUBLE,
    lon DOUBLE, phone STRING, rating DOUBLE, is_open INT, joined_at DATE, updated_at DATE, is_active INT
"""
PRODUCTS = """
    product_id STRING, merchant_id STRING, product_name STRING, category STRING, price DECIMAL(18,2),
    is_available INT, created_at DATE
"""
ORDERS = """
    order_id STRING, user_id STRING, driver_id STRING, merchant_id STRING, city STRING, status STRING,
    payment_method STRING, subtotal DECIMAL(18,2), delivery_fee DECIMAL(18,2), discount DECIMAL(18,2),
    total_amount DECIMAL(18,2), distance_km DOUBLE, order_time STRING, delivered_time TIMESTAMP_NTZ,
    delivery_lat DOUBLE, delivery_lon DOUBLE, delivery_area STRING, pickup_lat DOUBLE, pickup_lon DOUBLE,
    pickup_area STRING, day_of_week STRING, is_weekend INT
"""
ORDER_ITEMS = """
    order_item_id STRING, order_id STRING, product_id STRING, merchant_id STRING, product_name STRING,
    category STRING, quantity INT, unit_price DECIMAL(18,2), subtotal DECIMAL(18,2)
"""
REVIEWS = """
    review_id STRING, order_id STRING, user_id STRING, merchant_id STRING, driver_id STRING, merchant_rating INT,
    driver_rating INT, comment STRING, created_at TIMESTAMP_NTZ
"""
WEATHER_READINGS = "city STRING, time TIMESTAMP_NTZ, temp_k DOUBLE, dewpoint_k DOUBLE, rain DOUBLE"
CATALOGUE_V1 = """
    uid STRING, ratings STRING, priceLevel STRING, displayName STRING, description STRING, status STRING,
    openPeriods STRING, createTime STRING, notes STRING, tags STRING, `location.latitude` STRING,
    `location.longitude` STRING, `brand.displayName` STRING, nextCloseTime STRING, postcode STRING, city STRING
"""
CATALOGUE_V2 = """
    merchant_name STRING, merchant_area STRING, category STRING, display STRING, product STRING, price INT,
    discount_price INT, isDiscount INT, description STRING
"""

SOURCE_TABLES = {
    "users": USERS,
    "drivers": DRIVERS,
    "merchants": MERCHANTS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "reviews": REVIEWS,
}

PRIMARY_KEYS = {
    "users": "user_id",
    "drivers": "driver_id",
    "merchants": "merchant_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "reviews": "review_id",
    "dim_date": "date_id",
    "dim_user": "user_id",
    "dim_driver": "driver_id",
    "dim_merchant": "merchant_id",
    "dim_product": "product_id",
    "dim_weather": "weather_id",
    "fact_orders": "order_id",
    "fact_order_items": "order_item_id",
}
