"""Reference SQL for every registered query, over the same Parquet tables.

The statements are written independently of the DataFrame code: plain row-level joins, window functions, exact integer
arithmetic for half-even rounding, and their own list of fixed values (``values.py``). Only the staging views and the
parameters of the queries are shared.
"""

from __future__ import annotations

import re

from platewise.sources.staging import SQL as STAGING
from platewise.sources.staging import duckdb_sql
from verification import values
from verification.queries import AS_OF, CATEGORIES, HOLIDAYS, LOADED_AT, OPTIONAL_INTS, PERIOD

PRIMARY_KEYS, REQUIRED, CRITICAL_COLUMNS, FOREIGN_KEYS = values.PRIMARY_KEYS, values.REQUIRED, values.CRITICAL_COLUMNS, values.FOREIGN_KEYS

COLUMNS = {
    "users": "user_id full_name email phone city gender date_of_birth address_area lat lon is_active",
    "drivers": "driver_id full_name phone vehicle_type city current_area rating total_trips is_active",
    "merchants": "merchant_id merchant_name category area city lat lon rating is_active",
    "products": "product_id merchant_id product_name category price is_available",
    "orders": "order_id user_id driver_id merchant_id city status payment_method subtotal delivery_fee discount "
    "total_amount distance_km order_time delivered_time delivery_area delivery_lat delivery_lon pickup_lat pickup_lon",
    "order_items": "order_item_id order_id product_id merchant_id product_name category quantity unit_price subtotal",
    "transactions": "transaction_id customer_id product_id product_name order_status total_payment rating_merchant "
    "rating_driver city",
}


def first_rows(table: str, key: str, source: str | None = None) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in COLUMNS[table].split() if c != key)
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM {source or 'stg_' + table}) WHERE rn = 1"
    )


def half_even(total: str, n: str) -> str:
    """total / n rounded half-even to a whole number, in integer arithmetic."""
    rest = f"((({total}) % ({n})) + ({n})) % ({n})"
    quotient = f"((({total}) - ({rest})) // ({n}))"
    return f"CASE WHEN 2 * ({rest}) > ({n}) OR (2 * ({rest}) = ({n}) AND {quotient} % 2 <> 0) " \
           f"THEN {quotient} + 1 ELSE {quotient} END"


def mean_money(column: str) -> str:
    cents = half_even(f"CAST(sum({column} * 100) AS HUGEINT)", f"nullif(count({column}), 0)")
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def mean_double(column: str, scale: int = 2) -> str:
    """Mean of a column whose values have two decimals."""
    units = f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS HUGEINT) * {10 ** (scale - 2)}"
    return f"({half_even(units, f'nullif(count({column}), 0)')}) / {10 ** scale}.0"


def mode_of(table: str, by: str, column: str) -> str:
    return (
        f"SELECT {by}, {column} AS v FROM (SELECT {by}, {column}, row_number() OVER (PARTITION BY {by} "
        f"ORDER BY count(*) DESC, {column}) AS rn FROM {table} WHERE {by} IS NOT NULL AND {column} IS NOT NULL "
        f"GROUP BY {by}, {column}) WHERE rn = 1"
    )


def global_mode(table: str, column: str) -> str:
    return (
        f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


def fill_mean(table: str, by: str, column: str, mean: str, out: str) -> dict[str, str]:
    """CTEs that add ``column`` filled by group mean, then by the mean of the filled column."""
    return {
        f"{out}_m": f"SELECT {by}, {mean} AS v FROM {table} WHERE {by} IS NOT NULL GROUP BY {by}",
        f"{out}_g": f"SELECT t.* REPLACE (coalesce(t.{column}, m.v) AS {column}) FROM {table} t "
        f"LEFT JOIN {out}_m m ON t.{by} = m.{by}",
        out: f"SELECT * REPLACE (coalesce({column}, (SELECT {mean} FROM {out}_g)) AS {column}) FROM {out}_g",
    }


def fill_mode(table: str, by: str, column: str, default: str, out: str) -> dict[str, str]:
    return {
        f"{out}_v": mode_of(table, by, column),
        out: f"SELECT t.* REPLACE (coalesce(t.{column}, m.v, {default}) AS {column}) FROM {table} t "
        f"LEFT JOIN {out}_v m ON t.{by} = m.{by}",
    }


_PARSED = (
    "CASE WHEN regexp_full_match(CAST({c} AS VARCHAR), '\\d{{4}}-\\d\\d-\\d\\d([ T]\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?)?') "
    "THEN TRY_CAST({c} AS TIMESTAMP) END"
)
_RH = (
    "100e0 * exp(17.625e0 * (dewpoint_k - 273.15e0) / (243.04e0 + (dewpoint_k - 273.15e0))) "
    "/ exp(17.625e0 * (temp_k - 273.15e0) / (243.04e0 + (temp_k - 273.15e0)))"
)


def weather_class(humidity: str) -> str:
    return (
        f"CASE WHEN rain > 0.002e0 THEN 'Hujan' WHEN {humidity} > 85e0 THEN 'Berawan' "
        "WHEN temp_k <> 0 AND temp_k - 273.15e0 > 30e0 THEN 'Panas' ELSE 'Cerah' END"
    )


_LABEL = "CASE {c} WHEN 'jakarta' THEN 'DKI Jakarta' WHEN 'surabaya' THEN 'Surabaya' WHEN 'medan' THEN 'Medan' ELSE {c} END"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def classify(column: str, rules, default: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({column}, {quoted(k)})" for k in keywords) + f" THEN {quoted(name)}"
        for name, keywords in rules
    )
    return f"CASE {whens} ELSE {default} END"


_TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower({c}), '[a-z]+|[^a-z]+'), "
    "lambda w: concat(upper(w[1]), w[2:])), '')"
)
_WEEKEND = "CAST(isodow({c}) >= 6 AS INTEGER)"
_DATE_ID = "CAST(strftime({c}, '%Y%m%d') AS INTEGER)"
_DAY_TYPE = "CASE is_weekend WHEN 1 THEN 'Weekend' WHEN 0 THEN 'Weekday' END"


def _age_group() -> str:
    whens = " ".join(f"WHEN age < {upper} THEN '{name}'" for name, upper in values.AGE_GROUPS if upper)
    return f"CASE {whens} ELSE '55+' END"


def ctes() -> dict[str, str]:
    """All shared steps in dependency order; each statement uses only the ones it reaches."""
    c: dict[str, str] = {f"stg_{name}": duckdb_sql(name) for name in STAGING}

    # users
    c["u0"] = f"SELECT * FROM ({first_rows('users', 'user_id')}) WHERE user_id IS NOT NULL AND full_name IS NOT NULL"
    unrounded = "CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100e0 / nullif(count({c}), 0)"
    c |= fill_mode("u0", "city", "gender", "'Unknown'", "u1")
    c |= fill_mode("u1", "city", "date_of_birth", "NULL", "u2")
    # Who still has no birth date goes before the means are taken.
    c["u3"] = "SELECT * FROM u2 WHERE date_of_birth IS NOT NULL"
    c |= fill_mean("u3", "city", "lat", unrounded.format(c="lat"), "u4")
    # After the group fill the values have more decimals, so the overall mean is taken as it is.
    c["u4"] = "SELECT * REPLACE (coalesce(lat, (SELECT avg(lat) FROM u4_g)) AS lat) FROM u4_g"
    c |= fill_mean("u4", "city", "lon", unrounded.format(c="lon"), "u5")
    c["u5"] = "SELECT * REPLACE (coalesce(lon, (SELECT avg(lon) FROM u5_g)) AS lon) FROM u5_g"
    c |= fill_mode("u5", "city", "address_area", "'Unknown'", "u6")
    c["clean_users"] = (
        "SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon, coalesce(is_active, 1) AS is_active) FROM u6"
    )

    # orders
    c["o0"] = (
        f"SELECT * REPLACE ({_PARSED.format(c='order_time')} AS order_time) FROM ({first_rows('orders', 'order_id')}) "
        f"WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND merchant_id IS NOT NULL "
        f"AND {_PARSED.format(c='order_time')} IS NOT NULL"
    )
    c |= fill_mode("o0", "city", "payment_method", "'cash'", "o1")
    c |= fill_mean("o1", "city", "delivery_fee", mean_money("delivery_fee"), "o2")
    c |= fill_mode("o2", "city", "delivery_area", "'Unknown'", "o3")
    c |= fill_mean("o3", "merchant_id", "subtotal", mean_money("subtotal"), "o4")
    c |= fill_mean("o4", "delivery_area", "distance_km", mean_double("distance_km"), "o5")
    c["clean_orders"] = (
        "SELECT * REPLACE (CAST(coalesce(total_amount, subtotal + delivery_fee - coalesce(discount, 0)) "
        "AS DECIMAL(18,2)) AS total_amount, CAST(coalesce(discount, 0) AS DECIMAL(18,2)) AS discount) FROM o5"
    )

    # order lines
    c["i0"] = (
        f"SELECT * FROM ({first_rows('order_items', 'order_item_id')}) WHERE order_item_id IS NOT NULL "
        "AND order_id IS NOT NULL AND product_id IS NOT NULL"
    )
    c |= fill_mean("i0", "product_id", "unit_price", mean_money("unit_price"), "i1")
    c["i2"] = "SELECT * REPLACE (CASE WHEN quantity > 0 THEN quantity ELSE 1 END AS quantity) FROM i1"
    c["clean_order_items"] = (
        "SELECT * REPLACE (CAST(coalesce(subtotal, quantity * unit_price) AS DECIMAL(18,2)) AS subtotal) FROM i2"
    )

    # drivers, merchants, products
    c["d0"] = f"SELECT * FROM ({first_rows('drivers', 'driver_id')}) WHERE driver_id IS NOT NULL AND full_name IS NOT NULL"
    c |= fill_mean("d0", "city", "rating", mean_double("rating"), "d1")
    c["clean_drivers"] = (
        f"SELECT * REPLACE (coalesce(vehicle_type, {global_mode('d1', 'vehicle_type')}, 'motor') AS vehicle_type, "
        "coalesce(total_trips, 0) AS total_trips, coalesce(is_active, 1) AS is_active) FROM d1"
    )
    c["m0"] = (
        f"SELECT * FROM ({first_rows('merchants', 'merchant_id')}) "
        "WHERE merchant_id IS NOT NULL AND merchant_name IS NOT NULL"
    )
    c |= fill_mean("m0", "city", "lat", mean_double("lat", 6), "m1")
    c |= fill_mean("m1", "city", "lon", mean_double("lon", 6), "m2")
    c |= fill_mode("m2", "city", "area", "'Unknown'", "m3")
    c |= fill_mean("m3", "category", "rating", mean_double("rating"), "m4")
    c["clean_merchants"] = "SELECT * REPLACE (coalesce(is_active, 1) AS is_active) FROM m4"
    c["p0"] = (
        f"SELECT * FROM ({first_rows('products', 'product_id')}) "
        "WHERE product_id IS NOT NULL AND merchant_id IS NOT NULL"
    )
    c |= fill_mean("p0", "category", "price", mean_money("price"), "p1")
    c["clean_products"] = (
        f"SELECT * REPLACE (coalesce(product_name, 'Unknown Product') AS product_name, "
        f"coalesce(category, {global_mode('p1', 'category')}, 'Lainnya') AS category, "
        "coalesce(is_available, 1) AS is_available) FROM p1"
    )
    c["clean_transactions"] = (
        "SELECT * REPLACE (coalesce(rating_merchant, 0e0) AS rating_merchant, coalesce(rating_driver, 0e0) "
        f"AS rating_driver), TIMESTAMP '{LOADED_AT}' AS dwh_load_time FROM ("
        + first_rows(
            "transactions",
            "transaction_id",
            "(SELECT * REPLACE (coalesce(rating_merchant, 0e0) AS rating_merchant, "
            "coalesce(rating_driver, 0e0) AS rating_driver) FROM stg_transactions)",
        )
        + ")"
    )

    # weather
    parsed = _PARSED.format(c="order_time")
    c["span"] = (
        f"SELECT CAST(min({parsed}) AS DATE) AS start_date, CAST(max({parsed}) AS DATE) + 1 AS end_date FROM stg_orders"
    )
    c["months"] = (
        "SELECT CAST(range_start AS DATE) AS range_start, CAST(range_start + INTERVAL 1 MONTH AS DATE) AS range_end "
        "FROM (SELECT unnest(generate_series(date_trunc('month', CAST(start_date AS TIMESTAMP)), "
        "CAST(end_date AS TIMESTAMP), INTERVAL 1 MONTH)) AS range_start FROM span)"
    )
    c["obs"] = (
        f"SELECT city, time, avg(temp_k) AS temp_k, avg(rain) AS rain, avg({_RH}) AS humidity FROM stg_weather_readings "
        "WHERE city IN ('jakarta', 'surabaya', 'medan') AND time >= (SELECT min(range_start) FROM months) "
        "AND time < (SELECT max(range_end) FROM months) GROUP BY city, time"
    )
    c["hourly"] = (
        f"SELECT city, {_LABEL.format(c='city')} AS wilayah, date_trunc('hour', time) AS waktu, "
        f"arg_min({weather_class('humidity')}, time) AS cuaca FROM obs GROUP BY 1, 2, 3"
    )
    c["cities"] = "SELECT * FROM (VALUES ('jakarta', -6.2e0, 106.8e0), ('surabaya', -7.25e0, 112.75e0), ('medan', 3.59e0, 98.67e0)) t(city, la, lo)"
    c["near"] = (
        "SELECT city, time, temp_k, dewpoint_k, rain FROM stg_weather_points p, cities WHERE 2 * 6371e0 * asin(sqrt(sin(radians(p.lat - la) / 2) ** 2 "
        "+ cos(radians(p.lat)) * cos(radians(la)) * sin(radians(p.lon - lo) / 2) ** 2)) <= 5.566e0"
    )
    c["near_obs"] = f"SELECT city, time, avg(temp_k) AS temp_k, avg(rain) AS rain, avg({_RH}) AS humidity FROM near GROUP BY city, time"
    c["near_hourly"] = (
        f"SELECT city, {_LABEL.format(c='city')} AS wilayah, date_trunc('hour', time) AS waktu, "
        f"arg_min({weather_class('humidity')}, time) AS cuaca FROM near_obs GROUP BY 1, 2, 3"
    )
    c["dim_weather"] = (
        "SELECT concat(city, '_', strftime(waktu, '%Y%m%d%H')) AS weather_id, city, wilayah, "
        f"CAST(waktu AS TIMESTAMP) AS waktu, {_DATE_ID.format(c='waktu')} AS date_id, "
        "CAST(hour(waktu) AS INTEGER) AS hour, cuaca AS kondisi_cuaca FROM hourly"
    )

    # dimensions
    c["days"] = f"SELECT DISTINCT CAST({parsed} AS DATE) AS d FROM stg_orders WHERE {parsed} IS NOT NULL"
    c["dim_date"] = (
        f"SELECT {_DATE_ID.format(c='d')} AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year, "
        "CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, "
        "CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, CAST(isodow(d) AS INTEGER) AS day_of_week, "
        f"{_WEEKEND.format(c='d')} AS is_weekend FROM days"
    )
    c["aged"] = (
        f"SELECT *, CAST(trunc(date_diff('day', date_of_birth, DATE '{AS_OF}') / 365e0) AS INTEGER) AS age "
        "FROM clean_users"
    )
    c["dim_user"] = (
        f"SELECT user_id, full_name AS user_name, gender, age, {_age_group()} AS age_group, city, "
        "address_area AS user_area, lat AS user_lat, lon AS user_lon, is_active AS user_is_active FROM aged"
    )
    c["dim_driver"] = (
        "SELECT driver_id, full_name AS driver_name, vehicle_type, city, current_area AS driver_area, "
        "rating AS driver_rating, total_trips, is_active AS driver_is_active FROM clean_drivers"
    )
    c["review_avg"] = (
        "SELECT merchant_id, ("
        + half_even("CAST(sum(merchant_rating) AS HUGEINT) * 100", "nullif(count(merchant_rating), 0)")
        + ") / 100.0 AS avg_review_rating FROM stg_reviews WHERE merchant_id IS NOT NULL GROUP BY merchant_id"
    )
    c["dim_merchant"] = (
        "SELECT m.merchant_id, merchant_name, category AS merchant_category, city, area AS merchant_area, "
        "lat AS merchant_lat, lon AS merchant_lon, rating AS merchant_rating, "
        "coalesce(r.avg_review_rating, rating) AS avg_review_rating, is_active AS merchant_is_active "
        "FROM clean_merchants m LEFT JOIN review_avg r ON m.merchant_id = r.merchant_id"
    )
    c["dim_product"] = (
        "SELECT product_id, merchant_id, product_name, category AS product_category, price, is_available "
        "FROM clean_products"
    )

    # facts
    c["fact_orders"] = (
        "SELECT o.order_id, o.user_id, o.driver_id, o.merchant_id, "
        f"{_DATE_ID.format(c='o.order_time')} AS date_id, CAST(hour(o.order_time) AS INTEGER) AS order_hour, "
        f"{_WEEKEND.format(c='o.order_time')} AS is_weekend, o.city, o.status AS order_status, o.payment_method, "
        "o.subtotal, o.delivery_fee, o.discount, o.total_amount, o.distance_km, o.delivery_area, "
        "CASE WHEN o.status = 'delivered' THEN 1 ELSE 0 END AS is_delivered, "
        "CASE WHEN o.status LIKE '%cancel%' THEN 1 ELSE 0 END AS is_cancelled, w.weather_id, "
        "coalesce(w.kondisi_cuaca, 'Tidak Diketahui') AS kondisi_cuaca FROM clean_orders o LEFT JOIN dim_weather w "
        "ON o.city = w.city AND date_trunc('hour', o.order_time) = w.waktu"
    )
    c["fact_order_items"] = (
        "SELECT i.order_item_id, i.order_id, i.product_id, i.merchant_id, f.user_id, f.date_id, f.city, "
        "i.product_name, i.category AS product_category, i.quantity, i.unit_price, i.subtotal AS item_subtotal, "
        "f.order_status, f.weather_id, f.kondisi_cuaca FROM clean_order_items i JOIN fact_orders f "
        "ON i.order_id = f.order_id WHERE f.user_id IS NOT NULL AND f.date_id IS NOT NULL"
    )

    # report bases
    c["delivered"] = "SELECT * FROM fact_orders WHERE order_status = 'delivered'"
    c["revenue"] = (
        "SELECT merchant_id, CAST(coalesce(sum(total_amount), 0) AS DECIMAL(28,2)) AS total_revenue FROM delivered "
        "GROUP BY merchant_id"
    )
    c["delivered_days"] = (
        f"SELECT f.total_amount, d.day_name, CASE f.is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type "
        "FROM delivered f JOIN dim_date d ON f.date_id = d.date_id"
    )
    c["shares"] = (
        "SELECT age_group, product_category, count(*) AS n_lines, round(count(*) * 100e0 / "
        "sum(count(*)) OVER (PARTITION BY age_group), 4) AS pct FROM fact_order_items i JOIN dim_user u "
        "ON i.user_id = u.user_id WHERE order_status = 'delivered' GROUP BY age_group, product_category"
    )
    c["hours"] = (
        f"SELECT order_hour, CASE f.is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type, "
        "count(*) AS n_orders FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id GROUP BY 1, 2"
    )
    c["known"] = "SELECT * FROM fact_orders WHERE kondisi_cuaca <> 'Tidak Diketahui'"
    c["daily_avg"] = (
        "SELECT city, kondisi_cuaca, round(avg(n), 4) AS avg_orders FROM (SELECT city, kondisi_cuaca, date_id, "
        "count(*) AS n FROM known WHERE city IN ('jakarta', 'medan') GROUP BY ALL) GROUP BY city, kondisi_cuaca"
    )

    # catalogue
    c["v2"] = (
        f"SELECT * REPLACE (trim(merchant_name) AS merchant_name, {_TITLE.format(c='trim(merchant_area)')} "
        "AS merchant_area) FROM stg_catalogue_v2"
    )
    c["v2_merchants"] = (
        "SELECT DISTINCT merchant_name, merchant_area, sha256(concat('=', merchant_name, chr(1), '=', merchant_area)) "
        "AS merchant_id FROM v2"
    )
    city = (
        "CASE WHEN contains(lower({c}), 'jakarta') THEN 'jakarta' WHEN contains(lower({c}), 'surabaya') THEN 'surabaya' "
        "WHEN contains(lower({c}), 'medan') THEN 'medan' WHEN contains(lower({c}), 'sby') THEN 'surabaya' "
        "ELSE 'jakarta' END"
    )
    category = classify("trim(lower(category))", values.PRODUCT_CATEGORIES.items(), "'Unknown'")
    c["v2_rows"] = (
        "SELECT DISTINCT m.merchant_id, v.merchant_name, v.merchant_area, category, display, product, price, "
        'discount_price, "isDiscount", description FROM v2 v JOIN v2_merchants m ON v.merchant_name = m.merchant_name '
        "AND v.merchant_area = m.merchant_area"
    )
    c["catalogue_v2"] = (
        f"SELECT * REPLACE ({category} AS category), {city.format(c='merchant_area')} AS city FROM v2_rows"
    )
    c["v2_area_city"] = f"SELECT product, {city.format(c='merchant_area')} AS city FROM stg_catalogue_v2"
    c["v2_category"] = f"SELECT product, {category} AS category FROM stg_catalogue_v2"
    level = "coalesce(TRY_CAST(\"priceLevel\" AS INTEGER), 1)"
    area_default = (
        "CASE WHEN city IS NULL OR trim(lower(city)) IN ('', 'nan', 'none') THEN 'Unknown' "
        f"ELSE {_TITLE.format(c='trim(city)')} END"
    )
    tags = classify("lower(tags)", values.MERCHANT_TAGS.items(), "'Unknown'")
    area = classify("trim(lower(city))", values.AREAS.items(), area_default)
    average = "nullif(TRY_CAST(regexp_extract(ratings, '''average'': ([0-9.]+)', 1) AS DOUBLE), 0)"
    total = "nullif(TRY_CAST(regexp_extract(ratings, '''total'': ([0-9]+)', 1) AS INTEGER), 0)"
    c["v1"] = (
        "SELECT uid, concat('MRC', upper(substr(replace(uid, '-', ''), 1, 8))) AS merchant_id, "
        f'trim("displayName") AS merchant_name, {tags} AS category, {area} AS area, {average} AS rating, '
        f"{total} AS total_reviews, {level} AS price_level, "
        f"CASE {level} WHEN 1 THEN 0 WHEN 2 THEN 10000 WHEN 3 THEN 20000 ELSE 0 END AS min_order, "
        f"CASE {level} WHEN 1 THEN 3000 WHEN 2 THEN 5000 WHEN 3 THEN 9000 ELSE 5000 END AS delivery_fee, "
        "coalesce(contains(lower(\"openPeriods\"), '''hours'': 0') AND contains(lower(\"openPeriods\"), "
        "'''hours'': 23'), false) AS is_open_24h, coalesce(trim(status) = '1', false) AS is_active, "
        'coalesce(TRY_CAST("location.latitude" AS DOUBLE), -7.8e0) AS latitude, '
        'coalesce(TRY_CAST("location.longitude" AS DOUBLE), 110.36e0) AS longitude, '
        "CASE WHEN trim(\"brand.displayName\") NOT IN ('', 'nan', 'None') THEN trim(\"brand.displayName\") END AS brand "
        "FROM stg_catalogue_v1"
    )
    fields = (
        "merchant_name category area rating total_reviews price_level min_order delivery_fee is_open_24h is_active "
        "latitude longitude brand"
    ).split()
    order = ", ".join(f"{f} NULLS FIRST" for f in fields)
    c["catalogue_v1"] = (
        f"SELECT * EXCLUDE (uid, rn) FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY {order}) AS rn "
        "FROM v1) WHERE rn = 1"
    )
    c["basket_lines"] = "SELECT DISTINCT transaction_id, product_id, product_name FROM stg_transactions"
    return c


# ---------------------------------------------------------------- quality


def _line(section: str, name: str, table: str, failing: str, violations: str | None = None, detail: str | None = None,
          what: str = "rows", passed: str | None = None) -> str:
    violations = violations or failing
    detail = detail if detail is not None else f"concat(CAST({violations} AS VARCHAR), ' {what}')"
    return (
        f"SELECT '{section}' AS section, '{name}' AS check_name, "
        f"CASE WHEN {passed or f'coalesce({failing}, 0) = 0'} THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"CAST(coalesce({failing}, 0) AS BIGINT) AS failing, CAST(coalesce({violations}, 0) AS BIGINT) AS violations, "
        f"{detail} AS detail FROM {table}"
    )


def _rule(section: str, name: str, table: str, condition: str, detail: str | None = None, within: str = "true") -> str:
    failing = f"count(*) FILTER (WHERE ({within}) AND NOT coalesce({condition}, false))"
    violations = f"count(*) FILTER (WHERE ({within}) AND NOT ({condition}))"
    return _line(section, name, table, failing, violations, detail)


def _number(value: str) -> str:
    return f"coalesce(CAST(CAST(round_even({value}, 2) AS DECIMAL(28,2)) AS VARCHAR), 'none')"


def _range(value: str) -> str:
    return f"concat('min=', {_number(f'min({value})')}, ' max=', {_number(f'max({value})')})"


def quality_lines() -> dict[str, list[str]]:
    orders = "stg_orders"
    out: dict[str, list[str]] = {}
    out["counts"] = [
        _line("completeness", f"{t} not empty", f"stg_{t}", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
              detail="concat(CAST(count(*) AS VARCHAR), ' rows')")
        for t in CRITICAL_COLUMNS
    ]
    out["fk"] = [
        _line("references", f"{child}.{key} -> {parent}",
              f"stg_{child} c WHERE NOT EXISTS (SELECT 1 FROM stg_{parent} p WHERE p.{pk} = c.{key})", "count(*)",
              what="orphan rows")
        for child, key, parent, pk in FOREIGN_KEYS
    ]
    km = "distance_km IS NOT NULL"
    mean = "avg(distance_km)"
    unlikely = f"CASE WHEN {mean} BETWEEN 1 AND 8 THEN 0 ELSE 1 END"
    out["distance"] = [
        "SELECT 'distance' AS section, 'distance_km present' AS check_name, 'PASS' AS status, CAST(0 AS BIGINT) "
        "AS failing, CAST(0 AS BIGINT) AS violations, '' AS detail",
        _rule("distance", "distance not negative", orders, "distance_km >= 0",
              f"concat('min=', {_number('min(distance_km)')})", km),
        _rule("distance", "distance within radius", orders, "distance_km <= 15",
              f"concat('max=', {_number('max(distance_km)')})", km),
        _line("distance", "mean distance plausible", orders, unlikely, detail=f"concat('mean=', {_number(mean)})"),
        _rule("distance", "no cross-city distance", orders, "distance_km <= 100", None, km),
        _line("distance", "delivery point differs from pickup", orders,
              "count(*) FILTER (WHERE delivery_lat = pickup_lat AND delivery_lon = pickup_lon)"),
    ]
    joined = (
        "(SELECT o.city, u.city AS ucity, m.city AS mcity FROM stg_orders o LEFT JOIN stg_users u "
        "ON o.user_id = u.user_id LEFT JOIN stg_merchants m ON o.merchant_id = m.merchant_id)"
    )
    out["city"] = [
        _line("city", "order city equals merchant city", joined, "count(*) FILTER (WHERE coalesce(city <> mcity, true))"),
        _line("city", "order city equals user city", joined, "count(*) FILTER (WHERE coalesce(city <> ucity, true))"),
    ]
    sums = (
        "(SELECT o.subtotal, s.t FROM stg_orders o LEFT JOIN (SELECT order_id, coalesce(sum(subtotal), 0) AS t "
        "FROM stg_order_items WHERE order_id IS NOT NULL GROUP BY order_id) s ON o.order_id = s.order_id)"
    )
    out["subtotal"] = [
        _line("money", "subtotal equals sum of lines", sums, "count(*) FILTER (WHERE coalesce(subtotal <> t, true))")
    ]
    expected = "subtotal + delivery_fee - discount"
    clipped = f"CASE WHEN {expected} < 0 THEN 0 ELSE {expected} END"
    out["total"] = [
        _line("money", "total equals subtotal + fee - discount", orders,
              f"count(*) FILTER (WHERE coalesce(total_amount <> ({clipped}), true))")
    ]
    out["product_money"] = [_rule("money", "product price positive", "stg_products", "price > 0")]
    out["order_money"] = [
        _rule("money", "delivery fee in range", orders, "delivery_fee BETWEEN 2000 AND 25000", _range("delivery_fee")),
        _rule("money", "total not negative", orders, "total_amount >= 0"),
        _rule("money", "subtotal positive", orders, "subtotal > 0"),
    ]
    t = _PARSED.format(c="order_time")
    minutes = f"date_diff('microsecond', {t}, delivered_time) / 60000000e0"
    done = "status = 'delivered'"
    out["time"] = [
        _rule("time", "order time in period", orders,
              f"{t} BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'",
              f"concat('min=', CAST(CAST(min({t}) AS DATE) AS VARCHAR), ' max=', CAST(CAST(max({t}) AS DATE) AS VARCHAR))"),
        _rule("time", "delivered orders have a delivery time", orders, "delivered_time IS NOT NULL", None, done),
        _rule("time", "delivery takes 10 to 120 minutes", orders, f"{minutes} BETWEEN 10 AND 120",
              _range(f"CASE WHEN {done} THEN {minutes} END"), done),
        _rule("time", "delivered after ordered", orders, f"delivered_time > {t}", None, done),
        _rule("time", "cancelled orders have no delivery time", orders, "delivered_time IS NULL", None,
              "starts_with(status, 'cancelled')"),
    ]
    out["status"] = [
        _rule("status", "order status known", orders,
              "status IN ('delivered', 'cancelled_by_customer', 'cancelled_by_driver')"),
        _rule("status", "merchants rating in range", "stg_merchants", "rating BETWEEN 3.5 AND 5.0", _range("rating")),
        _rule("status", "drivers rating in range", "stg_drivers", "rating BETWEEN 3.5 AND 5.0", _range("rating")),
        _rule("status", "reviews merchant_rating in range", "stg_reviews", "merchant_rating BETWEEN 1 AND 5",
              _range("merchant_rating")),
    ]
    out["reviews"] = [
        _line("status", "reviews only of delivered orders",
              "stg_reviews r WHERE NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = r.order_id "
              "AND o.status = 'delivered')", "count(*)")
    ]
    out["nulls"] = [
        _line("nulls", f"{t}.{col} not null", f"stg_{t}", f"count(*) FILTER (WHERE {col} IS NULL)", what="null values")
        for t, cols in CRITICAL_COLUMNS.items() for col in cols
    ]
    return out


def _audit(table: str, key: str, required: tuple[str, ...], parsed: str | None = None) -> str:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in required)
    firsts = f"({first_rows(table, key)})"
    raw, keys = f"(SELECT count(*) FROM stg_{table})", f"(SELECT count(*) FROM {firsts})"
    kept = f"(SELECT count(*) FROM {firsts} WHERE {complete})"

    def step(name: str, before: str, after: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{name}' AS step, {before} AS rows_before, {after} AS rows_after, "
            f"{before} - {after} AS removed, "
            f"coalesce(round(({before} - {after}) * 100e0 / nullif({before}, 0), 1), 0) AS removed_pct"
        )

    parts = [step("dedup", raw, keys), step("drop_null_keys", keys, kept)]
    if table == "users":
        parts.append(step("drop_missing_birth_date", kept, "(SELECT count(*) FROM u3)"))
    if table == "order_items":
        parts.append(step("drop_orphan_lines", kept, "(SELECT count(*) FROM fact_order_items)"))
    if parsed:
        parts.append(step("drop_invalid", kept, f"(SELECT count(*) FROM {firsts} WHERE {complete} AND {parsed} IS NOT NULL)"))
    return " UNION ALL ".join(parts)


def row_text(table: str) -> str:
    """All columns, by name, as one text; fractions in ten-thousandths."""

    def text(c: str) -> str:
        value = f"CAST(round(CAST({c} AS DOUBLE) * 10000) AS BIGINT)" if c in values.FRACTIONS.get(table, ()) else c
        return f"concat('{c}=', coalesce(CAST({value} AS VARCHAR), '~'))"

    return f"concat_ws('|', {', '.join(text(c) for c in sorted(values.SAMPLED_COLUMNS[table]))})"


def statements() -> dict[str, str]:
    """Final SELECT of every query, over the shared steps."""
    q = quality_lines()

    def union(*groups: str) -> str:
        return " UNION ALL ".join(f"({line})" for g in groups for line in q[g])

    all_checks = union("counts", "fk", "distance", "city", "product_money", "order_money", "subtotal", "total", "time",
                       "status", "reviews", "nulls")
    parsed = _PARSED.format(c="order_time")
    profile = " UNION ALL ".join(
        f"SELECT '{col}' AS column_name, count({col}) AS n_values, count(*) - count({col}) AS n_nulls, "
        f"round(CAST(min({col}) AS DOUBLE), 4) AS min_value, round(CAST(max({col}) AS DOUBLE), 4) AS max_value, "
        f"round(CAST(sum({col}) AS DOUBLE) / count({col}), 4) AS mean_value FROM stg_orders"
        for col in ("total_amount", "delivery_fee", "distance_km")
    )
    audit = " UNION ALL ".join(
        _audit(t, req[0], req, parsed if t == "orders" else None) for t, req in REQUIRED.items()
    )
    staged = ("users", "drivers", "merchants", "products", "orders", "order_items", "reviews")
    samples = " UNION ALL ".join(
        f"(SELECT '{name}' AS table_name, {row_text(name)} AS row FROM {'stg_' + name if name in staged else name} "
        f"ORDER BY {', '.join(f'{c} NULLS FIRST' for c in [key, *[c for c in values.SAMPLED_COLUMNS[name] if c != key]])} LIMIT 20)"
        for name, key in PRIMARY_KEYS.items()
    )
    hour_cells = ", ".join(
        f"coalesce(round(100e0 * count(*) FILTER (WHERE order_hour = {h}) / count(*), 4), 0) AS h{h:02d}" for h in range(24)
    )
    status_cells = ", ".join(
        f"round(100e0 * count(*) FILTER (WHERE order_status = '{s}') / count(*), 4) AS {s}"
        for s in ("delivered", "cancelled_by_customer", "cancelled_by_driver")
    )
    groups = ", ".join(f"({i}, '{name}')" for i, (name, _) in enumerate(values.AGE_GROUPS))
    category_cells = ", ".join(
        f"coalesce(max(pct) FILTER (WHERE product_category = '{c}'), 0) AS \"{c}\"" for c in CATEGORIES
    )
    listed = ", ".join(f"'{c}'" for c in CATEGORIES)
    category_cells += f", round(coalesce(sum(pct) FILTER (WHERE product_category NOT IN ({listed})), 0), 4) AS other"
    holidays = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)
    months = ("Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agt", "Sep", "Okt", "Nov", "Des")
    month_list = "[" + ", ".join(f"'{m}'" for m in months) + "]"
    box = (
        "SELECT day_type, quantile_cont(CAST(total_amount AS DOUBLE), 0.25) AS a, "
        "quantile_cont(CAST(total_amount AS DOUBLE), 0.5) AS b, quantile_cont(CAST(total_amount AS DOUBLE), 0.75) AS c "
        "FROM delivered_days GROUP BY day_type"
    )
    fence = "CAST(total_amount AS DOUBLE) BETWEEN a - 1.5e0 * (c - a) AND c + 1.5e0 * (c - a)"
    loaded = f"TIMESTAMP '{LOADED_AT}' AS dwh_load_time"
    older = " UNION ALL ".join([
        f"SELECT 'dim_merchant' AS table_name, city, {loaded}, count(*) AS n_rows FROM stg_merchants GROUP BY city",
        f"SELECT 'dim_product', NULL, {loaded}, count(*) FROM stg_products",
        f"SELECT 'dim_customer', {_TITLE.format(c='city')}, {loaded}, count(*) FROM stg_users GROUP BY 2",
        f"SELECT 'dim_driver', city, {loaded}, count(*) FROM stg_drivers GROUP BY city",
        f"SELECT 'dim_time', NULL, {loaded}, count(*) FROM (SELECT DISTINCT order_time FROM stg_orders)",
        f"SELECT 'fact_transaction', city, {loaded}, count(*) FROM clean_transactions GROUP BY city",
    ])
    half_lat = "sin(radians(delivery_lat - pickup_lat) / 2)"
    half_lon = "sin(radians(delivery_lon - pickup_lon) / 2)"
    placed = (
        "(SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY product_id, product_name) - 1 AS position, "
        "count(*) OVER (PARTITION BY transaction_id) AS total FROM basket_lines)"
    )
    lists = (
        "SELECT transaction_id, CAST(position // 1000 AS INTEGER) AS part, "
        "string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY position) AS product_ids, "
        "string_agg(product_name, ',' ORDER BY position) AS product_names, any_value(total) AS n_items "
        f"FROM {placed} GROUP BY transaction_id, position // 1000"
    )
    return {
        "sample_rows": samples,
        "weather_date_range": "SELECT * FROM span",
        "month_ranges": "SELECT * FROM months",
        "clean_audit": audit,
        "reload_table": "SELECT total_trips, CAST(driver_id AS VARCHAR) AS driver_id, CAST(CAST(round(rating, 1) AS DECIMAL(3,1)) AS DOUBLE) AS rating "
        "FROM stg_drivers",
        "replaced_parts": "SELECT CAST(date_id // 100 AS INTEGER) AS month, count(*) AS n_orders, CAST(sum(is_delivered) AS BIGINT) AS n_delivered, "
        "CAST(max(CASE WHEN city = 'medan' AND date_id % 100 = 31 AND order_hour >= 22 THEN 1 ELSE 0 END) AS INTEGER) AS rewritten "
        "FROM fact_orders GROUP BY 1",
        "drop_null_keys": "SELECT order_id FROM stg_orders WHERE order_id IS NOT NULL AND user_id IS NOT NULL "
        "AND merchant_id IS NOT NULL",
        "coerce_timestamp": f"SELECT order_id, {parsed} AS order_time FROM stg_orders WHERE {parsed} IS NOT NULL",
        "fill_constants": "SELECT 'orders' AS table_name, order_id AS id, CAST(coalesce(discount, 0) AS DOUBLE) AS value "
        "FROM stg_orders UNION ALL SELECT 'drivers', driver_id, "
        "CAST(coalesce(total_trips, 0) * 10 + coalesce(is_active, 1) AS DOUBLE) FROM stg_drivers",
        "city_labels": f"SELECT city, count(*) AS n_users, {_LABEL.format(c='city')} AS city_label FROM stg_users "
        "GROUP BY city",
        "dedup_keep_first": f"SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon) "
        f"FROM ({first_rows('users', 'user_id')})",
        "impute_mode_by_group": f"SELECT order_id, o.city, coalesce(payment_method, v, 'cash') AS payment_method "
        f"FROM stg_orders o LEFT JOIN ({mode_of('stg_orders', 'city', 'payment_method')}) m ON o.city = m.city",
        "impute_mode_global": f"SELECT driver_id, coalesce(vehicle_type, {global_mode('stg_drivers', 'vehicle_type')}, "
        "'motor') AS vehicle_type FROM stg_drivers",
        "impute_mean_by_group": "WITH "
        + ", ".join(f"{n} AS ({b})" for n, b in
                    fill_mean("stg_orders", "merchant_id", "subtotal", mean_money("subtotal"), "x").items())
        + " SELECT order_id, merchant_id, subtotal FROM x",
        "order_flags": "SELECT order_id, CASE WHEN status = 'delivered' THEN 1 ELSE 0 END AS is_delivered, "
        "CASE WHEN status LIKE '%cancel%' THEN 1 ELSE 0 END AS is_cancelled FROM stg_orders",
        "delivery_duration": f"SELECT order_id, round(date_diff('microsecond', {parsed}, delivered_time) / 60000000e0, 4) AS minutes "
        "FROM stg_orders WHERE status = 'delivered'",
        "haversine_km": f"SELECT order_id, round(2 * 6371e0 * asin(sqrt({half_lat} * {half_lat} + "
        f"cos(radians(pickup_lat)) * cos(radians(delivery_lat)) * {half_lon} * {half_lon})), 6) AS km FROM stg_orders",
        "delivery_fee": "SELECT order_id, CAST(least(2000 + CAST(round_even(distance_km * 2500e0 / 500e0, 0) AS BIGINT) "
        "* 500, CASE WHEN distance_km IS NOT NULL THEN 25000 END) AS INTEGER) AS fee FROM stg_orders",
        "clean_users": "SELECT * FROM clean_users",
        "clean_orders": "SELECT * FROM clean_orders",
        "clean_order_items": "SELECT * FROM clean_order_items",
        "clean_drivers": "SELECT * FROM clean_drivers",
        "clean_merchants": "SELECT * FROM clean_merchants",
        "clean_products": "SELECT * FROM clean_products",
        "clean_transactions": "SELECT * FROM clean_transactions",
        "standardise_city": f"SELECT transaction_id, product_id, customer_id, {_TITLE.format(c='city')} AS city "
        "FROM stg_transactions",
        "older_tables": older,
        "csv_round_trip": "SELECT * FROM stg_drivers",
        "dropped_lines": "SELECT (SELECT count(*) FROM clean_order_items) AS rows_before, "
        "(SELECT count(*) FROM clean_order_items WHERE order_id IN (SELECT order_id FROM clean_orders)) AS rows_after",
        "weather_by_place": "SELECT city, wilayah, CAST(waktu AS TIMESTAMP) AS waktu, cuaca FROM near_hourly",
        "weather_humidity": f"SELECT city, time, round({_RH}, 6) AS humidity FROM stg_weather_readings",
        "weather_classify": f"SELECT city, time, {weather_class('(' + _RH + ')')} AS cuaca FROM stg_weather_readings",
        "hourly_weather": "SELECT city, wilayah, CAST(waktu AS TIMESTAMP) AS waktu, cuaca FROM hourly",
        "dim_weather": "SELECT * FROM dim_weather",
        "weather_lookup_join": "SELECT o.order_id, w.weather_id, coalesce(w.kondisi_cuaca, 'Tidak Diketahui') "
        f"AS kondisi_cuaca FROM stg_orders o LEFT JOIN dim_weather w ON o.city = w.city "
        f"AND date_trunc('hour', {parsed}) = w.waktu WHERE {parsed} IS NOT NULL",
        "weather_unmatched": "SELECT count(*) AS unmatched_orders FROM stg_orders o WHERE "
        f"{parsed} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_weather w WHERE w.city = o.city "
        f"AND w.waktu = date_trunc('hour', {parsed}))",
        "dim_date": "SELECT * FROM dim_date",
        "dim_user": "SELECT * FROM dim_user",
        "dim_driver": "SELECT * FROM dim_driver",
        "dim_merchant": "SELECT * FROM dim_merchant",
        "merchant_review_avg": "SELECT * FROM review_avg",
        "dim_product": "SELECT * FROM dim_product",
        "dim_time_calendar": f"SELECT {_DATE_ID.format(c='d')} AS date_id, d AS full_date, CAST(day(d) AS INTEGER) AS day, "
        f"CAST(month(d) AS INTEGER) AS month, {month_list}[month(d)] AS month_name, "
        "CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, dayname(d) AS day_of_week, "
        f"isodow(d) >= 6 AS is_weekend, d IN ({holidays}) AS is_holiday FROM (SELECT CAST(unnest(generate_series("
        "CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM span)",
        "fact_orders": "SELECT * FROM fact_orders",
        "fact_order_items": "SELECT * FROM fact_order_items",
        "top_merchants": "SELECT r.merchant_id, total_revenue, merchant_name, merchant_category, city, "
        "round(CAST(total_revenue AS DOUBLE) / 1e6, 6) AS revenue_millions FROM revenue r JOIN dim_merchant m "
        "ON r.merchant_id = m.merchant_id ORDER BY total_revenue DESC, r.merchant_id LIMIT 15",
        "weekday_basket": "SELECT CAST(list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', "
        "'Sunday'], day_name) AS INTEGER) AS day_rank, day_name, day_type, "
        "round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 4) AS avg_amount, "
        "round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount) / 1000, 4) AS avg_thousands "
        "FROM delivered_days GROUP BY day_name, day_type",
        "weekend_stats": "SELECT day_type, round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 4) AS mean_amount, "
        "count(total_amount) AS n_orders, round(quantile_cont(CAST(total_amount AS DOUBLE), 0.5), 4) AS median_amount "
        "FROM delivered_days GROUP BY day_type",
        "weekend_boxplot": "SELECT d.day_type, round(any_value(a), 4) AS q1, round(any_value(b), 4) AS median, "
        "round(any_value(c), 4) AS q3, "
        f"round(min(CAST(total_amount AS DOUBLE)) FILTER (WHERE {fence}), 4) AS whisker_low, "
        f"round(max(CAST(total_amount AS DOUBLE)) FILTER (WHERE {fence}), 4) AS whisker_high, "
        f"count(*) FILTER (WHERE NOT ({fence})) AS n_outliers FROM delivered_days d JOIN ({box}) q "
        "ON d.day_type = q.day_type GROUP BY d.day_type",
        "category_share_by_age": "SELECT * FROM shares",
        "category_share_by_age_pivot": f"SELECT g.position, g.age_group, {category_cells} FROM (VALUES {groups}) "
        "AS g(position, age_group) LEFT JOIN shares s ON g.age_group = s.age_group GROUP BY g.position, g.age_group",
        "merchant_map": f"SELECT merchant_id, merchant_name, city, {_LABEL.format(c='city')} AS city_label, merchant_lat, "
        "merchant_lon, revenue, CASE WHEN max(revenue) OVER (PARTITION BY city) <> 0 THEN "
        "round(CAST(revenue AS DOUBLE) / CAST(max(revenue) OVER (PARTITION BY city) AS DOUBLE) * 200e0 + 20e0, 4) END "
        "AS marker_size FROM (SELECT m.merchant_id, merchant_name, city, round(merchant_lat, 4) AS merchant_lat, "
        "round(merchant_lon, 4) AS merchant_lon, coalesce(r.total_revenue, 0) AS revenue "
        "FROM dim_merchant m LEFT JOIN revenue r ON m.merchant_id = r.merchant_id)",
        "orders_by_hour": "SELECT * FROM hours",
        "peak_hour": "SELECT order_hour, day_type, n_orders, concat(lpad(CAST(order_hour AS VARCHAR), 2, '0'), ':00') "
        "AS hour_label FROM hours ORDER BY n_orders DESC, order_hour, day_type LIMIT 1",
        "weather_volume": "SELECT kondisi_cuaca, count(order_id) AS n_orders, "
        "round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 4) AS avg_amount, "
        "CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_revenue FROM known GROUP BY kondisi_cuaca",
        "weather_hour_heatmap": f"SELECT kondisi_cuaca, {hour_cells} FROM known GROUP BY kondisi_cuaca",
        "weather_status_share": f"SELECT kondisi_cuaca, {status_cells} FROM known GROUP BY kondisi_cuaca",
        "avg_daily_orders": "SELECT * FROM daily_avg",
        "avg_daily_orders_pivot": "SELECT kondisi_cuaca, coalesce(max(avg_orders) FILTER (WHERE city = 'jakarta'), 0) "
        "AS jakarta, coalesce(max(avg_orders) FILTER (WHERE city = 'medan'), 0) AS medan FROM daily_avg "
        "GROUP BY kondisi_cuaca",
        "city_revenue": "SELECT city, CAST(sum(t) AS DECIMAL(28,2)) AS total_revenue, "
        "round(CAST(sum(t) AS DOUBLE) / count(*), 4) AS avg_daily_revenue, round(CAST(sum(t) AS DOUBLE) / 1e6, 4) "
        "AS total_millions FROM (SELECT city, date_id, sum(total_amount) AS t FROM delivered "
        "WHERE city IN ('jakarta', 'surabaya', 'medan') GROUP BY city, date_id) GROUP BY city",
        "completion_summary": "SELECT count(*) AS n_orders, count(*) FILTER (WHERE order_status = 'delivered') "
        "AS n_delivered, round(count(*) FILTER (WHERE order_status = 'delivered') * 100e0 / count(*), 4) "
        "AS delivered_pct, CAST(sum(total_amount) FILTER (WHERE order_status = 'delivered') AS DECIMAL(28,2)) "
        "AS delivered_revenue FROM fact_orders",
        "executive_summary": "SELECT (SELECT count(*) FROM fact_orders) AS n_orders, (SELECT count(*) FROM dim_merchant) "
        "AS n_merchants, (SELECT count(*) FROM dim_user) AS n_users, min(waktu) AS weather_from, "
        "max(waktu) AS weather_to FROM dim_weather",
        "dq_row_counts": union("counts"),
        "fk_orphans": union("fk"),
        "dq_distance": union("distance"),
        "city_consistency": union("city"),
        "dq_money": union("product_money", "order_money", "total", "subtotal"),
        "subtotal_reconcile": union("subtotal"),
        "total_reconcile": union("total"),
        "dq_time": union("time"),
        "dq_ratings": union("status", "reviews"),
        "reviews_not_delivered": union("reviews"),
        "dq_nulls": union("nulls"),
        "dq_report": all_checks,
        "dq_summary": f"SELECT status, count(*) AS n_checks FROM ({all_checks}) GROUP BY status",
        "column_profile": profile,
        "area_to_city": "SELECT * FROM v2_area_city",
        "normalise_category": "SELECT * FROM v2_category",
        "category_profile": "SELECT category, count(*) AS n_products, (SELECT count(DISTINCT category) FROM catalogue_v2) "
        "AS n_categories FROM catalogue_v2 GROUP BY category",
        "catalogue_keys": "SELECT v.product, m.merchant_id, v.merchant_name, v.merchant_area FROM v2 v LEFT JOIN "
        "v2_merchants m ON v.merchant_name = m.merchant_name AND v.merchant_area = m.merchant_area",
        "catalogue_merchants": "SELECT DISTINCT merchant_id, merchant_name, merchant_area, city FROM catalogue_v2",
        "catalogue_v2": "SELECT * FROM catalogue_v2",
        "parse_ratings": "SELECT uid, rating, total_reviews FROM v1",
        "tags_to_category": "SELECT uid, category FROM v1",
        "open_24h": "SELECT uid, is_open_24h FROM v1",
        "extract_area": "SELECT uid, area FROM v1",
        "price_level_terms": "SELECT uid, price_level, delivery_fee AS fee, min_order FROM v1",
        "merchant_key": "SELECT uid, merchant_id FROM v1",
        "catalogue_v1": "SELECT * FROM catalogue_v1",
        "basket_list": lists,
        "basket_explode": "SELECT transaction_id, position, CAST(product_id AS VARCHAR) AS product_id, product_name "
        f"FROM {placed}",
        "basket_totals": "SELECT o.order_id, CAST(s.t AS DECIMAL(18,2)) AS items_subtotal, delivery_fee, discount, "
        "CAST(CASE WHEN s.t + delivery_fee - discount < 0 THEN 0 ELSE s.t + delivery_fee - discount END "
        "AS DECIMAL(18,2)) AS basket_total FROM stg_orders o JOIN (SELECT order_id, coalesce(sum(unit_price * quantity), 0) "
        "AS t FROM stg_order_items WHERE order_id IS NOT NULL GROUP BY order_id) s ON o.order_id = s.order_id",
    }


# Result columns compared as doubles (exact two-decimal amounts) and as ISO text (dates).
AMOUNTS = {
    "impute_mean_by_group": "subtotal",
    "clean_orders": "subtotal delivery_fee discount total_amount",
    "clean_order_items": "unit_price subtotal",
    "clean_products": "price",
    "clean_transactions": "total_payment",
    "dim_product": "price",
    "fact_orders": "subtotal delivery_fee discount total_amount",
    "fact_order_items": "unit_price item_subtotal",
    "top_merchants": "total_revenue",
    "merchant_map": "revenue",
    "weather_volume": "total_revenue",
    "city_revenue": "total_revenue",
    "completion_summary": "delivered_revenue",
    "basket_totals": "items_subtotal delivery_fee discount basket_total",
}
DATES = {
    "weather_date_range": "start_date end_date",
    "month_ranges": "range_start range_end",
    "dedup_keep_first": "date_of_birth",
    "clean_users": "date_of_birth",
    "dim_date": "full_date",
    "dim_time_calendar": "full_date",
}


def _portable(name: str, statement: str) -> str:
    doubles = (*AMOUNTS.get(name, "").split(), *OPTIONAL_INTS.get(name, ()))
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in DATES.get(name, "").split()]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({statement})" if casts else statement


def _reached(statement: str, steps: dict[str, str]) -> list[str]:
    """Names of the steps that a statement needs, in dependency order."""
    needed: set[str] = set()
    open_texts = [statement]
    while open_texts:
        words = set(re.findall(r"[a-z_0-9]+", open_texts.pop()))
        for name in steps:
            if name in words and name not in needed:
                needed.add(name)
                open_texts.append(steps[name])
    return [name for name in steps if name in needed]


def oracle_sql() -> dict[str, str]:
    steps = ctes()
    out = {}
    for name, statement in statements().items():
        used = _reached(statement, steps)
        own = ""
        if statement.startswith("WITH "):
            own, statement = statement.removeprefix("WITH ").rsplit(" SELECT ", 1)
            own, statement = own.strip(), "SELECT " + statement
        statement = _portable(name, statement)
        parts = [f"{step} AS ({steps[step]})" for step in used] + ([own] if own else [])
        out[name] = (f"WITH {', '.join(parts)} " if parts else "") + statement
    return out
