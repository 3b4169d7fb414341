"""Values that the reference SQL states for itself, so that a wrong value in the package shows."""

# The keywords of each category, in the order in which they are tried.
PRODUCT_CATEGORIES = {
    "Ayam & Bebek": ["ayam", "bebek", "chicken", "geprek", "unggas", "bakar ayam", "goreng ayam", "penyet"],
    "Seafood": ["seafood", "ikan", "udang", "cumi", "kepiting", "lobster", "kerang", "gurame", "lele", "kakap"],
    "Nasi & Lauk": ["nasi", "rice", "lauk", "gudeg", "rendang", "semur", "liwet", "tumpeng", "campur", "kotak"],
    "Mie & Pasta": ["mie", "mi ", "bakmi", "pasta", "spaghetti", "fettuccine", "ramen", "udon", "kwetiau", "bihun"],
    "Burger & Sandwich": ["burger", "sandwich", "hotdog", "sub ", "wrap"],
    "Pizza": ["pizza", "calzone"],
    "Sushi & Japanese": ["sushi", "japanese", "jepang", "ramen", "gyoza", "takoyaki", "teriyaki", "bento", "onigiri",
        "sashimi"],
    "Korean Food": ["korean", "korea", "kpop food", "bibimbap", "tteokbokki", "bulgogi", "kimbap", "samgyeopsal",
        "ramyeon"],
    "Minuman & Jus": ["jus", "juice", "minuman", "es teh", "teh", "lemonade", "smoothie", "milkshake", "boba",
        "bubble tea", "air mineral"],
    "Dessert & Snack": ["dessert", "snack", "es krim", "ice cream", "cake", "kue", "brownies", "waffle", "donat",
        "roti", "pisang goreng", "martabak", "pancake", "biscuit", "keripik"],
    "Sarapan": ["sarapan", "breakfast", "bubur", "oatmeal", "sereal", "toast", "telur", "omelette", "lontong"],
    "Vegetarian": ["vegetarian", "vegan", "veggie", "gado", "pecel", "tempe", "tahu", "sayur", "salad"],
    "Western": ["western", "steak", "ribs", "bbq", "fried chicken", "pasta barat", "fish & chips"],
    "Padang": ["padang", "minang", "rendang", "gulai", "soto padang"],
    "Bakso & Soto": ["bakso", "soto", "pempek", "siomay", "batagor", "cilok", "tekwan", "mie ayam bakso"],
}

MERCHANT_TAGS = {
    "Ayam & Unggas": ["ayam", "unggas", "chicken"],
    "Nasi & Lauk": ["nasi", "rice", "indonesia", "lauk"],
    "Mie & Pasta": ["mie", "bakmi", "pasta"],
    "Seafood": ["seafood", "ikan", "udang"],
    "Burger & Sandwich": ["burger", "sandwich"],
    "Pizza": ["pizza"],
    "Minuman & Jus": ["minuman", "jus", "juice"],
    "Kopi & Cafe": ["kopi", "coffee", "cafe"],
    "Dessert & Snack": ["dessert", "snack", "ice cream"],
    "Vegetarian": ["vegetarian", "vegan"],
    "Sushi & Japanese": ["sushi", "japanese", "jepang"],
    "Bakso & Soto": ["bakso", "soto"],
}

AREAS = {
    "Sleman": ["sleman"],
    "Bantul": ["bantul"],
    "Kota Yogyakarta": ["yogyakarta"],
    "Godean": ["godean"],
    "Mlati": ["mlati"],
    "Depok": ["depok"],
    "Umbulharjo": ["umbulharjo"],
    "Gondokusuman": ["gondokusuman"],
    "Gamping": ["gamping"],
    "Ngaglik": ["ngaglik"],
    "Kalasan": ["kalasan"],
}

# Age groups and the age at which each ends.
AGE_GROUPS = (("<18", 18), ("18-24", 25), ("25-34", 35), ("35-44", 45), ("45-54", 55), ("55+", None))

# Keys and columns that must be there.
REQUIRED = {
    "users": ["user_id", "full_name"],
    "drivers": ["driver_id", "full_name"],
    "merchants": ["merchant_id", "merchant_name"],
    "products": ["product_id", "merchant_id"],
    "orders": ["order_id", "user_id", "merchant_id"],
    "order_items": ["order_item_id", "order_id", "product_id"],
}

CRITICAL_COLUMNS = {
    "orders": ["order_id", "user_id", "driver_id", "merchant_id", "status", "total_amount", "order_time"],
    "users": ["user_id", "full_name", "email", "phone", "lat", "lon"],
    "drivers": ["driver_id", "full_name", "phone", "vehicle_type"],
    "merchants": ["merchant_id", "merchant_name", "lat", "lon"],
    "products": ["product_id", "merchant_id", "product_name", "price"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
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

FOREIGN_KEYS = (
    ("orders", "user_id", "users", "user_id"),
    ("orders", "driver_id", "drivers", "driver_id"),
    ("orders", "merchant_id", "merchants", "merchant_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("reviews", "order_id", "orders", "order_id"),
)

# The columns of every sampled table.
SAMPLED_COLUMNS = {
    "users": ["user_id", "full_name", "email", "phone", "city", "gender", "date_of_birth", "address_area", "lat",
        "lon", "is_active"],
    "drivers": ["driver_id", "full_name", "phone", "vehicle_type", "city", "current_area", "rating", "total_trips",
        "is_active"],
    "merchants": ["merchant_id", "merchant_name", "category", "area", "city", "lat", "lon", "rating", "is_active"],
    "products": ["product_id", "merchant_id", "product_name", "category", "price", "is_available"],
    "orders": ["order_id", "user_id", "driver_id", "merchant_id", "city", "status", "payment_method", "subtotal",
        "delivery_fee", "discount", "total_amount", "distance_km", "order_time", "delivered_time", "delivery_area",
        "delivery_lat", "delivery_lon", "pickup_lat", "pickup_lon"],
    "order_items": ["order_item_id", "order_id", "product_id", "merchant_id", "product_name", "category", "quantity",
        "unit_price", "subtotal"],
    "reviews": ["review_id", "order_id", "user_id", "merchant_id", "driver_id", "merchant_rating", "driver_rating"],
    "dim_date": ["date_id", "full_date", "year", "quarter", "month", "month_name", "day", "day_name", "day_of_week",
        "is_weekend"],
    "dim_user": ["user_id", "user_name", "gender", "age", "age_group", "city", "user_area", "user_lat", "user_lon",
        "user_is_active"],
    "dim_driver": ["driver_id", "driver_name", "vehicle_type", "city", "driver_area", "driver_rating", "total_trips",
        "driver_is_active"],
    "dim_merchant": ["merchant_id", "merchant_name", "merchant_category", "city", "merchant_area", "merchant_lat",
        "merchant_lon", "merchant_rating", "avg_review_rating", "merchant_is_active"],
    "dim_product": ["product_id", "merchant_id", "product_name", "product_category", "price", "is_available"],
    "dim_weather": ["weather_id", "city", "wilayah", "waktu", "date_id", "hour", "kondisi_cuaca"],
    "fact_orders": ["order_id", "user_id", "driver_id", "merchant_id", "date_id", "order_hour", "is_weekend", "city",
        "order_status", "payment_method", "subtotal", "delivery_fee", "discount", "total_amount", "distance_km",
        "delivery_area", "is_delivered", "is_cancelled", "weather_id", "kondisi_cuaca"],
    "fact_order_items": ["order_item_id", "order_id", "product_id", "merchant_id", "user_id", "date_id", "city",
        "product_name", "product_category", "quantity", "unit_price", "item_subtotal", "order_status", "weather_id",
        "kondisi_cuaca"],
}

# Their columns with a fraction.
FRACTIONS = {
    "users": ["lat", "lon"],
    "drivers": ["rating"],
    "merchants": ["lat", "lon", "rating"],
    "products": ["price"],
    "orders": ["subtotal", "delivery_fee", "discount", "total_amount", "distance_km", "delivery_lat", "delivery_lon",
        "pickup_lat", "pickup_lon"],
    "order_items": ["unit_price", "subtotal"],
    "dim_user": ["user_lat", "user_lon"],
    "dim_driver": ["driver_rating"],
    "dim_merchant": ["merchant_lat", "merchant_lon", "merchant_rating", "avg_review_rating"],
    "dim_product": ["price"],
    "fact_orders": ["subtotal", "delivery_fee", "discount", "total_amount", "distance_km"],
    "fact_order_items": ["unit_price", "item_subtotal"],
}
