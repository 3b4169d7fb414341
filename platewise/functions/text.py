"""Text clean-up, keyword classification and catalogue fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, Sequence[str]]]

# Product categories and the keywords that select them, tested in this order.
PRODUCT_CATEGORY_RULES: Rules = (
    ("Ayam & Bebek", ("ayam", "bebek", "chicken", "geprek", "unggas", "bakar ayam", "goreng ayam", "penyet")),
    ("Seafood", ("seafood", "ikan", "udang", "cumi", "kepiting", "lobster", "kerang", "gurame", "lele", "kakap")),
    ("Nasi & Lauk", ("nasi", "rice", "lauk", "gudeg", "rendang", "semur", "liwet", "tumpeng", "campur", "kotak")),
    ("Mie & Pasta", ("mie", "mi ", "bakmi", "pasta", "spaghetti", "fettuccine", "ramen", "udon", "kwetiau", "bihun")),
    ("Burger & Sandwich", ("burger", "sandwich", "hotdog", "sub ", "wrap")),
    ("Pizza", ("pizza", "calzone")),
    ("Sushi & Japanese", ("sushi", "japanese", "jepang", "ramen", "gyoza", "takoyaki", "teriyaki", "bento", "onigiri",
                          "sashimi")),
    ("Korean Food", ("korean", "korea", "kpop food", "bibimbap", "tteokbokki", "bulgogi", "kimbap", "samgyeopsal",
                     "ramyeon")),
    ("Minuman & Jus", ("jus", "juice", "minuman", "es teh", "teh", "lemonade", "smoothie", "milkshake", "boba",
                       "bubble tea", "air mineral")),
    ("Dessert & Snack", ("dessert", "snack", "es krim", "ice cream", "cake", "kue", "brownies", "waffle", "donat",
                         "roti", "pisang goreng", "martabak", "pancake", "biscuit", "keripik")),
    ("Sarapan", ("sarapan", "breakfast", "bubur", "oatmeal", "sereal", "toast", "telur", "omelette", "lontong")),
    ("Vegetarian", ("vegetarian", "vegan", "veggie", "gado", "pecel", "tempe", "tahu", "sayur", "salad")),
    ("Western", ("western", "steak", "ribs", "bbq", "fried chicken", "pasta barat", "fish & chips")),
    ("Padang", ("padang", "minang", "rendang", "gulai", "soto padang")),
    ("Bakso & Soto", ("bakso", "soto", "pempek", "siomay", "batagor", "cilok", "tekwan", "mie ayam bakso")),
)

# Merchant categories and the tags that select them, tested in this order.
TAG_CATEGORY_RULES: Rules = (
    ("Ayam & Unggas", ("ayam", "unggas", "chicken")),
    ("Nasi & Lauk", ("nasi", "rice", "indonesia", "lauk")),
    ("Mie & Pasta", ("mie", "bakmi", "pasta")),
    ("Seafood", ("seafood", "ikan", "udang")),
    ("Burger & Sandwich", ("burger", "sandwich")),
    ("Pizza", ("pizza",)),
    ("Minuman & Jus", ("minuman", "jus", "juice")),
    ("Kopi & Cafe", ("kopi", "coffee", "cafe")),
    ("Dessert & Snack", ("dessert", "snack", "ice cream")),
    ("Vegetarian", ("vegetarian", "vegan")),
    ("Sushi & Japanese", ("sushi", "japanese", "jepang")),
    ("Bakso & Soto", ("bakso", "soto")),
)

# Area names and the fragment that selects each, tested in this order.
AREA_RULES: Rules = (
    ("Sleman", ("sleman",)),
    ("Bantul", ("bantul",)),
    ("Kota Yogyakarta", ("yogyakarta",)),
    ("Godean", ("godean",)),
    ("Mlati", ("mlati",)),
    ("Depok", ("depok",)),
    ("Umbulharjo", ("umbulharjo",)),
    ("Gondokusuman", ("gondokusuman",)),
    ("Gamping", ("gamping",)),
    ("Ngaglik", ("ngaglik",)),
    ("Kalasan", ("kalasan",)),
)

# Texts that stand for a missing value.
BLANK_TEXTS = ("", "nan", "none")
BLANK_BRANDS = ("", "nan", "None")

# Coordinates used where the catalogue has none.
DEFAULT_LATITUDE = -7.80
DEFAULT_LONGITUDE = 110.36

_WHITESPACE = " \t\n\r\f\x0b"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(_WHITESPACE))


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest ("medan's" -> "Medan'S")."""
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def first_match(text: Column, rules: Rules, default: Column) -> Column:
    """Label of the first rule with any keyword inside ``text``."""
    label = F
    for name, keywords in rules:
        hit = F.contains(text, F.lit(keywords[0]))
        for keyword in keywords[1:]:
            hit = hit | F.contains(text, F.lit(keyword))
        label = label.when(hit, name)
    return label.otherwise(default)


def product_category(raw: Column, default: str = "Unknown") -> Column:
    return first_match(strip(F.lower(raw)), PRODUCT_CATEGORY_RULES, F.lit(default))


def tag_category(tags: Column, default: str = "Unknown") -> Column:
    return first_match(F.lower(tags), TAG_CATEGORY_RULES, F.lit(default))


def area_name(city_text: Column, default: str = "Unknown") -> Column:
    """Known area inside the text, else the text in title case, else ``default`` for blanks."""
    lowered = strip(F.lower(city_text))
    blank = lowered.isNull() | lowered.isin(*BLANK_TEXTS)
    return first_match(lowered, AREA_RULES, F.when(blank, F.lit(default)).otherwise(title_case(strip(city_text))))


def rating_fields(literal: Column) -> tuple[Column, Column]:
    """(average, total) of a ``{'average': .., 'total': ..}`` text; zero, unreadable, NaN and too large values are null."""
    parsed = F.from_json(literal, "average double, total double")
    average = parsed["average"]
    total = parsed["total"].try_cast("int")
    return F.nullif(F.nanvl(average, F.lit(0.0)), F.lit(0.0)), F.nullif(total, F.lit(0))


def open_all_day(periods: Column) -> Column:
    text = F.lower(periods)
    both = F.contains(text, F.lit("'hours': 0")) & F.contains(text, F.lit("'hours': 23"))
    return F.coalesce(both, F.lit(False))


def merchant_key(uid: Column) -> Column:
    return F.concat(F.lit("MRC"), F.upper(F.substring(F.replace(uid, F.lit("-"), F.lit("")), 1, 8)))


def blank_to_null(col: Column) -> Column:
    trimmed = strip(col)
    return F.when(~trimmed.isin(*BLANK_BRANDS), trimmed)


def cast_or(col: Column, type_name: str, default) -> Column:
    return F.coalesce(col.try_cast(type_name), F.lit(default).cast(type_name))


def is_active_status(status: Column) -> Column:
    return F.coalesce(strip(status.cast("string")) == "1", F.lit(False))


def surrogate_key(*parts: Column) -> Column:
    """Deterministic key of a composite natural key: needs no distinct, no join and no shuffle."""
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("")) for p in parts]  # a missing part is not an empty one
    return F.sha2(F.concat_ws("\x01", *marked), 256)
