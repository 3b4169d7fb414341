"""Cities, areas and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Served cities and their display names.
CITY_LABELS = {"jakarta": "DKI Jakarta", "surabaya": "Surabaya", "medan": "Medan"}

# Text fragments that identify a city, tested in this order.
CITY_FRAGMENTS = (("jakarta", "jakarta"), ("surabaya", "surabaya"), ("medan", "medan"), ("sby", "surabaya"))

# Latitude and longitude at which the weather of a city is read, and the width of a reading's cell.
CITY_POINTS = {"jakarta": (-6.2, 106.8), "surabaya": (-7.25, 112.75), "medan": (3.59, 98.67)}
CELL_KM = 11.132

EARTH_RADIUS_KM = 6371.0


def city_label(city: Column) -> Column:
    """Display name of a city key; unknown keys are shown as they are."""
    label = F
    for key, name in CITY_LABELS.items():
        label = label.when(city == key, name)
    return label.otherwise(city)


def area_to_city(area: Column, default: str = "jakarta") -> Column:
    text = F.lower(area)
    city = F
    for fragment, key in CITY_FRAGMENTS:
        city = city.when(F.contains(text, F.lit(fragment)), key)
    return city.otherwise(default)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))
