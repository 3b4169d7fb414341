"""Humidity, weather classes and the city-hour key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platewise.functions import calendar

# Weather classes, thresholds and physical constants.
RAIN = "Hujan"
CLOUDY = "Berawan"
HOT = "Panas"
CLEAR = "Cerah"
UNKNOWN = "Tidak Diketahui"
CLASSES = (RAIN, CLOUDY, HOT, CLEAR)
RAIN_ABOVE_M = 0.002
HUMIDITY_ABOVE_PCT = 85.0
TEMPERATURE_ABOVE_C = 30.0
KELVIN_OFFSET = 273.15
MAGNUS_A = 17.625
MAGNUS_B = 243.04


def celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(KELVIN_OFFSET)


def _saturation(celsius_col: Column) -> Column:
    return F.exp(F.lit(MAGNUS_A) * celsius_col / (F.lit(MAGNUS_B) + celsius_col))


def relative_humidity(temp_k: Column, dewpoint_k: Column) -> Column:
    """Relative humidity in percent from air and dew-point temperature."""
    return F.lit(100.0) * _saturation(celsius(dewpoint_k)) / _saturation(celsius(temp_k))


def classify(temp_k: Column, rain_m: Column, humidity_pct: Column) -> Column:
    """First matching class; a missing or zero input fails its own test only."""
    return (
        F.when(rain_m > RAIN_ABOVE_M, RAIN)
        .when(humidity_pct > HUMIDITY_ABOVE_PCT, CLOUDY)
        .when((temp_k != 0) & (celsius(temp_k) > TEMPERATURE_ABOVE_C), HOT)
        .otherwise(CLEAR)
    )


def weather_key(city: Column, ts: Column) -> Column:
    return F.concat(city, F.lit("_"), calendar.hour_stamp(ts))
