"""Rows near given points, by a grid.

The earth is cut into bands of latitude and each band into cells, so large that whatever lies within reach of a point is in the point's cell or in one of
the ring around it. Rows have one cell, points nine: an ordinary join on the cell finds the candidates, the great circle decides. A row may be near several points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.functions.geo import EARTH_RADIUS_KM, haversine_km

_DEGREE_KM = math.pi * EARTH_RADIUS_KM / 180
_LEAST_COSINE = 0.02  # up to 88.8 degrees from the equator the cells are wide enough


def _band(lat: Column, height: float) -> Column:
    return F.floor(lat / height).cast("long")


def _width(band: Column, height: float) -> Column:
    """Width in degrees of the cells of a band: what is within reach at its latitude furthest from the equator, or just beyond it."""
    furthest = F.greatest(F.abs(band), F.abs(band + 1)).cast("double") * height + height
    return F.lit(height) / F.greatest(F.cos(F.radians(furthest)), F.lit(_LEAST_COSINE))


def _turned(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def within(rows: DataFrame, points: DataFrame, km: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``rows`` joined to all ``points`` within ``km``, with the distance in ``distance_km``; both have columns ``lat`` and ``lon``.

    The rows' other columns stay, the points' own replace none of them: they must have other names. Rows or points without coordinates match nothing.
    """
    height = km / _DEGREE_KM * (1 + 1e-9)
    place = [F.col(lat).isNotNull() & F.col(lon).isNotNull()]
    band = _band(F.col(lat), height)
    celled = rows.where(*place).withColumns({"_band": band, "_cell": F.floor(_turned(F.col(lon)) / _width(band, height)).cast("long")})

    others = [c for c in points.columns if c not in (lat, lon)]
    point = points.where(*place).select(*others, F.col(lat).cast("double").alias("_lat"), _turned(F.col(lon).cast("double")).alias("_lon"))
    ring = point.withColumn("_band", F.explode(F.transform(F.array(*[F.lit(i) for i in (-1, 0, 1)]), lambda i: _band(F.col("_lat"), height) + i)))
    width = _width(F.col("_band"), height)
    cell, first, last = (F.floor(x / width).cast("long") for x in (F.col("_lon"), F.lit(-180.0), F.lit(179.999999999)))
    beyond = F.when(F.col("_lon") + 2 * width >= 180, F.array(first, first + 1)).when(F.col("_lon") - 2 * width < -180, F.array(last - 1, last))
    cells = F.concat(F.array(cell - 1, cell, cell + 1), F.coalesce(beyond, F.array().cast("array<long>")))
    ring = ring.withColumn("_cell", F.explode(F.array_distinct(cells)))
    distance = haversine_km(F.col(lat), F.col(lon), F.col("_lat"), F.col("_lon"))
    found = celled.join(ring, ["_band", "_cell"]).withColumn("distance_km", distance)
    return found.where(F.col("distance_km") <= km).select(*rows.columns, *others, "distance_km")
