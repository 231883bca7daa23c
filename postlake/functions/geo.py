"""Distance predicate on latitude and longitude columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
KM_PER_MILE = 1.609344


def parse_geocode(text: str) -> tuple[float, float, float]:
    """``'lat,lon,10km'`` (or ``mi``) to (lat, lon, km); blanks are ignored."""
    lat, lon, radius = "".join(text.split()).split(",")
    if radius.endswith("mi"):
        return float(lat), float(lon), float(radius[:-2]) * KM_PER_MILE
    return float(lat), float(lon), float(radius.removesuffix("km"))


def within_radius(lat: Column, lon: Column, lat0: float, lon0: float, km: float) -> Column:
    """Great-circle distance at most ``km``, with a cheap bounding box tested first."""
    angle = km / EARTH_KM
    box = F.abs(lat - lat0) <= math.degrees(angle) + 1e-9
    if abs(lat0) + math.degrees(angle) < 90:
        reach = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat0))))) + 1e-9
        box = box & (F.abs(F.pmod(lon - lon0 + 180.0, F.lit(360.0)) - 180.0) <= reach)
    half = F.pow(F.sin(F.radians(lat - lat0) / 2), F.lit(2)) + F.cos(F.radians(lat)) * math.cos(
        math.radians(lat0)
    ) * F.pow(F.sin(F.radians(lon - lon0) / 2), F.lit(2))
    return box & (2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(half))) <= km)
