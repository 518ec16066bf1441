"""Distance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding can push the chord of two opposite points a little above one.
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(F.greatest(1 - chord, F.lit(0.0))))


def two_decimals(km: Column) -> Column:
    return F.format_string("%.2f", km)
