"""Geographic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounding box (degrees) and mean earth radius (km).
LAT_MIN, LAT_MAX = -34.0, 6.0
LNG_MIN, LNG_MAX = -74.0, -28.0
EARTH_RADIUS_KM = 6371.0088


def in_bounds(lat: Column, lng: Column) -> Column:
    return lat.between(LAT_MIN, LAT_MAX) & lng.between(LNG_MIN, LNG_MAX)


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance; null if any coordinate is null.

    Rounding can push the half-chord a hair above 1 for antipodal points, where ``asin`` is
    undefined, so it is clamped. ``least`` skips nulls, which would turn a missing coordinate
    into a distance, hence the explicit guard.
    """
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lng = F.sin((F.radians(lng2) - F.radians(lng1)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return F.when(
        chord.isNotNull(),
        F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord))),
    )


def geo_source(zip_lat: Column, state_lat: Column) -> Column:
    """Which centroid supplied a coordinate."""
    return (
        F.when(zip_lat.isNotNull(), F.lit("zip"))
        .when(state_lat.isNotNull(), F.lit("state"))
        .otherwise(F.lit("none"))
    )
