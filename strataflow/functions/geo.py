"""Distances on the earth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.text import as_col

# Kilometres per degree on the Clarke 1866 / WGS-84 ellipsoid,
# from 47 CFR 73.208, as cosine series of the middle latitude.
KM_PER_DEGREE_LAT = (111.13209, -0.56605, 0.00120)
KM_PER_DEGREE_LNG = (111.41513, -0.09455, 0.00012)
EARTH_RADIUS_KM = 6371.0
# Fixed value: wider apart than this many degrees of longitude, the flat
# short-range formula gives way to the great circle.
SHORT_RANGE_DEGREES = 13.0


def _degrees_apart(a: Column, b: Column) -> Column:
    gap = F.abs(a - b)
    return F.when(gap > 180, 360 - gap).otherwise(gap)


def haversine_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lng), 2
    )
    # Rounding can pass 1 at opposite points; NULL must stay NULL.
    h = F.when(h > 1, 1.0).otherwise(h)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(h))


def ellipsoid_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    middle = F.radians((lat1 + lat2) / 2)
    a, b, c = KM_PER_DEGREE_LAT
    per_lat = a + b * F.cos(2 * middle) + c * F.cos(4 * middle)
    a, b, c = KM_PER_DEGREE_LNG
    per_lng = a * F.cos(middle) + b * F.cos(3 * middle) + c * F.cos(5 * middle)
    d_lat = per_lat * (lat1 - lat2)
    d_lng = per_lng * _degrees_apart(lng1, lng2)
    return F.sqrt(d_lat * d_lat + d_lng * d_lng)


def geo_km(
    lng1: Column | str,
    lat1: Column | str,
    lng2: Column | str,
    lat2: Column | str,
    model: str = "ellipsoid",
) -> Column:
    """Kilometres between two points given in degrees; NULL if any is NULL.

    ``ellipsoid`` is WGS-84 at short range and the great circle beyond it;
    ``sphere`` is the great circle throughout.
    """
    lng1, lat1, lng2, lat2 = (as_col(c) for c in (lng1, lat1, lng2, lat2))
    far = haversine_km(lng1, lat1, lng2, lat2)
    if model == "sphere":
        return far
    if model != "ellipsoid":
        raise ValueError(f"unknown earth model: {model}")
    near = _degrees_apart(lng1, lng2) < SHORT_RANGE_DEGREES
    return F.when(near, ellipsoid_km(lng1, lat1, lng2, lat2)).otherwise(far)
