"""Distances and projections."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EARTH_M = 6371000


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Web Mercator on the unit square."""
    s = F.sin(F.radians(lat))
    return (lon + 180) / 360, 0.5 - F.log((1 + s) / (1 - s)) / (4 * math.pi)


def degrees(c: Column, low: float, high: float) -> Column:
    """A number in range, else null."""
    v = c.try_cast("double")
    return F.when(v.between(low, high), v)


def fixed_point(c: Column, places: int = 5) -> Column:
    """Whole number of 10**-places; halves go to the even neighbour."""
    return F.bround(c * 10**places).cast("int")

