"""Distances, units and hexagons as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail.schema import EARTH_KM
from contrail.functions.numeric import half_up

# Metres to feet and metres per second to knots.
FEET_PER_METRE = 3.28084
KNOTS_PER_MPS = 1.94384

# Fixed value: equatorial radius of the web-map projection, metres.
MERCATOR_RADIUS = 6378137.0


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def feet(metres: Column) -> Column:
    """Whole feet; null for a missing or zero altitude."""
    return F.when(metres != 0, half_up(metres * F.lit(FEET_PER_METRE))).cast("long")


def knots(mps: Column) -> Column:
    """Whole knots; 0 for a missing speed."""
    return F.coalesce(half_up(mps * F.lit(KNOTS_PER_MPS)), F.lit(0)).cast("long")


def box_filter(lat: Column, lon: Column, centre: tuple[float, float], km: float) -> Column:
    """Cheap necessary condition for being within `km` of `centre`; reaches the scan."""
    reach = math.degrees(km / EARTH_KM) * (1 + 1e-9)
    low, high = centre[0] - reach, centre[0] + reach
    inside = lat.between(low, high)
    steepest = math.cos(math.radians(min(90.0, max(abs(low), abs(high)))))
    if steepest <= 0 or low <= -90 or high >= 90:
        return inside
    ratio = math.sin(km / EARTH_KM) / steepest
    if ratio >= 1:
        return inside
    span = math.degrees(math.asin(ratio)) * (1 + 1e-9)
    west, east = centre[1] - span, centre[1] + span
    if west < -180 or east > 180:
        return inside
    return inside & lon.between(west, east)


def mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Web-map metres."""
    x = F.radians(lon) * F.lit(MERCATOR_RADIUS)
    y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(MERCATOR_RADIUS)
    return x, y


def hex_axial(lat: Column, lon: Column, radius_m: float) -> tuple[Column, Column]:
    """Axial address (q, r) of the pointy-topped hexagon holding a position.

    Cube rounding: of the three rounded coordinates the one that moved farthest is
    recomputed from the other two.
    """
    x, y = mercator(lat, lon)
    q = (x * F.lit(math.sqrt(3) / 3) - y / 3) / F.lit(radius_m)
    r = (y * 2 / 3) / F.lit(radius_m)
    s = -q - r
    near_q, near_r, near_s = half_up(q), half_up(r), half_up(s)
    off_q, off_r, off_s = F.abs(near_q - q), F.abs(near_r - r), F.abs(near_s - s)
    fixed_q = F.when((off_q > off_r) & (off_q > off_s), -near_r - near_s).otherwise(near_q)
    fixed_r = F.when((off_r >= off_q) & (off_r > off_s), -near_q - near_s).otherwise(near_r)
    return fixed_q.cast("long"), fixed_r.cast("long")
