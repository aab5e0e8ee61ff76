"""Distances, and the cells that make distance searches equi-joins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.constants import EARTH_RADIUS_KM

# WGS84 ellipsoid.
WGS84_MAJOR_KM = 6378.137
WGS84_FLATTENING = 1 / 298.257223563

# A degree of latitude is nowhere shorter than this on the ellipsoid.
KM_PER_DEGREE = 110.5


def turned(prefix: str, lat: Column, lon: Column) -> dict[str, Column]:
    """What the spherical distance takes from one point, as columns: where points meet often, made once for each."""
    north, east = F.radians(lat), F.radians(lon)
    return {
        f"{prefix}cos": F.cos(north), f"{prefix}sin": F.sin(north), f"{prefix}east": east,
        f"{prefix}x": F.cos(north) * F.cos(east), f"{prefix}y": F.cos(north) * F.sin(east),
    }


def turned_km(first: dict[str, Column], second: dict[str, Column]) -> Column:
    """Spherical distance of two ``turned`` points. The cosine is clamped: rounding may carry it past 1."""
    (cos1, sin1, east1, *_), (cos2, sin2, east2, *_) = first.values(), second.values()
    cosine = cos1 * cos2 * F.cos(east2 - east1) + sin1 * sin2
    return F.lit(EARTH_RADIUS_KM) * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def turned_below(first: dict[str, Column], second: dict[str, Column], radius: float) -> Column:
    """Whether ``turned_km`` is below ``radius``, of points that are not null: by the product of vectors, and by
    itself close to the radius."""
    (_, sin1, _, x1, y1), (_, sin2, _, x2, y2) = first.values(), second.values()
    if radius <= 0:
        return turned_km(first, second) < radius
    edge = math.cos(min(radius / EARTH_RADIUS_KM, math.pi))
    product = x1 * x2 + y1 * y2 + sin1 * sin2
    return (product > F.lit(edge + 1e-12)) | ((product > F.lit(edge - 1e-12)) & (turned_km(first, second) < radius))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical distance."""
    return turned_km(turned("", lat1, lon1), turned("", lat2, lon2))


def geodesic_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the WGS84 ellipsoid, first order in the flattening (Andoyer-Lambert)."""
    f = F.lit(WGS84_FLATTENING)
    mean = F.radians(lat1 + lat2) / F.lit(2.0)
    half = F.radians(lat1 - lat2) / F.lit(2.0)
    turn = F.radians(lon1 - lon2) / F.lit(2.0)
    sq = lambda c: c * c
    s = sq(F.sin(half)) * sq(F.cos(turn)) + sq(F.cos(mean)) * sq(F.sin(turn))
    c = sq(F.cos(half)) * sq(F.cos(turn)) + sq(F.sin(mean)) * sq(F.sin(turn))
    omega = F.atan2(F.sqrt(s), F.sqrt(c))
    ratio = F.try_divide(F.sqrt(s * c), omega)
    north = F.try_divide(F.lit(3.0) * ratio - F.lit(1.0), F.lit(2.0) * c)
    south = F.try_divide(F.lit(3.0) * ratio + F.lit(1.0), F.lit(2.0) * s)
    shape = (
        F.lit(1.0)
        + f * north * sq(F.sin(mean)) * sq(F.cos(half))
        - f * south * sq(F.cos(mean)) * sq(F.sin(half))
    )
    distance = F.lit(2.0 * WGS84_MAJOR_KM) * omega * shape
    # Coincident points divide by zero; exact antipodes are outside the formula.
    return F.when(s < F.lit(1e-24), F.lit(0.0)).when(c < F.lit(1e-24), F.lit(20003.93)).otherwise(distance)


def cell_of(coordinate: Column, origin: float, size: Column) -> Column:
    return F.floor((coordinate + F.lit(origin)) / size)


def lat_cell(lat: Column, size: Column) -> Column:
    return cell_of(lat, 90.0, size)


def lon_cell(lon: Column, size: Column) -> Column:
    """Longitude cells count from -180 and close around the globe."""
    return cell_of(F.pmod(lon + F.lit(180.0), F.lit(360.0)), 0.0, size)


def covering_lat_cells(lat: Column, radius_km: Column, size: Column) -> Column:
    """Latitude cells that touch the circle of ``radius_km`` around a point."""
    reach = radius_km / F.lit(KM_PER_DEGREE)
    low = F.greatest(F.lit(-90.0), lat - reach)
    high = F.least(F.lit(90.0), lat + reach)
    return F.sequence(lat_cell(low, size), lat_cell(high, size))


def covering_lon_cells(lat: Column, lon: Column, radius_km: Column, size: Column) -> Column:
    """Longitude cells that touch the circle; all of them where it holds a pole."""
    reach = radius_km / F.lit(KM_PER_DEGREE)
    count = F.ceil(F.lit(360.0) / size)
    ratio = F.sin(F.radians(F.least(reach, F.lit(90.0)))) / F.cos(F.radians(lat))
    whole = (F.abs(lat) + reach >= F.lit(89.9)) | (ratio >= F.lit(1.0))
    # One percent of slack for the difference between sphere and ellipsoid.
    width = F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * F.lit(1.01)
    low = F.floor((lon + F.lit(180.0) - width) / size)
    high = F.floor((lon + F.lit(180.0) + width) / size)
    everything = F.sequence(F.lit(0).cast("bigint"), count - 1)
    around = F.transform(F.sequence(low, high), lambda c: F.pmod(c, count))
    return F.when(whole | (high - low + 1 >= count), everything).otherwise(around)
