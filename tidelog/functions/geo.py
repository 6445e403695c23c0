"""Distance on the sphere and the box that a parquet scan can prune by."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0


def bounding_box(
    latitude: Column, longitude: Column, centre_lat: float, centre_lng: float, radius_m: float
) -> Column:
    """Plain comparisons that contain the circle; pushed down to the scan.

    Near a pole every longitude may be inside; across the antimeridian the range wraps.
    """
    angle = radius_m / EARTH_RADIUS_M
    reach_lat = math.degrees(angle) * (1 + 1e-9)
    inside = latitude.between(centre_lat - reach_lat, centre_lat + reach_lat)
    ratio = math.sin(min(angle, math.pi / 2)) / max(math.cos(math.radians(centre_lat)), 1e-12)
    if abs(centre_lat) + reach_lat >= 90 or ratio >= 1:
        return inside
    reach_lng = math.degrees(math.asin(ratio)) * (1 + 1e-9)
    west, east = centre_lng - reach_lng, centre_lng + reach_lng
    if west < -180:
        return inside & ((longitude <= east) | (longitude >= west + 360))
    if east > 180:
        return inside & ((longitude >= west) | (longitude <= east - 360))
    return inside & longitude.between(west, east)


def cell_degrees(level: Column) -> Column:
    """Height of a grid cell: 2**level metres."""
    return F.degrees(F.pow(F.lit(2.0), level) / F.lit(EARTH_RADIUS_M))


def band_of(latitude: Column, level: Column) -> Column:
    """Row of the grid, counted from the south pole."""
    return F.floor((latitude + 90) / cell_degrees(level)).cast("long")


def cells_around(band: Column, level: Column) -> Column:
    """Cells in a row of the grid, none narrower than high on the row's shorter side."""
    height = cell_degrees(level)
    south = band * height - 90
    furthest = F.least(F.greatest(F.abs(south), F.abs(south + height)), F.lit(90.0))
    return F.greatest(F.floor(360 * F.cos(F.radians(furthest)) / height), F.lit(1)).cast("long")


def cell_of(longitude: Column, around: Column) -> Column:
    """Cell in a row of `around` cells; not wrapped."""
    return F.floor((longitude + 180) / 360 * around).cast("long")


def reach_of(latitude: Column, radius_m: Column) -> tuple[Column, Column]:
    """Degrees north or south, and east or west, that a circle reaches; 360 where it holds a pole."""
    angle = radius_m / EARTH_RADIUS_M
    north = F.degrees(angle) * (1 + 1e-9)
    ratio = F.sin(F.least(angle, F.lit(math.pi / 2))) / F.greatest(F.cos(F.radians(latitude)), F.lit(1e-12))
    polar = (F.abs(latitude) + north >= 90) | (ratio >= 1)
    return north, F.when(polar, F.lit(360.0)).otherwise(F.degrees(F.asin(ratio)) * (1 + 1e-9))


def haversine(
    latitude: Column, longitude: Column, centre_lat: float | Column, centre_lng: float | Column
) -> Column:
    """Great-circle distance to the centre, in metres."""
    if not isinstance(centre_lat, Column):
        cosine = F.lit(math.cos(math.radians(centre_lat)))
        centre_lat, centre_lng = F.lit(centre_lat), F.lit(centre_lng)
    else:
        cosine = F.cos(F.radians(centre_lat))
    half_lat = F.sin(F.radians(latitude - centre_lat) / 2)
    half_lng = F.sin(F.radians(longitude - centre_lng) / 2)
    chord = half_lat * half_lat + cosine * F.cos(F.radians(latitude)) * half_lng * half_lng
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
