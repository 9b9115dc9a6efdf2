"""Geodesy, beam geometry and unit conversions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371e0
BEAM_EARTH_M = 4e0 / 3e0 * 6371000e0
MILE_M = 1609.344e0
KM_PER_DEGREE = 111.19492664455873e0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1e0))))


def beam_height_m(range_m: Column, elevation_deg: Column) -> Column:
    r = BEAM_EARTH_M
    return F.sqrt(range_m * range_m + F.lit(r * r) + 2e0 * range_m * r * F.sin(F.radians(elevation_deg))) - r


def ground_range_m(range_m: Column, elevation_deg: Column) -> Column:
    return F.lit(BEAM_EARTH_M) * F.asin(range_m * F.cos(F.radians(elevation_deg)) / (F.lit(BEAM_EARTH_M) + beam_height_m(range_m, elevation_deg)))


def to_linear(dbz: Column) -> Column:
    return F.pow(F.lit(10e0), dbz / 10e0)


def to_dbz(z: Column) -> Column:
    return 10e0 * F.log10(z)


def equal_area_radius_km(area_km2: Column) -> Column:
    return F.sqrt(F.greatest(area_km2, F.lit(0e0)) / F.pi())


def aeqd_to_lonlat(x_m: Column, y_m: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """Longitude and latitude of metres east and north of a site, on a sphere."""
    rho = F.sqrt(x_m * x_m + y_m * y_m)
    c, p0 = rho / (EARTH_KM * 1000), F.radians(lat0)
    lat = F.asin(F.cos(c) * F.sin(p0) + F.when(rho == 0, F.lit(0e0)).otherwise(y_m * F.sin(c) * F.cos(p0) / rho))
    lon = F.radians(lon0) + F.atan2(x_m * F.sin(c), rho * F.cos(p0) * F.cos(c) - y_m * F.sin(p0) * F.sin(c))
    return F.when(rho == 0, lon0).otherwise(F.degrees(lon)), F.degrees(lat)


def travelled(lat: Column, lon: Column, heading_deg: Column, knots: Column, hours: float = 0.5) -> tuple[Column, Column]:
    """Where something is after some hours on a flat map: (lat, lon)."""
    km = knots * 1.852e0 * hours
    return lat + km * F.cos(F.radians(heading_deg)) / KM_PER_DEGREE, lon + km * F.sin(F.radians(heading_deg)) / (KM_PER_DEGREE * F.cos(F.radians(lat)))


def shoelace_area(xs: Column, ys: Column) -> Column:
    """The area of a ring given as arrays; the last point joins the first."""
    n = F.size(xs)
    terms = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(xs, i) * F.get(ys, (i + 1) % n) - F.get(xs, (i + 1) % n) * F.get(ys, i))
    return F.abs(F.aggregate(terms, F.lit(0e0), lambda a, x: a + x)) / 2e0


def in_ring(x: Column, y: Column, xs: Column, ys: Column) -> Column:
    """Whether a point lies in a ring, by the parity of crossings of a ray."""
    n = F.size(xs)

    def crosses(i: Column) -> Column:
        x1, y1, x2, y2 = F.get(xs, i), F.get(ys, i), F.get(xs, (i + 1) % n), F.get(ys, (i + 1) % n)
        return ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0e0)) + x1)

    hits = F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(crosses(i), F.lit(False))))
    return (n >= 3) & (hits % 2 == 1)
