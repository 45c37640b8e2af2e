"""Coordinate systems: geographic WGS84 and UTM in all zones, both hemispheres, both ways, as Column expressions.

Krueger's series of the transverse Mercator projection, to the fourth power of the third flattening, are exact to far below
a millimetre within a zone. `geometry.utm` stays beside them for results that have to match its series."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import FALSE_EASTING, FLATTENING, SCALE, SEMI_MAJOR

SOUTHERN_OFFSET = 10_000_000.0
_N = FLATTENING / (2 - FLATTENING)
_RADIUS = SCALE * SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# fixed values: the published coefficients of the powers of n in the series forward, back, and from the conformal latitude
FORWARD = ((1 / 2, -2 / 3, 5 / 16, 41 / 180), (0, 13 / 48, -3 / 5, 557 / 1440), (0, 0, 61 / 240, -103 / 140), (0, 0, 0, 49561 / 161280))
BACK = ((1 / 2, -2 / 3, 37 / 96, -1 / 360), (0, 1 / 48, 1 / 15, -437 / 1440), (0, 0, 17 / 480, -37 / 840), (0, 0, 0, 4397 / 161280))
LATITUDE = ((2, -2 / 3, -2, 116 / 45), (0, 7 / 3, -8 / 5, -227 / 45), (0, 0, 56 / 15, -136 / 35), (0, 0, 0, 4279 / 630))


def coefficients(table: tuple) -> list[float]:
    return [sum(c * _N ** (k + 1) for k, c in enumerate(row)) for row in table]


@dataclass(frozen=True)
class Crs:
    """zone None: degrees."""

    zone: int | None = None
    south: bool = False


def parse(code: str) -> Crs:
    """EPSG:4326, EPSG:32601 to 32660 (north) and EPSG:32701 to 32760 (south); ValueError names any other."""
    name, _, number = str(code).strip().upper().rpartition(":")
    if name in ("", "EPSG") and number == "4326":
        return Crs()
    if name in ("", "EPSG") and number.isdigit() and len(number) == 5 and number[:3] in ("326", "327") and 1 <= int(number[3:]) <= 60:
        return Crs(int(number[3:]), number[:3] == "327")
    raise ValueError(f"unknown coordinate system {code!r}: EPSG:4326, EPSG:32601 to EPSG:32660 and EPSG:32701 to EPSG:32760 are known")


def utm_code(lon: float, lat: float) -> str:
    """The UTM system of a place."""
    return f"EPSG:32{7 if lat < 0 else 6}{min(int((lon + 180) // 6) + 1, 60):02d}"


def _meridian(zone: Column | int) -> Column:
    return F.radians((F.lit(zone) if isinstance(zone, int) else zone) * 6.0 - 183.0)


def project(lon: Column, lat: Column, zone: Column | int, south: Column | bool) -> tuple[Column, Column]:
    """(easting, northing) of a place in degrees."""
    e = 2 * math.sqrt(_N) / (1 + _N)
    sine, away = F.sin(F.radians(lat)), F.radians(lon) - _meridian(zone)
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(coefficients(FORWARD), 1):
        x, y = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta), y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EASTING + _RADIUS * x, _offset(south) + _RADIUS * y


def unproject(x: Column, y: Column, zone: Column | int, south: Column | bool) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of a place in metres."""
    xi, eta = (y - _offset(south)) / _RADIUS, (x - FALSE_EASTING) / _RADIUS
    a, b = xi, eta
    for j, c in enumerate(coefficients(BACK), 1):
        a, b = a - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta), b - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    conformal = F.asin(F.sin(a) / F.cosh(b))
    lat = conformal
    for j, c in enumerate(coefficients(LATITUDE), 1):
        lat = lat + c * F.sin(2 * j * conformal)
    return F.degrees(_meridian(zone) + F.atan2(F.sinh(b), F.cos(a))), F.degrees(lat)


def _offset(south: Column | bool) -> Column:
    return F.lit(SOUTHERN_OFFSET if south else 0.0) if isinstance(south, bool) else F.when(south, SOUTHERN_OFFSET).otherwise(0.0)


def to_degrees(x: Column, y: Column, crs: Crs) -> tuple[Column, Column]:
    return (x, y) if crs.zone is None else unproject(x, y, crs.zone, crs.south)


def from_degrees(lon: Column, lat: Column, crs: Crs) -> tuple[Column, Column]:
    return (lon, lat) if crs.zone is None else project(lon, lat, crs.zone, crs.south)
