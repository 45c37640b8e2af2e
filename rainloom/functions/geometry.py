"""Projection, distances, variogram models and point-in-polygon as Column expressions."""

from __future__ import annotations

from math import prod

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the WGS84 ellipsoid and the UTM scale
SEMI_MAJOR, FLATTENING, SCALE, FALSE_EASTING = 6378137.0, 1.0 / 298.257223563, 0.9996, 500000.0


def utm(lat: Column, lon: Column, zone: int = 45) -> tuple[Column, Column]:
    """(easting, northing) by the transverse Mercator series, without the southern offset; about 1 cm within the zone."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    phi = F.radians(lat)
    sine, cosine, tangent = F.sin(phi), F.cos(phi), F.tan(phi)
    t, c = tangent * tangent, F.lit(ep2) * cosine * cosine
    a = (F.radians(lon) - F.radians(F.lit(float(zone * 6 - 183)))) * cosine
    radius = F.lit(SEMI_MAJOR) / F.sqrt(1 - F.lit(e2) * sine * sine)
    # meridian arc: coefficients of phi, sin 2 phi, sin 4 phi and sin 6 phi
    arc = [1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256, -(3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024), 15 * e2**2 / 256 + 45 * e2**3 / 1024, -35 * e2**3 / 3072]
    meridian = F.lit(SEMI_MAJOR) * (F.lit(arc[0]) * phi + F.lit(arc[1]) * F.sin(2 * phi) + F.lit(arc[2]) * F.sin(4 * phi) + F.lit(arc[3]) * F.sin(6 * phi))
    power = lambda n: prod([a] * (n - 1), start=a)
    x = a + (1 - t + c) * power(3) / 6 + (5 - 18 * t + t * t + 72 * c - F.lit(58 * ep2)) * power(5) / 120
    y = power(2) / 2 + (5 - t + 9 * c + 4 * c * c) * power(4) / 24 + (61 - 58 * t + t * t + 600 * c - F.lit(330 * ep2)) * power(6) / 720
    return F.lit(SCALE) * radius * x + F.lit(FALSE_EASTING), F.lit(SCALE) * (meridian + radius * tangent * y)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def shape(model: str, h: Column, reach: Column) -> Column:
    """A model's rise from 0 to 1 with distance."""
    s = h / reach
    if model == "spherical":
        return F.when(h >= reach, 1.0).otherwise(1.5 * s - 0.5 * s * s * s)
    if model == "exponential":
        return 1 - F.exp(-3 * s)
    if model == "gaussian":
        return 1 - F.exp(-3 * s * s)
    raise ValueError(f"unknown variogram model {model!r}")


MODELS = ("spherical", "exponential", "gaussian")


def gamma(model: Column, h: Column, nugget: Column, sill: Column, reach: Column) -> Column:
    """The semivariance at distance h: 0 at h <= 0, whatever the nugget; null for an unknown model."""
    rise = F.coalesce(*[F.when(model == m, shape(m, h, reach)) for m in MODELS])
    return F.when(h <= 0, F.when(model.isin(*MODELS), 0.0)).otherwise(nugget + (sill - nugget) * rise)


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Whether a point is inside rings of (x, y) corners, by the even-odd rule, so holes are rings too.

    A ring may or may not repeat its first corner at the end."""

    def crossings(ring: Column) -> Column:
        after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        edges = F.zip_with(ring, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        def crosses(e: Column) -> Column:
            a, b = e["a"], e["b"]
            at = a["x"] + (y - a["y"]) * F.try_divide(b["x"] - a["x"], b["y"] - a["y"])
            return ((a["y"] > y) != (b["y"] > y)) & (x < at)

        return F.size(F.filter(edges, crosses))

    return F.aggregate(F.transform(rings, crossings), F.lit(0), lambda n, k: n + k) % 2 == 1


def missing(value: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(value), value)


def clip_zero(value: Column) -> Column:
    """Negative values as 0; missing ones stay missing."""
    return F.when(value < 0, 0.0).otherwise(value)


def flush_round(value: Column, least: float = 0.1) -> Column:
    """Values up to `least` as 0, the rest to two decimals, halves to even."""
    return F.when(value <= least, 0.0).otherwise(F.rint(value * 100) / 100)
