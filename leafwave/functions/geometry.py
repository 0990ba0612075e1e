"""WGS84 conversions and satellite direction as Column algebra.

A receiver is one constant, so its geodetic position and rotation are worked
out once and enter the plan as literals. ``pairs`` of receivers given as
columns use the same formulas.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# WGS84 semi-major axis (m) and flattening.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)


def geodetic_to_ecef(lat_deg: float, lon_deg: float, alt_m: float) -> tuple[float, float, float]:
    lat, lon = math.radians(lat_deg), math.radians(lon_deg)
    n = WGS84_A / math.sqrt(1 - WGS84_E2 * math.sin(lat) ** 2)
    return (
        (n + alt_m) * math.cos(lat) * math.cos(lon),
        (n + alt_m) * math.cos(lat) * math.sin(lon),
        (n * (1 - WGS84_E2) + alt_m) * math.sin(lat),
    )


def ecef_to_geodetic(x: float, y: float, z: float) -> tuple[float, float, float]:
    """Latitude and longitude in degrees, height in m, by fixed-point iteration."""
    p = math.hypot(x, y)
    lon = math.atan2(y, x)
    lat = math.atan2(z, p * (1 - WGS84_E2))
    for _ in range(50):
        n = WGS84_A / math.sqrt(1 - WGS84_E2 * math.sin(lat) ** 2)
        new = math.atan2(z + WGS84_E2 * n * math.sin(lat), p)
        if abs(new - lat) < 1e-15:
            lat = new
            break
        lat = new
    n = WGS84_A / math.sqrt(1 - WGS84_E2 * math.sin(lat) ** 2)
    if abs(math.cos(lat)) > 1e-9:
        alt = p / math.cos(lat) - n
    else:
        alt = abs(z) / abs(math.sin(lat)) - n * (1 - WGS84_E2)
    return math.degrees(lat), math.degrees(lon), alt


def direction_from(
    x: Column, y: Column, z: Column, receiver: tuple[float, float, float]
) -> Column:
    """struct(r, theta, phi) of a satellite seen from ``receiver`` (both ECEF, m).

    theta is the polar angle from zenith, phi the azimuth clockwise from North,
    all NULL below the horizon.
    """
    lat_deg, lon_deg, _ = ecef_to_geodetic(*receiver)
    lat, lon = math.radians(lat_deg), math.radians(lon_deg)
    sl, cl, so, co = math.sin(lat), math.cos(lat), math.sin(lon), math.cos(lon)
    dx, dy, dz = x - F.lit(receiver[0]), y - F.lit(receiver[1]), z - F.lit(receiver[2])
    east = dx * F.lit(-so) + dy * F.lit(co)
    north = dx * F.lit(-sl * co) + dy * F.lit(-sl * so) + dz * F.lit(cl)
    up = dx * F.lit(cl * co) + dy * F.lit(cl * so) + dz * F.lit(sl)
    return _spherical(east, north, up)


def _spherical(east: Column, north: Column, up: Column) -> Column:
    r = F.sqrt(east * east + north * north + up * up)
    cosine = F.when(r != 0, F.least(F.greatest(up / r, F.lit(-1.0)), F.lit(1.0)))
    seen = up >= 0
    return F.struct(
        F.when(seen, r).alias("r"),
        F.when(seen, F.acos(cosine)).alias("theta"),
        F.when(seen, F.pmod(F.atan2(east, north), F.lit(2 * math.pi))).alias("phi"),
    )


def with_spherical_coords(
    df: DataFrame, receiver: tuple[float, float, float], xyz: tuple[str, str, str] = ("X", "Y", "Z")
) -> DataFrame:
    """Add r, theta and phi from satellite ECEF columns."""
    packed = df.withColumn("__dir", direction_from(*[F.col(c) for c in xyz], receiver))
    return packed.select("*", "__dir.*").drop("__dir")


def unit_vector(theta: Column, phi: Column) -> tuple[Column, Column, Column]:
    """Cartesian embedding used for grid cells."""
    return F.sin(theta) * F.cos(phi), F.sin(theta) * F.sin(phi), F.cos(theta)


def wrap_azimuth_difference(a: Column, b: Column) -> Column:
    """``a`` shifted by one turn when it is more than half a turn from ``b`` (degrees)."""
    d = a - b
    return F.when(d > 180, a - 360).when(d < -180, a + 360).otherwise(a)
