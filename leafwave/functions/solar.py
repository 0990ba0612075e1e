"""Solar position by the NOAA equations, as Column algebra."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.functions.numeric import clip
from leafwave.functions.timeutil import col_of, clock_hour

CIVIL_TWILIGHT = -6.0


def julian_day(epoch: Column | str) -> Column:
    """Julian day with whole seconds; the Gregorian day number is 1970-01-01 = 2440588."""
    t = col_of(epoch)
    number = F.datediff(t, F.lit("1970-01-01").cast("date")) + F.lit(2440588)
    return (
        number
        + (F.hour(t) - F.lit(12)) / F.lit(24.0)
        + F.minute(t) / F.lit(1440.0)
        + F.floor(F.second(t)) / F.lit(86400.0)
    )


def with_solar_position(
    df: DataFrame, lat: float, lon: float, epoch: str = "epoch"
) -> DataFrame:
    """Add solar_zenith, solar_azimuth and solar_elevation in degrees.

    Each intermediate is its own projection so that none is computed twice.
    """
    rad, deg, sin, cos = F.radians, F.degrees, F.sin, F.cos
    c = F.col
    out = df.withColumn("__jc", (julian_day(epoch) - F.lit(2451545.0)) / F.lit(36525.0))
    jc = c("__jc")
    out = out.withColumns(
        {
            "__long": F.pmod(
                F.lit(280.46646) + jc * (F.lit(36000.76983) + jc * F.lit(0.0003032)), F.lit(360.0)
            ),
            "__anom": F.lit(357.52911) + jc * (F.lit(35999.05029) - F.lit(0.0001537) * jc),
            "__ecc": F.lit(0.016708634) - jc * (F.lit(0.000042037) + F.lit(0.0000001267) * jc),
            "__node": rad(F.lit(125.04) - F.lit(1934.136) * jc),
            "__obliq": F.lit(23)
            + (
                F.lit(26)
                + (
                    F.lit(21.448)
                    - jc * (F.lit(46.815) + jc * (F.lit(0.00059) - jc * F.lit(0.001813)))
                )
                / F.lit(60.0)
            )
            / F.lit(60.0),
        }
    )
    anom, long, ecc = c("__anom"), c("__long"), c("__ecc")
    out = out.withColumns(
        {
            "__applong": long
            + sin(rad(anom)) * (F.lit(1.914602) - jc * (F.lit(0.004817) + F.lit(0.000014) * jc))
            + sin(rad(anom * 2)) * (F.lit(0.019993) - F.lit(0.000101) * jc)
            + sin(rad(anom * 3)) * F.lit(0.000289)
            - F.lit(0.00569)
            - F.lit(0.00478) * sin(c("__node")),
            "__tilt": rad(c("__obliq") + F.lit(0.00256) * cos(c("__node"))),
        }
    )
    out = out.withColumns(
        {
            "__decl": F.asin(clip(sin(c("__tilt")) * sin(rad(c("__applong"))), -1.0, 1.0)),
            "__y": F.pow(F.tan(c("__tilt") / 2), F.lit(2.0)),
        }
    )
    y = c("__y")
    eq_time = F.lit(4.0) * deg(
        y * sin(rad(long) * 2)
        - ecc * sin(rad(anom)) * 2
        + ecc * y * sin(rad(anom)) * cos(rad(long) * 2) * 4
        - y * y * sin(rad(long) * 4) * F.lit(0.5)
        - ecc * ecc * sin(rad(anom) * 2) * F.lit(1.25)
    )
    t = F.col(epoch)
    minutes = (
        F.hour(t) + F.minute(t) / F.lit(60.0) + F.floor(F.second(t)) / F.lit(3600.0)
    ) * F.lit(60.0)
    out = out.withColumn(
        "__solar_time", F.pmod(minutes + eq_time + F.lit(4.0 * lon), F.lit(1440.0))
    )
    angle = c("__solar_time") / F.lit(4.0) - F.lit(180.0)
    out = out.withColumn("__ha", F.when(angle < 0, angle + 360).otherwise(angle))
    sl, cl = F.lit(math.sin(math.radians(lat))), F.lit(math.cos(math.radians(lat)))
    out = out.withColumn(
        "solar_zenith",
        deg(
            F.acos(clip(sl * sin(c("__decl")) + cl * cos(c("__decl")) * cos(rad(c("__ha"))), -1.0, 1.0))
        ),
    )
    zen = rad(c("solar_zenith"))
    raw = deg(F.acos(clip(F.try_divide(sl * cos(zen) - sin(c("__decl")), cl * sin(zen)), -1.0, 1.0)))
    out = out.withColumn("__az", F.when(c("__ha") > 0, raw).otherwise(F.lit(360.0) - raw))
    # One-element explode: without it a filter on the elevation is pushed down
    # through all the projections above, each intermediate copied where it is
    # used, into an expression too large to compile.
    sun = F.struct(
        c("solar_zenith"),
        c("__az").alias("solar_azimuth"),
        (F.lit(90.0) - c("solar_zenith")).alias("solar_elevation"),
    )
    return out.select(*df.columns, F.explode(F.array(sun)).alias("__sun")).select(
        *df.columns, "__sun.*"
    )


def daytime_only(
    df: DataFrame, lat: float, lon: float, epoch: str = "epoch", twilight: float = CIVIL_TWILIGHT
) -> DataFrame:
    sun = with_solar_position(df, lat, lon, epoch)
    return sun.where(F.col("solar_elevation") > twilight).select(*df.columns)


def solar_bin(elevation: Column, n_bins: int = 12) -> Column:
    """0-based bin over [-20, 90] degrees, left-closed, ends clipped."""
    width = 110.0 / n_bins
    raw = F.floor((elevation + F.lit(20.0)) / F.lit(width))
    return clip(raw, 0, n_bins - 1).cast("int")


def solar_bin_centres(n_bins: int = 12) -> list[float]:
    width = 110.0 / n_bins
    return [-20 + width * (i + 0.5) for i in range(n_bins)]


def corrected(
    value: Column, zenith: Column, method: str = "normalize", reference_zenith: float = 45.0
) -> Column:
    """Zenith-normalised value (``normalize``) or value over cos zenith (``cos_correction``)."""
    cosine = F.cos(F.radians(zenith))
    if method == "normalize":
        factor = F.try_divide(F.lit(math.cos(math.radians(reference_zenith))), cosine)
        return value * F.when(cosine == 0, F.lit(2.0)).otherwise(clip(factor, 0.5, 2.0))
    if method == "cos_correction":
        return value / clip(cosine, 0.1, 1.0)
    raise ValueError(f"unknown correction method {method!r}")


def residual_correction(df: DataFrame, value: str, epoch: str = "epoch", degree: int = 4) -> DataFrame:
    """Subtract a polynomial in hour of day fitted to the whole series.

    Spark adds up the moments of the normal equations; only those few sums
    reach the driver, which solves them.
    """
    import numpy as np

    # Centred and scaled hours keep the normal equations well conditioned.
    h = (clock_hour(epoch) - F.lit(12.0)) / F.lit(12.0)
    v = F.col(value)
    good = df.where(v.isNotNull())
    sums = good.agg(
        F.count(v).alias("n"),
        *[F.sum(F.pow(h, F.lit(float(k)))).alias(f"s{k}") for k in range(2 * degree + 1)],
        *[F.sum(v * F.pow(h, F.lit(float(k)))).alias(f"t{k}") for k in range(degree + 1)],
    ).first()
    if sums["n"] <= 10:
        return df.withColumn(f"{value}_corrected", v)
    a = np.array([[sums[f"s{i + j}"] for j in range(degree + 1)] for i in range(degree + 1)])
    b = np.array([sums[f"t{i}"] for i in range(degree + 1)])
    coef = np.linalg.lstsq(a, b, rcond=None)[0]
    model = F.lit(float(coef[degree]))
    for k in range(degree - 1, -1, -1):
        model = model * h + F.lit(float(coef[k]))
    return df.withColumn(f"{value}_corrected", v - model)


def sunrise_sunset(dates: DataFrame, lat: float, lon: float, date: str = "date") -> DataFrame:
    """First and last whole minute of each UTC day with the sun above the horizon."""
    start = F.col(date).cast("timestamp_ntz")
    minutes = F.sequence(F.lit(0), F.lit(1439))
    per_minute = dates.select(date).distinct().withColumn("__m", F.explode(minutes))
    per_minute = per_minute.withColumn(
        "__t", start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("__m"))
    )
    sun = with_solar_position(per_minute, lat, lon, "__t")
    up = F.when(F.col("solar_elevation") > 0, F.col("__t"))
    return sun.groupBy(date).agg(F.min(up).alias("sunrise"), F.max(up).alias("sunset"))
