"""Signal ids: ``SV|Band|Code``, for example ``G01|L1|C``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.functions.timeutil import col_of

SV_PATTERN = r"^[GRECJSI]\d{2}$"


def make_sid(sv: Column | str, band: Column | str, code: Column | str) -> Column:
    return F.concat_ws("|", col_of(sv), col_of(band), col_of(code))


def sid_part(sid: Column | str, index: int) -> Column:
    return F.get(F.split(col_of(sid), r"\|"), F.lit(index))


def is_full_sid(sid: Column | str) -> Column:
    """Three parts and a well-formed satellite number."""
    parts = F.split(col_of(sid), r"\|")
    return (F.size(parts) == 3) & F.get(parts, F.lit(0)).rlike(SV_PATTERN)


def with_sid_parts(df: DataFrame, sid: str = "sid") -> DataFrame:
    """Add sv, system, band and code."""
    return (
        df.withColumn("sv", sid_part(sid, 0))
        .withColumn("system", F.substring("sv", 1, 1))
        .withColumn("band", sid_part(sid, 1))
        .withColumn("code", sid_part(sid, 2))
    )


def matches_pattern(
    sid: Column | str,
    system: str | None = None,
    band: str | None = None,
    code: str | None = None,
) -> Column:
    """True for three-part sids with this SV prefix, band and code; None matches any."""
    parts = F.split(col_of(sid), r"\|")
    cond = F.size(parts) == 3
    if system is not None:
        cond = cond & F.get(parts, F.lit(0)).startswith(system)
    if band is not None:
        cond = cond & (F.get(parts, F.lit(1)) == band)
    if code is not None:
        cond = cond & (F.get(parts, F.lit(2)) == code)
    return cond
