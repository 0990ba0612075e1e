"""Time expressions on TIMESTAMP_NTZ columns (session time zone UTC)."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

US = 1_000_000

# Seconds per frequency unit.
UNIT_SECONDS = {
    "s": 1,
    "sec": 1,
    "S": 1,
    "min": 60,
    "m": 60,
    "T": 60,
    "h": 3600,
    "H": 3600,
    "d": 86400,
    "D": 86400,
}


def freq_seconds(freq: str) -> int:
    """``"30s"``, ``"1min"``, ``"10T"``, ``"1H"``, ``"1D"`` to seconds."""
    match = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", freq)
    if not match or match.group(2) not in UNIT_SECONDS:
        raise ValueError(f"unknown frequency {freq!r}")
    return int(match.group(1) or 1) * UNIT_SECONDS[match.group(2)]


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 as BIGINT."""
    return F.unix_micros(col_of(c).cast("timestamp"))


def seconds(c: Column | str) -> Column:
    """Seconds since 1970-01-01 as DOUBLE, with the fraction kept."""
    return micros(c) / F.lit(float(US))


def from_micros(c: Column | str) -> Column:
    return F.timestamp_micros(col_of(c)).cast("timestamp_ntz")


def block_of(c: Column | str, width_seconds: float) -> Column:
    """Index of the fixed-width time block an epoch falls in."""
    us = micros(c)
    width = int(width_seconds * US)
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("bigint")


def floor_epoch(c: Column | str, freq: str) -> Column:
    """Epoch truncated to a multiple of ``freq`` since 1970-01-01."""
    us = micros(c)
    return from_micros(us - F.pmod(us, F.lit(freq_seconds(freq) * US)))


def clock_hour(c: Column | str) -> Column:
    """Hour of day with minutes as a fraction; seconds do not count."""
    return F.hour(c) + F.minute(c) / F.lit(60.0)


def between(c: Column | str, start=None, end=None) -> Column:
    """Inclusive range with either side open."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (col_of(c) >= F.lit(start))
    if end is not None:
        cond = cond & (col_of(c) <= F.lit(end))
    return cond


def yyyydoy(c: Column | str) -> Column:
    """Date key such as ``2025001``."""
    return F.date_format(col_of(c), "yyyyDDD")


def date_of_yyyydoy(c: Column | str) -> Column:
    return F.to_date(col_of(c), "yyyyDDD")


def date_of_yydoy(c: Column | str) -> Column:
    """Five-digit ``yyddd`` keys lie in 2000-2099."""
    return F.to_date(F.concat(F.lit("20"), col_of(c)), "yyyyDDD")


def gps_week(c: Column | str) -> Column:
    return F.floor(F.datediff(col_of(c), F.lit("1980-01-06").cast("date")) / 7).cast("int")


def gps_day_of_week(c: Column | str) -> Column:
    return F.pmod(F.datediff(col_of(c), F.lit("1980-01-06").cast("date")), F.lit(7)).cast("int")


def gps_time_to_utc(tow_ms: Column | str, week: Column | str, leap_seconds: Column | str) -> Column:
    """GPS week and time-of-week in ms, less the leap seconds, as an epoch."""
    us = (
        F.lit(315_964_800 * US)
        + col_of(week).cast("bigint") * F.lit(604_800 * US)
        + col_of(tow_ms).cast("bigint") * F.lit(1000)
        - col_of(leap_seconds).cast("bigint") * F.lit(US)
    )
    return from_micros(us)
