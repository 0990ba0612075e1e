"""File names: the canonical convention, receiver naming families and date matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The canonical name and the source families, most specific first. Groups:
# year, doy, hour, minute, period, sampling (long names) or doy, hour letter, minute, yy (short).
CANONICAL = (
    r"^([A-Z]{3})([RA])(\d{2})([A-Z]{3})_R_(\d{4})(\d{3})(\d{2})(\d{2})_(\d{2}[SMHD])_(\d{2}[SMHD])"
    r"_([A-Z0-9]{2})\.(rnx|sbf|ubx|nmea)(?:\.([a-z0-9]+))?$"
)
LONG_FAMILIES = {
    "canonical": (
        r"^[A-Z]{3}[RA]\d{2}[A-Z]{3}_R_(\d{4})(\d{3})(\d{2})(\d{2})_(\d{2}[SMHD])_(\d{2}[SMHD])"
        r"_[A-Z0-9]{2}\.(?:rnx|sbf|ubx|nmea)(?:\.[a-z0-9]+)?$"
    ),
    "rinex_v3_long": (
        r"^[A-Z0-9]{4}\d{2}[A-Z]{3}_R_(\d{4})(\d{3})(\d{2})(\d{2})_(\d{2}[SMHD])_(\d{2}[SMHD])"
        r"_[A-Z0-9]{2}\.(?:rnx|crx)(?:\.[a-z0-9]+)?$"
    ),
}
SHORT_FAMILIES = {
    "septentrio_sbf": r"^[a-zA-Z0-9]{4}(\d{3})([a-x0])(\d{2})\.(\d{2})_(?:\.[a-zA-Z0-9]+)?$",
    "septentrio_rinex_v2": r"^[a-zA-Z0-9]{4}(\d{3})([a-x])(\d{2})\.(\d{2})[oOdD](?:\.[a-zA-Z0-9]+)?$",
    "rinex_v2_short": r"^[a-zA-Z0-9]{4}(\d{3})([a-x0])()\.(\d{2})[oOdD](?:\.[a-zA-Z0-9]+)?$",
}
# Seconds per duration unit.
UNITS = {"S": 1, "M": 60, "H": 3600, "D": 86400}


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def duration_seconds(code: Column) -> Column:
    """``05S``, ``15M``, ``01H``, ``01D``."""
    unit = F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv])
    return F.substring(code, 1, 2).try_cast("int") * F.try_element_at(unit, F.substring(code, 3, 1))


def hour_of_letter(letter: Column) -> Column:
    low = F.lower(letter)
    return F.when(low == "0", 0).when(low.rlike("^[a-x]$"), F.ascii(low) - 97)


def full_year(yy: Column) -> Column:
    return yy + F.when(yy >= 80, 1900).otherwise(2000)


def parse_canonical(df: DataFrame, path: str = "path") -> DataFrame:
    """Parts of canonical names; rows that do not follow the convention are NULL."""
    name = base_name(F.col(path))
    g = lambda i: F.when(name.rlike(CANONICAL), F.regexp_extract(name, CANONICAL, i))
    num = lambda i: g(i).cast("int")
    return df.withColumns(
        {
            "site": g(1), "receiver_type": g(2), "receiver_number": num(3), "agency": g(4),
            "year": num(5), "doy": num(6), "hour": num(7), "minute": num(8), "period": g(9),
            "sampling": g(10), "content": g(11), "file_type": g(12),
            "compression": F.when(g(13) != "", g(13)),
        }
    )


def canonical_name() -> Column:
    """The canonical name from columns named as in ``parse_canonical``."""
    stem = F.format_string(
        "%s%s%02d%s_R_%04d%03d%02d%02d_%s_%s_%s.%s", "site", "receiver_type", "receiver_number", "agency",
        "year", "doy", "hour", "minute", "period", "sampling", "content", "file_type",
    )
    return F.when(F.col("compression").isNotNull(), F.concat_ws(".", stem, "compression")).otherwise(stem)


def match_families(df: DataFrame, path: str = "path") -> DataFrame:
    """Add family, year, doy, hour, minute, period and sampling by the first family that fits."""
    name = base_name(F.col(path))
    out = {c: F.lit(None) for c in ("family", "year", "doy", "hour", "minute", "period", "sampling")}
    order = [*LONG_FAMILIES.items(), *SHORT_FAMILIES.items()]
    for family, pattern in reversed(order):
        hit = name.rlike(pattern)
        g = lambda i: F.regexp_extract(name, pattern, i)  # noqa: E731,B023
        if family in LONG_FAMILIES:
            found = {
                "year": g(1).try_cast("int"), "doy": g(2).try_cast("int"), "hour": g(3).try_cast("int"),
                "minute": g(4).try_cast("int"), "period": g(5), "sampling": g(6),
            }
        else:
            found = {
                "year": full_year(g(4).try_cast("int")), "doy": g(1).try_cast("int"), "hour": hour_of_letter(g(2)),
                "minute": F.coalesce(g(3).try_cast("int"), F.lit(0)), "period": F.lit(None), "sampling": F.lit(None),
            }
        found["family"] = F.lit(family)
        out = {c: F.when(hit, found[c]).otherwise(out[c]) for c in out}
    kinds = {"family": "string", "period": "string", "sampling": "string"}
    return df.withColumns({c: v.cast(kinds.get(c, "int")) for c, v in out.items()})


def sampling_interval(path: Column) -> Column:
    """Seconds from the fifth '_' part of a long name; ``01Z`` is a rate in Hz."""
    stem = F.regexp_replace(base_name(path), r"\.[^.]*$", "")
    part = F.get(F.split(stem, "_"), F.lit(4))
    value = F.regexp_extract(part, r"^(\d+)([SMHDZ])$", 1).try_cast("double")
    unit = F.regexp_extract(part, r"^(\d+)([SMHDZ])$", 2)
    scale = F.create_map(*[F.lit(x) for k, v in UNITS.items() for x in (k, float(v))])
    return F.when(unit == "Z", F.try_divide(F.lit(1.0), value)).otherwise(value * F.try_element_at(scale, unit))


def parse_recipe(df: DataFrame, fields: Sequence[tuple[str, int]], path: str = "path") -> DataFrame:
    """Fixed-width fields of a name; names of another length give NULL. A field named '' is skipped."""
    name = base_name(F.col(path))
    total = sum(width for _, width in fields)
    out, at = {}, 1
    for field, width in fields:
        if field:
            out[field] = F.when(F.length(name) == total, F.substring(name, at, width))
        at += width
    return df.withColumns(out)


def common_dates(listing: DataFrame, receivers: Sequence[str]) -> DataFrame:
    """Dates on which every listed receiver has a file; listing is (receiver, date, path)."""
    rows = listing.where(F.col("receiver").isin(list(receivers)))
    per_date = rows.groupBy("date").agg(F.countDistinct("receiver").alias("__n"))
    return per_date.where(F.col("__n") == len(set(receivers))).select("date")


def matched_pairs(listing: DataFrame, pairs: DataFrame) -> DataFrame:
    """(date, canopy, reference) where both receivers of a configured pair have files."""
    have = listing.select("receiver", "date").distinct()
    canopy = have.select(F.col("receiver").alias("canopy"), "date")
    reference = have.select(F.col("receiver").alias("reference"), "date")
    return pairs.join(canopy, "canopy").join(reference, ["reference", "date"])


def date_range(catalog: DataFrame, start: tuple[int, int], end: tuple[int, int], receiver_type: str | None = None) -> DataFrame:
    """Catalogue rows between two (year, doy), inclusive."""
    key = F.col("year") * 1000 + F.col("doy")
    rows = catalog.where(key.between(start[0] * 1000 + start[1], end[0] * 1000 + end[1]))
    if receiver_type is not None:
        rows = rows.where(F.col("receiver_type") == receiver_type)
    return rows


def upsert(catalog: DataFrame, new: DataFrame, key: str = "physical_path") -> DataFrame:
    """New rows replace old ones with the same key."""
    return catalog.join(new.select(key), key, "left_anti").unionByName(new)


def natural_key(path: Column) -> Column:
    """Sort key that orders digit runs by value."""
    padded = F.transform(
        F.regexp_extract_all(base_name(path), F.lit(r"(\d+|\D+)"), 1),
        lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 20, "0")).otherwise(p),
    )
    return F.array_join(padded, "")


def sniff(heads: DataFrame, line: str = "line", path: str = "path") -> DataFrame:
    """Format by first line and extension: nmea, rinex3, rinex2, sbf or NULL."""
    version = F.substring(line, 1, 9).try_cast("double")
    return heads.withColumn(
        "format",
        F.when(F.lower(path).endswith(".nmea") | F.col(line).rlike(r"^\$G"), "nmea")
        .when((version >= 3) & (version < 4), "rinex3")
        .when((version >= 2) & (version < 3), "rinex2")
        .when(F.col(line).startswith("$@"), "sbf"),
    )
