"""Constellations, bands and codes as small dimension tables.

The sizes are fixed by the constellations (a few thousand sids), so these
tables may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Number of satellite slots per system.
SLOTS = {"G": 32, "E": 36, "R": 24, "C": 63, "I": 14, "S": 36, "J": 10}

# Band name -> (RINEX band digit, centre MHz, bandwidth MHz, tracking codes).
BANDS = {
    "C": {
        "B1I": ("2", 1561.098, 4.092, "IQX"),
        "B1C": ("1", 1575.42, 32.736, "DPXAN"),
        "B2a": ("5", 1176.45, 20.46, "DPX"),
        "B2b": ("7", 1207.14, 20.46, "IQXDPZ"),
        "B3I": ("6", 1268.52, 20.46, "IQXA"),
        "B2": ("8", 1191.795, 51.15, "DPX"),
    },
    "G": {
        "L1": ("1", 1575.42, 30.69, "CSLXPWYMN"),
        "L2": ("2", 1227.60, 30.69, "CDSLXPWYMN"),
        "L5": ("5", 1176.45, 24.0, "IQX"),
    },
    "E": {
        "E1": ("1", 1575.42, 24.552, "ABCXZ"),
        "E5a": ("5", 1176.45, 20.46, "IQX"),
        "E5b": ("7", 1207.14, 20.46, "IQX"),
        "E6": ("6", 1278.75, 40.92, "ABCXZ"),
        "E5": ("8", 1191.795, 51.15, "IQX"),
    },
    "R": {
        "G3": ("3", 1202.025, 7.875, "IQX"),
        "G1a": ("4", 1600.995, 7.875, "ABX"),
        "G2a": ("6", 1248.06, 7.875, "ABX"),
        "G1": ("1", 1602.28125, 8.3345, "CP"),
        "G2": ("2", 1246.21875, 6.7095, "CP"),
    },
    "I": {
        "L5": ("5", 1176.45, 24.0, "ABCX"),
        "S": ("9", 2492.028, 16.5, "ABCX"),
    },
    "S": {
        "L1": ("1", 1575.42, 30.69, "C"),
        "L5": ("5", 1176.45, 24.0, "IQX"),
    },
    "J": {
        "L1": ("1", 1575.42, 30.69, "CSLXZ"),
        "L2": ("2", 1227.60, 30.69, "SLX"),
        "L5": ("5", 1176.45, 24.0, "IQXDPZ"),
        "L6": ("6", 1278.75, 42.0, "SLXEZ"),
    },
}

# Bands whose spectra overlap; a band belongs to its first group.
OVERLAP_GROUPS = {
    "group_1": ("L1", "E1", "B1I", "B1C", "S", "J1"),
    "group_2": ("L5", "E5a", "B2a", "S", "J5", "I5"),
    "group_3": ("L2", "G2", "E5b", "B2b", "B2I", "B2", "G2a"),
    "group_4": ("E5a", "E5b", "E5"),
    "group_5": ("B2a", "B2b", "B2"),
    "group_6": ("E6", "B3I", "L6"),
    "group_7": ("G1",),
    "group_8": ("G2",),
    "group_9": ("G3",),
}

# The stock preference, whose keys name no group above, so it keeps everything.
DEFAULT_PREFERENCE = {"L1_E1_B1I": "L1", "L5_E5a": "L5", "L2_E5b_B2b": "L2"}


def group_of_band(band: str) -> str | None:
    for group, members in OVERLAP_GROUPS.items():
        if band in members:
            return group
    return None


def band_rows() -> list[tuple]:
    """(system, band, digit, codes, freq_center, freq_min, freq_max, overlap_group)."""
    return [
        (system, band, digit, list(codes), f, f - bw / 2, f + bw / 2, group_of_band(band))
        for system, bands in BANDS.items()
        for band, (digit, f, bw, codes) in bands.items()
    ]


def bands(spark: SparkSession) -> DataFrame:
    """One row per (system, band)."""
    return spark.createDataFrame(
        band_rows(),
        "system string, band string, digit string, codes array<string>, freq_center double,"
        " freq_min double, freq_max double, overlap_group string",
    )


def signals(spark: SparkSession, keep_sids: Iterable[str] | None = None) -> DataFrame:
    """Every sid of every constellation: slots x bands x codes."""
    slots = spark.createDataFrame(list(SLOTS.items()), "system string, slots int")
    out = (
        bands(spark)
        .join(F.broadcast(slots), "system")  # seven rows
        .withColumn("slot", F.explode(F.sequence(F.lit(1), "slots")))
        .withColumn("sv", F.concat("system", F.lpad(F.col("slot").cast("string"), 2, "0")))
        .withColumn("code", F.explode("codes"))
        .withColumn("sid", F.concat_ws("|", "sv", "band", "code"))
        .select(
            "sid", "sv", "system", "band", "code", "freq_center", "freq_min", "freq_max", "overlap_group"
        )
    )
    return out if keep_sids is None else out.where(F.col("sid").isin(list(keep_sids)))


def sids_of_sv(sv: Column) -> Column:
    """Array of all sids of a satellite, sorted; empty for an unknown system."""
    lookup = {
        system: sorted(f"|{band}|{code}" for band, spec in table.items() for code in spec[3])
        for system, table in BANDS.items()
    }
    suffixes = F.create_map(
        *[x for s, v in lookup.items() for x in (F.lit(s), F.array(*map(F.lit, v)))]
    )
    empty = F.array().cast("array<string>")
    mine = F.coalesce(F.try_element_at(suffixes, F.substring(sv, 1, 1)), empty)
    return F.transform(mine, lambda s: F.concat(sv, s))


def expand_sv_to_sid(aux: DataFrame, sv: str = "sv") -> DataFrame:
    """Replicate satellite rows onto every sid the satellite can emit."""
    return aux.withColumn("sid", F.explode(sids_of_sv(F.col(sv)))).drop(sv)


def densify(obs: DataFrame, keep_sids: Iterable[str] | None = None) -> DataFrame:
    """Rows for every (epoch, sid of the global space); absent observations are NULL.

    Only for export: the engine itself stays sparse. Each epoch row explodes a
    constant array, so there is no join against all sids.
    """
    universe = sorted(
        f"{system}{slot:02d}|{band}|{code}"
        for system, table in BANDS.items()
        for band, spec in table.items()
        for code in spec[3]
        for slot in range(1, SLOTS[system] + 1)
    )
    if keep_sids is not None:
        keep = set(keep_sids)
        universe = [s for s in universe if s in keep]
    epochs = obs.select("epoch").distinct()
    full = epochs.withColumn("sid", F.explode(F.array(*map(F.lit, universe))))
    return full.join(obs, ["epoch", "sid"], "left")


def band_of(sid: Column) -> Column:
    """Second part of a sid, or ''."""
    parts = F.split(sid, r"\|")
    return F.when(F.size(parts) >= 2, F.get(parts, F.lit(1))).otherwise(F.lit(""))


def prefer_overlapping(
    obs: DataFrame, preference: Mapping[str, str] | None = None
) -> DataFrame:
    """In each overlap group named in ``preference`` keep only the preferred band."""
    preference = DEFAULT_PREFERENCE if preference is None else preference
    dropped = [
        band
        for band in {b for table in BANDS.values() for b in table}
        | {b for members in OVERLAP_GROUPS.values() for b in members}
        if group_of_band(band) in preference and preference[group_of_band(band)] != band
    ]
    if not dropped:
        return obs
    return obs.where(~band_of(F.col("sid")).isin(sorted(dropped)))


def glonass_frequency(channel: Column, band: str) -> Column:
    """FDMA carrier in MHz for band G1 or G2."""
    if band == "G1":
        return F.lit(1602.0) + channel * F.lit(9.0) / F.lit(16.0)
    if band == "G2":
        return F.lit(1246.0) + channel * F.lit(7.0) / F.lit(16.0)
    raise ValueError(f"no FDMA channels on band {band!r}")
