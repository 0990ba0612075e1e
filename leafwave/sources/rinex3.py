"""RINEX 3 observation files.

An epoch block starts with '>' and needs nothing but the header's column
layout, so files are read as '\\n>'-separated records: splits of any size, no
ordering, no Python. The header is the record that ends with END OF HEADER.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafwave.functions.signals import BANDS, SLOTS
from leafwave.schema import OBSERVABLES
from leafwave.session import broadcast_checked, cut_lineage
from leafwave.sources.lines import number, read_records, timestamp_of

EPOCH_PATTERN = r"^\s*(\d{4})\s+(\d{2})\s+(\d{2})\s+(\d{2})\s+(\d{2})\s+(\d+\.\d+)\s+(\d+)\s+(\d+)"
HEADER_END = "END OF HEADER"
OBS_TYPES = "SYS / # / OBS TYPES"
FIELD = 16
MAX_BROADCAST_FILES = 20_000


def _label(line: Column) -> Column:
    return F.rtrim(F.substring(line, 61, 20))


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r", ""), "\n")


def header_codes(header: Column) -> Column:
    """Array of system letter + observation code, in column order; continuation lines inherit the system."""
    typed = F.filter(_lines(header), lambda line: _label(line) == OBS_TYPES)
    empty = F.struct(F.lit("").alias("sys"), F.array().cast("array<string>").alias("codes"))

    def step(acc: Column, line: Column) -> Column:
        own = F.trim(F.substring(line, 1, 1))
        system = F.when(own == "", acc["sys"]).otherwise(own)
        slots = F.transform(
            F.sequence(F.lit(0), F.lit(12)), lambda i: F.trim(F.substring(line, 8 + 4 * i, F.lit(3)))
        )
        codes = F.transform(F.filter(slots, lambda c: c != ""), lambda c: F.concat(system, c))
        return F.struct(system.alias("sys"), F.concat(acc["codes"], codes).alias("codes"))

    return F.aggregate(typed, empty, step, lambda acc: acc["codes"])


def _band_names() -> Column:
    pairs = [
        x
        for system, bands in BANDS.items()
        for band, spec in bands.items()
        for x in (F.lit(system + spec[0]), F.lit(band))
    ]
    return F.create_map(*pairs)


def layout_of(codes: Column) -> Column:
    """Map from system to its signals: band, code and the column of S, C, L and D (0 = none)."""
    systems = F.array_distinct(F.transform(codes, lambda c: F.substring(c, 1, 1)))

    def signals_of(system: Column) -> Column:
        mine = F.transform(
            F.filter(codes, lambda c: F.substring(c, 1, 1) == system), lambda c: F.substring(c, 2, 3)
        )
        suffixes = F.array_distinct(
            F.transform(F.filter(mine, lambda c: F.length(c) == 3), lambda c: F.substring(c, 2, 2))
        )

        def signal(s: Column) -> Column:
            digit = F.substring(s, 1, 1)
            band = F.coalesce(
                F.try_element_at(_band_names(), F.concat(system, digit)), F.concat(F.lit("UnknownBand"), digit)
            )
            at = {k: F.array_position(mine, F.concat(F.lit(k), s)).cast("int") for k in "SCLD"}
            columns = F.sort_array(F.filter(F.array(*at.values()), lambda p: p > 0), False)
            return F.struct(
                band.alias("band"), F.substring(s, 2, 1).alias("code"),
                *[at[k].alias(k) for k in "SCLD"], columns.alias("columns"),
            )

        return F.transform(suffixes, signal)

    return F.map_from_entries(F.transform(systems, lambda s: F.struct(s, signals_of(s))))


def parse_header(records: DataFrame) -> DataFrame:
    """One row per file: layout, marker, receiver, antenna and approximate position."""
    rows = records.where(F.col("record").contains(HEADER_END))
    lines = _lines(F.col("record"))

    def first(label: str) -> Column:
        return F.get(F.filter(lines, lambda x: _label(x) == label), F.lit(0))

    pos = first("APPROX POSITION XYZ")
    return rows.select(
        "path",
        F.trim(F.substring("record", 1, 9)).alias("version"),
        F.trim(F.substring(first("MARKER NAME"), 1, 60)).alias("marker_name"),
        F.trim(F.substring(first("REC # / TYPE / VERS"), 21, 20)).alias("receiver_type"),
        F.trim(F.substring(first("ANT # / TYPE"), 21, 20)).alias("antenna_type"),
        *[number(F.substring(pos, 1 + 14 * i, 14)).alias(f"approx_{a}") for i, a in enumerate("xyz")],
        number(F.substring(first("INTERVAL"), 1, 10)).alias("interval_s"),
        header_codes(F.col("record")).alias("codes"),
    ).withColumn("layout", layout_of(F.col("codes")))


def is_stripped(headers: DataFrame) -> DataFrame:
    """Add ``stripped``: every observation code is a signal strength."""
    return headers.withColumn("stripped", F.forall("codes", lambda c: F.substring(c, 2, 1) == "S"))


def _field(line: Column, column: Column) -> Column:
    return F.substring(line, 4 + FIELD * (column - 1), F.lit(FIELD))


def _value(line: Column, column: Column) -> Column:
    return F.when(column > 0, number(F.substring(_field(line, column), 1, 14)))


def _digit(line: Column, columns: Column, offset: int) -> Column:
    """The indicator of the right-most column that has both a value and the digit."""
    found = F.filter(
        F.transform(
            columns,
            lambda c: F.when(
                _value(line, c).isNotNull() & F.substring(_field(line, c), offset, 1).rlike(r"^\d$"),
                F.substring(_field(line, c), offset, 1),
            ),
        ),
        lambda d: d.isNotNull(),
    )
    return F.get(found, F.lit(0)).try_cast("tinyint")


def parse_epochs(records: DataFrame, headers: DataFrame) -> DataFrame:
    """Observation rows (path, epoch, sid, SNR, ...) from epoch blocks.

    Blocks with an unreadable epoch line, satellites outside their
    constellation and rows without any value are dropped.
    """
    blocks = records.where(~F.col("record").contains(HEADER_END))
    part = lambda i: F.regexp_extract("record", EPOCH_PATTERN, i)
    epoch = timestamp_of(
        *[part(i).try_cast("int") for i in range(1, 6)], part(6).try_cast("decimal(16,6)")
    )
    blocks = blocks.withColumn("epoch", epoch).where(F.col("epoch").isNotNull())
    blocks = blocks.join(headers.select("path", "layout"), "path")
    body = F.slice(_lines(F.col("record")), 2, F.size(_lines(F.col("record"))))
    lines = blocks.select("path", "epoch", "layout", F.explode(body).alias("line"))
    sv = F.trim(F.substring("line", 1, 3))
    slots = F.create_map(*[x for k, v in SLOTS.items() for x in (F.lit(k), F.lit(v))])
    lines = lines.withColumn("sv", sv).where(
        F.substring("sv", 2, 2).try_cast("int").between(
            1, F.try_element_at(slots, F.substring("sv", 1, 1))
        )
        & (F.length("sv") == 3)
    )
    signals = F.try_element_at("layout", F.substring("sv", 1, 1))
    rows = lines.select("path", "epoch", "line", "sv", F.explode(signals).alias("g"))
    line = F.col("line")
    snr = _value(line, F.col("g.S"))
    out = rows.select(
        "path",
        "epoch",
        F.concat_ws("|", "sv", "g.band", "g.code").alias("sid"),
        F.when(snr != 0, snr).cast("float").alias("SNR"),
        _value(line, F.col("g.C")).alias("Pseudorange"),
        _value(line, F.col("g.L")).alias("Phase"),
        _value(line, F.col("g.D")).cast("float").alias("Doppler"),
        _digit(line, F.col("g.columns"), 15).alias("LLI"),
        _digit(line, F.col("g.columns"), 16).alias("SSI"),
    )
    return out.where(F.coalesce(*OBSERVABLES).isNotNull())


def read_rinex3(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] = OBSERVABLES,
    stripped: bool = False,
) -> DataFrame:
    """Observations of RINEX 3 files.

    ``stripped`` demands files that carry signal strengths only.
    """
    records = read_records(spark, path, "\n>")
    # Headers are written out once; while they are few, the epoch blocks meet
    # them without a shuffle of the text.
    headers = broadcast_checked(cut_lineage(parse_header(records)), MAX_BROADCAST_FILES)
    if stripped:
        bad = is_stripped(headers).where(~F.col("stripped")).select("path").take(1)
        if bad:
            raise ValueError(f"{bad[0]['path']} has observations other than signal strength")
        columns = ("SNR",)
    return parse_epochs(records, headers).select("path", "epoch", "sid", *columns)
