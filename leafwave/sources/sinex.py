"""Satellite metadata in SINEX blocks, as tables with validity periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafwave.sources.lines import fill_forward, number, read_lines

# Block name, shortest line, and (column, 1-based start, width, type) per field.
BLOCKS = {
    "prn": ("SATELLITE/PRN", 39, (("prn", 37, 3, "string"),)),
    "tx_power": ("SATELLITE/TX_POWER", 40, (("power_watts", 37, 4, "int"),)),
    "mass": ("SATELLITE/MASS", 46, (("mass_kg", 37, 10, "double"),)),
    "channel": ("SATELLITE/FREQUENCY_CHANNEL", 40, (("channel", 37, 4, "int"),)),
    "plane": ("SATELLITE/PLANE", 46, (("plane", 37, 1, "string"), ("slot", 39, 7, "string"))),
}


def snx_date(text: Column) -> Column:
    """``YYYY:DDD:SSSSS`` as a date; an all-zero epoch means open (NULL)."""
    year, doy = F.substring(text, 1, 4), F.substring(text, 6, 3)
    return F.when(~F.trim(text).rlike(r"^0+:0+:0+$"), F.try_to_date(F.concat(year, doy), "yyyyDDD"))


def _in_block(lines: DataFrame, name: str) -> DataFrame:
    marker = F.when(F.col("line").rlike(r"^[+-]"), F.col("line"))
    rows = fill_forward(lines, marker, "section")
    data = (F.rtrim("section") == f"+{name}") & ~F.col("line").rlike(r"^[+*%-]")
    return rows.where(data)


def parse_periods(lines: DataFrame, table: str) -> DataFrame:
    """(svn, start, end, fields) of one block; rows without a start or a value are dropped."""
    name, shortest, fields = BLOCKS[table]
    rows = _in_block(lines, name).where(F.length("line") >= shortest)
    cols = []
    for out, start, width, kind in fields:
        text = F.trim(F.substring("line", start, width))
        cols.append((text if kind == "string" else number(text, kind)).alias(out))
    out = rows.select(
        F.trim(F.substring("line", 2, 4)).alias("svn"),
        snx_date(F.substring("line", 7, 14)).alias("start"),
        snx_date(F.substring("line", 22, 14)).alias("end"),
        *cols,
    )
    needed = [f[0] for f in fields if f[3] != "string"]
    return out.where(F.col("start").isNotNull()).na.drop(subset=needed) if needed else out.where(
        F.col("start").isNotNull()
    )


def parse_identities(lines: DataFrame) -> DataFrame:
    """(svn, cospar_id, satcat, block)."""
    rows = _in_block(lines, "SATELLITE/IDENTIFIER").where(F.length("line") >= 44)
    return rows.select(
        F.trim(F.substring("line", 2, 4)).alias("svn"),
        F.trim(F.substring("line", 7, 10)).alias("cospar_id"),
        F.coalesce(number(F.substring("line", 18, 6), "int"), F.lit(0)).alias("satcat"),
        F.trim(F.substring("line", 24, 16)).alias("block"),
    )


def read_catalogue(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All tables of a metadata file; ``prn`` carries the satellite block as well."""
    lines = read_lines(spark, path)
    out = {t: parse_periods(lines, t) for t in BLOCKS}
    out["identity"] = parse_identities(lines)
    out["prn"] = out["prn"].join(out["identity"].select("svn", "block"), "svn", "left")
    return out
