"""Orbit (SP3) and clock (CLK) products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafwave.sources.lines import number, read_lines, read_records, timestamp_of

SP3_MISSING = "999999.999999"


def parse_sp3(records: DataFrame) -> DataFrame:
    """(path, epoch, sv, X, Y, Z in m) from epoch blocks (path, record without its '*').

    Epochs are whole minutes; the seconds field is ignored.
    """
    lines = F.split(F.regexp_replace("record", "\r", ""), "\n")
    head = F.split(F.trim(F.get(lines, F.lit(0))), r"\s+")
    part = lambda i: F.get(head, F.lit(i)).try_cast("int")
    epoch = timestamp_of(part(0), part(1), part(2), part(3), part(4), F.lit(0).cast("decimal(16,6)"))
    rows = records.select("path", epoch.alias("epoch"), F.explode(lines).alias("line"))
    rows = rows.where(F.col("epoch").isNotNull() & F.col("line").startswith("P"))

    def metres(start: int) -> Column:
        text = F.trim(F.substring("line", start, 14))
        return F.when(text != SP3_MISSING, number(F.regexp_replace(text, " ", ""))) * F.lit(1000.0)

    return rows.select(
        "path", "epoch", F.trim(F.substring("line", 2, 3)).alias("sv"),
        metres(5).alias("X"), metres(19).alias("Y"), metres(33).alias("Z"),
    )


def read_sp3(spark: SparkSession, path: str | list[str]) -> DataFrame:
    records = read_records(spark, path, "\n*")
    # The first record of a file is its header.
    return parse_sp3(records.where(~F.col("record").rlike(r"^#")))


def parse_clk(lines: DataFrame) -> DataFrame:
    """(path, epoch, sv, clock_offset) from the AS records; seconds are cut to whole ones."""
    rows = lines.where(F.col("line").startswith("AS")).withColumn("f", F.split(F.trim("line"), r"\s+"))
    f = lambda i: F.get("f", F.lit(i))
    second = F.floor(f(7).try_cast("double")).cast("decimal(16,6)")
    epoch = timestamp_of(*[f(i).try_cast("int") for i in range(2, 7)], second)
    return rows.select(
        "path", epoch.alias("epoch"), f(1).alias("sv"), f(9).try_cast("double").alias("clock_offset")
    )


def read_clk(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_clk(read_lines(spark, path))
