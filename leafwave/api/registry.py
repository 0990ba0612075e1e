"""Named readers, grids and calculators, open to user additions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from leafwave.operators.grids import BUILDERS
from leafwave.operators.retrieval import CALCULATORS
from leafwave.session import cut_lineage
from leafwave.sources.filenames import sniff
from leafwave.sources.heads import read_heads
from leafwave.sources.nmea import read_nmea
from leafwave.sources.products import read_clk, read_sp3
from leafwave.sources.rinex2 import read_rinex2
from leafwave.sources.rinex3 import read_rinex3
from leafwave.sources.sbf import read_sbf

READERS: dict[str, Callable[..., DataFrame]] = {
    "rinex3": read_rinex3,
    "rinex2": read_rinex2,
    "nmea": read_nmea,
    "sbf": read_sbf,
    "sp3": read_sp3,
    "clk": read_clk,
}
REGISTRIES = {"reader": READERS, "grid": BUILDERS, "vod": CALCULATORS}


def register(kind: str, name: str, component: Callable) -> None:
    if not callable(component):
        raise TypeError(f"{name!r} is not callable")
    REGISTRIES[kind][name] = component


def available(kind: str) -> list[str]:
    return sorted(REGISTRIES[kind])


def detect_formats(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Files of each format, every file judged by its own name and first line; one row per file reaches the driver.

    Only the first bytes of each file are read, unless Spark alone can open the store.
    """
    try:
        heads = cut_lineage(read_heads(spark, path))
    except PySparkException:
        lines = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value",
            F.monotonically_increasing_id().alias("at"),
        )
        heads = lines.where("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    found: dict[str, list[str]] = {}
    unknown = []
    for row in sniff(heads).select("path", "format").orderBy("path").collect():
        (unknown if row["format"] is None else found.setdefault(row["format"], [])).append(row["path"])
    if unknown or not found:
        raise ValueError(f"cannot tell the format of {unknown or path}")
    return found


def detect_format(spark: SparkSession, path: str) -> str:
    """The one format of the file, or files, at ``path``."""
    found = detect_formats(spark, path)
    if len(found) > 1:
        raise ValueError(f"{path} holds files of several formats: {sorted(found)}")
    return next(iter(found))


def read_any(spark: SparkSession, path: str, reader: str | None = None, **options) -> DataFrame:
    """Rows of all files, each read by the reader of its format unless one is named."""
    parts = {reader: path} if reader else detect_formats(spark, path)
    for name in parts:
        if name not in READERS:
            raise ValueError(f"unknown reader {name!r}; one of {available('reader')}")
    tables = [READERS[name](spark, files, **options) for name, files in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
