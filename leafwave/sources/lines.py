"""Text files as ordered lines, read in parallel splits.

Lines of one file keep their order as (split start, position in split). Split
sizes are bounded by ``spark.sql.files.maxPartitionBytes``, so state carried
down a file is filled forward within a split and then across split summaries;
no task ever holds a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, block, pos, line)."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.regexp_replace("value", r"\r$", "").alias("line"),
    )
    return raw


def read_records(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """(path, record): text between occurrences of ``separator``, split-safe."""
    raw = spark.read.option("lineSep", separator).text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("record"))


def fill_forward(lines: DataFrame, value: Column, out: str) -> DataFrame:
    """Last non-NULL ``value`` at or before each line of its file."""
    rows = lines.withColumn("__v", value)
    inside = (
        Window.partitionBy("path", "block")
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    across = (
        Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per split of a file.
    ends = rows.groupBy("path", "block").agg(
        F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("pos"))).alias("__e")
    )
    ends = ends.select("path", "block", F.last("__e", True).over(across).alias("__carry"))
    rows = rows.withColumn("__in", F.last("__v", True).over(inside))
    rows = rows.join(ends, ["path", "block"], "left")
    return rows.withColumn(out, F.coalesce("__in", "__carry")).drop("__v", "__in", "__carry")


def number(text: Column, kind: str = "double") -> Column:
    """Trimmed text as a number; NULL when blank or malformed."""
    return F.trim(text).try_cast(kind)


def timestamp_of(year, month, day, hour, minute, second) -> Column:
    """Epoch from fields (integers and decimal seconds); NULL when any is out of range."""
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second)


def file_registry(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modified, file_hash): the first 16 hex digits of each file's SHA-256."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
        F.substring(F.sha2("content", 256), 1, 16).alias("file_hash"),
    )
