"""Helpers the text operators share."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafwave.session import checkpoint_dir

#: Separators between words: space and the ASCII controls tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE = "[\\x20\\x09-\\x0D]"
SPACE_RUN = f"{SPACE}+"
WORD = "[^\\x20\\x09-\\x0D]+"


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new folder beside the cluster's checkpoints and read it back.

    Cuts lineage, survives lost executors, and gives later joins a table whose
    size the planner knows, so small ones are broadcast and large ones are not.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/leafwave-llm/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def word_count(text: Column) -> Column:
    """Number of words without building them: starts of runs that are not separators."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns of ``df`` under fixed names, so others may clash freely."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(value: Column) -> Column:
    """``value`` as a generated column: filters on it stay above it, so it is worked out once per row."""
    return F.explode(F.array(value))


def kept_in_worker(name: str, make: Callable[[], object]):
    """What ``make`` gives, made once per Python worker and used again by its later tasks."""
    held = sys.modules.setdefault("_leafwave_worker", types.ModuleType("_leafwave_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def saved_at(df: DataFrame) -> tuple[DataFrame, str]:
    """Like ``saved``, with the folder, for steps that ``remove`` it once nothing reads it any more."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/leafwave-llm/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``saved_at`` wrote."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
