"""Order-free fingerprints of tables, and frozen outputs to compare later ones with.

A row's hash covers its keys and one variable; a day's fingerprint of that
variable is the sum of the hashes of its rows. Sums do not depend on order or
partitioning and combine before the shuffle, so two tables of any size compare
in one pass each, and what differs is named by day and variable. Repeated rows
count as often as they come; a NULL is a value of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

KEYS = ("epoch", "sid")
SUM = "decimal(38,0)"
#: A frozen day is written by as many tasks at most.
FILES_A_DAY = 8


def fingerprints(df: DataFrame, variables: Sequence[str] | None = None, keys: Sequence[str] = KEYS, time: str = "epoch") -> DataFrame:
    """(day, variable, n, fingerprint); NULL times are a day of their own."""
    variables = [c for c in df.columns if c not in keys] if variables is None else list(variables)
    hashes = [F.sum(F.xxhash64(*keys, F.lit(v), F.col(f"`{v}`"), F.col(f"`{v}`").isNull()).cast(SUM)).alias(f"__{i}") for i, v in enumerate(variables)]
    days = df.groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("n"), *hashes)
    each = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"__{i}").alias("fingerprint")) for i, v in enumerate(variables)])
    return days.select("day", "n", F.inline(each)).select("day", "variable", "n", "fingerprint")


def table_fingerprint(df: DataFrame, variables: Sequence[str] | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: number of rows, and 16 hex digits for what all of them hold."""
    per = fingerprints(df, variables, keys).groupBy("variable").agg(F.sum("n").alias("n"), F.sum("fingerprint").cast("string").alias("sum"))
    parts = F.array_sort(F.collect_list(F.concat_ws(":", "variable", "n", "sum")))
    return per.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.substring(F.md5(F.array_join(parts, "|")), 1, 16).alias("fingerprint"))


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """(day, variable, n_before, n_after, same) of two sets of ``fingerprints``; what one side lacks counts 0 rows."""
    a, b = (d.select("day", "variable", F.col("n").alias(f"n_{s}"), F.col("fingerprint").alias(f"f_{s}")) for d, s in ((before, "before"), (after, "after")))
    b = b.withColumnsRenamed({"day": "day_b", "variable": "variable_b"})
    met = a.join(b, a["day"].eqNullSafe(b["day_b"]) & (a["variable"] == b["variable_b"]), "full_outer")
    return met.select(
        F.coalesce("day", "day_b").alias("day"), F.coalesce("variable", "variable_b").alias("variable"),
        F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"),
        F.coalesce((F.col("n_before") == F.col("n_after")) & (F.col("f_before") == F.col("f_after")), F.lit(False)).alias("same"),
    )


def freeze(df: DataFrame, path: str, metadata: dict[str, str] | None = None, keys: Sequence[str] = KEYS) -> str:
    """Keep a known-good output below ``path``: its rows by day, their fingerprints and what else should be known of it."""
    days = df.withColumn("__day", F.to_date(keys[0]))
    days.repartition("__day", F.pmod(F.xxhash64(*keys), F.lit(FILES_A_DAY))).write.mode("overwrite").partitionBy("__day").parquet(f"{path}/rows")
    kept = df.sparkSession.read.schema(days.schema).parquet(f"{path}/rows").drop("__day")
    fingerprints(kept, keys=keys).coalesce(1).write.mode("overwrite").parquet(f"{path}/fingerprints")
    told = [(k, str(v)) for k, v in (metadata or {}).items()]
    df.sparkSession.createDataFrame(told, "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
    return path


def compare_with_frozen(df: DataFrame, path: str, variables: Sequence[str] | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """``compare`` with a frozen output, whose rows need not be read; by default over the variables either side has."""
    before = df.sparkSession.read.parquet(f"{path}/fingerprints")
    before = before if variables is None else before.where(F.col("variable").isin(list(variables)))
    return compare(before, fingerprints(df, variables, keys))


def frozen_days(spark: SparkSession, path: str, differing: DataFrame) -> DataFrame:
    """The frozen rows of the days that differ, for a closer look; only their folders are read."""
    days = differing.where("NOT same").select(F.col("day").alias("__day")).distinct()
    return spark.read.parquet(f"{path}/rows").join(F.broadcast(days), "__day", "left_semi").drop("__day")
