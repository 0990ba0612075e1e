"""Streaming statistics: a row per day, group and variable that merges with others of its kind.

Each row holds counts, extremes, sums and a KLL sketch of the values, so the
statistics of any span of days, or of all receivers together, come from the
stored rows alone, without the observations. Days are written by dynamic
overwrite: a day that is collected again replaces itself and no other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The quantiles that are told by default.
PROBS = (0.001, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)
EPSILON = 0.01


def sketch_size(epsilon: float) -> int:
    """The sketch's k for a rank error of ``epsilon`` with 99 % confidence, by the published fit of KLL sketches."""
    return min(65_535, max(8, math.ceil((2.446 / epsilon) ** (1 / 0.9433))))


def day_sketches(
    df: DataFrame, variables: Sequence[str] = ("SNR",), keys: Sequence[str] = (), time: str = "epoch", epsilon: float = EPSILON
) -> DataFrame:
    """(day, keys, variable, n, n_missing, min, max, total, squares, sketch); NULL and NaN are missing."""
    value = F.col("value")
    each = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"`{v}`").cast("double").alias("value")) for v in variables])
    rows = df.select(F.to_date(time).alias("day"), *keys, F.inline(each)).withColumn("value", F.when(~F.isnan(value), value))
    return rows.groupBy("day", *keys, "variable").agg(
        F.count(value).alias("n"), F.sum(value.isNull().cast("bigint")).alias("n_missing"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.sum(value).alias("total"), F.sum(value * value).alias("squares"), F.kll_sketch_agg_double(value, F.lit(sketch_size(epsilon))).alias("sketch"),
    )


def merged(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``day_sketches`` put together by (keys, variable), over all their days and other keys."""
    return sketches.where("n > 0 OR n_missing > 0").groupBy(*keys, "variable").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def summary(rows: DataFrame, probs: Sequence[float] = PROBS) -> DataFrame:
    """mean, std (population) and the array ``quantiles`` in place of sums and sketch; NULL where there are no values."""
    n = F.col("n")
    mean = F.try_divide("total", n)
    spread = F.sqrt(F.greatest(F.try_divide("squares", n) - mean * mean, F.lit(0.0)))
    quantiles = F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs])))
    return rows.select(*[c for c in rows.columns if c not in ("total", "squares", "sketch")], mean.alias("mean"), spread.alias("std"), quantiles.alias("quantiles"))


def day_histograms(
    df: DataFrame, variable: str, low: float, high: float, n_bins: int, keys: Sequence[str] = (), time: str = "epoch"
) -> DataFrame:
    """(day, keys, variable, bin, n) over equal bins of [low, high]; -1 and ``n_bins`` are what lies below and above.

    The last bin includes ``high``. Histograms of days merge by adding up.
    """
    x = F.col(f"`{variable}`").cast("double")
    place = F.floor((x - F.lit(float(low))) / F.lit((high - low) / n_bins)).cast("int")
    bin_: Column = F.when(x < low, -1).when(x > high, n_bins).otherwise(F.least(place, F.lit(n_bins - 1)))
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(F.to_date(time).alias("day"), *keys, F.lit(variable).alias("variable"), bin_.alias("bin"))
    return rows.groupBy("day", *keys, "variable", "bin").agg(F.count(F.lit(1)).alias("n"))


def save(sketches: DataFrame, path: str) -> str:
    """Write days of sketches or histograms, each in place of what was kept of it."""
    sketches.withColumn("__day", F.col("day")).repartition("__day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__day").parquet(path)
    return path


def load(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Kept days from ``start`` to ``end``, both included; other days are not read."""
    rows = spark.read.parquet(path)
    rows = rows if start is None else rows.where(F.col("__day") >= F.lit(start).cast("date"))
    rows = rows if end is None else rows.where(F.col("__day") <= F.lit(end).cast("date"))
    return rows.drop("__day")
