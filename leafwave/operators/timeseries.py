"""Cell-weighted time series and diurnal cycles.

Each statistic is one aggregation pass: first per (bin, cell) with a map-side
combine, then per bin. The weighted spread comes from the weighted moments
about a fixed shift, floored at zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafwave.functions.solar import corrected, daytime_only, solar_bin, solar_bin_centres, with_solar_position
from leafwave.functions.timeutil import clock_hour, floor_epoch


def normalised_uniform(cells: DataFrame) -> DataFrame:
    """(cell_id, weight) with equal weights summing to 1."""
    n = cells.select(F.count(F.lit(1))).scalar()
    return cells.select("cell_id", (F.lit(1.0) / n).alias("weight"))


def _weighted_bins(df: DataFrame, weights: DataFrame, bin_name: str, value: str, cell: str) -> DataFrame:
    """Per bin: mean, std, n_cells, n_observations, sum_weights."""
    v = F.col(value)
    per_cell = (
        df.where(v.isNotNull() & F.col(cell).isNotNull())
        .groupBy(bin_name, F.col(cell).alias("cell_id"))
        .agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("s2"))
        .join(weights.select("cell_id", "weight"), "cell_id", "left")
        .withColumn("w", F.coalesce("weight", F.lit(0.0)) * F.col("n"))
    )
    w, m = F.col("w"), F.col("m")
    sums = per_cell.groupBy(bin_name).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.sum("n").alias("n_observations"),
        F.sum(w).alias("sum_weights"),
        F.sum(w * m).alias("__wm"),
        F.sum(w * (F.col("s2") + m * m)).alias("__w2"),
    )
    mean = F.try_divide(F.col("__wm"), F.col("sum_weights"))
    var = F.try_divide(F.col("__w2"), F.col("sum_weights")) - mean * mean
    return sums.select(
        bin_name,
        mean.alias("mean"),
        F.sqrt(F.when(var < 0, F.lit(0.0)).otherwise(var)).alias("std"),
        "n_cells",
        "n_observations",
        "sum_weights",
    )


def weighted_timeseries(
    df: DataFrame, weights: DataFrame, freq: str = "1h", value: str = "VOD", cell: str = "cell_id",
    min_cells: int = 1,
) -> DataFrame:
    """Weighted mean and weighted population std per time bin.

    Bins with fewer than ``min_cells`` distinct cells or no weight are dropped.
    """
    binned = df.withColumn("epoch", floor_epoch("epoch", freq))
    out = _weighted_bins(binned, weights, "epoch", value, cell)
    return out.where((F.col("n_cells") >= min_cells) & (F.col("sum_weights") > 0))


def clock_bin(epoch: Column | str, hour_bins: int = 24) -> Column:
    """0-based hour bin, right-closed, with hour 0 in the first bin."""
    h = clock_hour(epoch)
    return (F.greatest(F.ceil(h * hour_bins / F.lit(24.0)), F.lit(1)) - 1).cast("int")


def _dense_bins(spark: SparkSession, rows: list[tuple], stats: DataFrame, axis: str, min_obs: int) -> DataFrame:
    dim = spark.createDataFrame(rows, f"__bin int, {axis} double")
    enough = F.col("n_observations") >= min_obs
    return dim.join(stats, "__bin", "left").select(
        axis,
        F.when(enough, F.col("mean")).alias("mean"),
        F.when(enough, F.col("std")).alias("std"),
        F.when(enough, F.col("n_observations")).otherwise(F.lit(0)).cast("bigint").alias("n_observations"),
    )


def diurnal_cycle(
    df: DataFrame, weights: DataFrame, value: str = "VOD", cell: str = "cell_id", hour_bins: int = 24,
    min_observations: int = 10,
) -> DataFrame:
    """Weighted cycle over clock hours; every bin is emitted, thin ones as NULL with n = 0."""
    stats = _weighted_bins(df.withColumn("__bin", clock_bin("epoch", hour_bins)), weights, "__bin", value, cell)
    width = 24.0 / hour_bins
    rows = [(i, (i + 0.5) * width) for i in range(hour_bins)]
    return _dense_bins(df.sparkSession, rows, stats, "hour", min_observations)


def diurnal_cycle_solar(
    df: DataFrame, weights: DataFrame, lat: float, lon: float, value: str = "VOD",
    cell: str = "cell_id", n_bins: int = 12, min_observations: int = 10,
) -> DataFrame:
    """Weighted cycle over solar elevation."""
    sun = with_solar_position(df, lat, lon).withColumn("__bin", solar_bin(F.col("solar_elevation"), n_bins))
    stats = _weighted_bins(sun, weights, "__bin", value, cell)
    rows = list(enumerate(solar_bin_centres(n_bins)))
    return _dense_bins(df.sparkSession, rows, stats, "solar_elevation", min_observations)


def weighted_timeseries_solar(
    df: DataFrame, weights: DataFrame, lat: float, lon: float, freq: str = "1h", value: str = "VOD",
    method: str = "normalize", reference_zenith: float = 45.0, daytime: bool = False, **kw,
) -> DataFrame:
    """Correct for the sun's zenith angle, optionally keep daytime only, then the series."""
    if daytime:
        df = daytime_only(df, lat, lon)
    sun = with_solar_position(df, lat, lon)
    fixed = sun.withColumn(value, corrected(F.col(value), F.col("solar_zenith"), method, reference_zenith))
    return weighted_timeseries(fixed, weights, freq, value, **kw)


def with_solar_metadata(series: DataFrame, lat: float, lon: float) -> DataFrame:
    """Solar zenith, azimuth, elevation and a daytime flag on a time series."""
    sun = with_solar_position(series, lat, lon)
    return sun.withColumn("is_daytime", F.col("solar_elevation") > F.lit(-6.0))
