"""Per-cell, global and regional aggregation.

Everything here is a grouped aggregate with a map-side combine; medians go
through the skew-safe quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.functions.timeutil import between, clock_hour, floor_epoch
from leafwave.operators.grids import select_cells
from leafwave.operators.quantiles import group_median


def _valid(df: DataFrame, value: str, cell: str) -> DataFrame:
    return df.where(F.col(value).isNotNull() & F.col(cell).isNotNull())


def aggregate_by_cell(
    df: DataFrame, value: str = "VOD", method: str = "mean", cell: str = "cell_id", out: str | None = None
) -> DataFrame:
    """mean / median / std (sample) / count of ``value`` per cell."""
    out = out or value
    rows = _valid(df, value, cell) if method != "count" else df.where(F.col(cell).isNotNull())
    simple = {"mean": F.avg, "std": F.stddev_samp, "count": F.count}
    if method == "median":
        return group_median(rows, [cell], value, out)
    if method not in simple:
        raise ValueError(f"unknown method {method!r}")
    return rows.groupBy(cell).agg(simple[method](value).alias(out))


def aggregate_to_grid(
    df: DataFrame, cells: DataFrame, value: str = "VOD", stat: str = "mean", cell: str = "cell_id",
    sids: Sequence[str] | None = None, time_range: tuple | None = None, out: str = "vod_stat",
) -> DataFrame:
    """One row per grid cell, NULL where no observation fell."""
    if sids is not None:
        df = df.where(F.col("sid").isin(list(sids)))
    if time_range is not None:
        df = df.where(between("epoch", *time_range))
    agg = aggregate_by_cell(df, value, stat, cell, out).withColumnRenamed(cell, "cell_id")
    return cells.select("cell_id").join(agg, "cell_id", "left")


def percell_timeseries(
    df: DataFrame, freq: str = "1D", value: str = "VOD", cell: str = "cell_id", min_obs: int = 1,
    cells: DataFrame | None = None, theta_range=None, phi_range=None,
) -> DataFrame:
    """(cell, time): mean and count of the observations, bins below ``min_obs`` dropped."""
    rows = _valid(df, value, cell)
    if cells is not None:
        chosen = select_cells(cells, theta_range, phi_range).select(F.col("cell_id").alias(cell))
        rows = rows.join(chosen, cell, "left_semi")
    n = F.count(F.lit(1))
    out = (
        rows.groupBy(F.col(cell).alias("cell"), floor_epoch("epoch", freq).alias("time"))
        .agg(F.avg(value).alias("cell_timeseries"), n.alias("cell_counts"))
        .where(F.col("cell_counts") >= min_obs)
        .withColumn("cell_weights", F.col("cell_counts").cast("double"))
    )
    if cells is None:
        return out
    centre = cells.select(
        F.col("cell_id").alias("cell"),
        F.degrees("theta").alias("cell_theta"),
        F.degrees("phi").alias("cell_phi"),
    )
    return out.join(centre, "cell")


def hemisphere_percell(df: DataFrame, cells: DataFrame, **kw) -> DataFrame:
    return percell_timeseries(df, "1D", cells=cells, **kw)


def zenith_percell(df: DataFrame, cells: DataFrame, max_theta: float = 30.0, **kw) -> DataFrame:
    return percell_timeseries(df, "1D", cells=cells, theta_range=(0.0, max_theta), **kw)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value x weight over the sum of all weights; NULL when that is zero."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def global_average(percell: DataFrame) -> DataFrame:
    """Per time: count-weighted mean, unweighted population spread, weights, active cells."""
    v, w = F.col("cell_timeseries"), F.col("cell_weights")
    return percell.groupBy("time").agg(
        weighted_mean(v, w).alias("global_timeseries"),
        F.stddev_pop(v).alias("spatial_std"),
        F.sum(w).alias("total_weights"),
        F.count(v).alias("active_cells"),
    )


def regional_average(percell: DataFrame, region: DataFrame | Sequence[int]) -> DataFrame:
    """Count-weighted mean per time over some cells (ids, or a table with ``cell_id``)."""
    if isinstance(region, DataFrame):
        keep = region.select(F.col("cell_id").alias("cell"))
        rows = percell.join(keep, "cell", "left_semi")
    else:
        rows = percell.where(F.col("cell").isin([int(i) for i in region]))
    return rows.groupBy("time").agg(
        weighted_mean(F.col("cell_timeseries"), F.col("cell_weights")).alias("regional_timeseries")
    )


def diurnal_pattern(percell: DataFrame) -> DataFrame:
    """Per cell and hour of day: means over time."""
    return percell.groupBy("cell", F.hour("time").alias("hour")).agg(
        F.avg("cell_timeseries").alias("cell_timeseries"),
        F.avg("cell_weights").alias("cell_weights"),
    )


def spatial_pattern(percell: DataFrame) -> DataFrame:
    """Per cell: means over time."""
    return percell.groupBy("cell").agg(
        F.avg("cell_timeseries").alias("cell_timeseries"),
        F.avg("cell_weights").alias("cell_weights"),
    )


def spatial_statistics(df: DataFrame, cells: DataFrame, value: str = "VOD", cell: str = "cell_id") -> DataFrame:
    """mean, std (sample), count and median per grid cell; unknown ids are ignored."""
    rows = _valid(df, value, cell).withColumnRenamed(cell, "cell_id")
    known = cells.select("cell_id")
    basic = rows.groupBy("cell_id").agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("count")
    )
    median = group_median(rows, ["cell_id"], value, "median")
    return (
        known.join(basic, "cell_id", "left")
        .join(median, "cell_id", "left")
        .withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))
    )


def coverage_percent(stats: DataFrame) -> DataFrame:
    """Share of grid cells with at least one observation."""
    hit = F.sum(F.when(F.col("count") > 0, 1).otherwise(0))
    return stats.agg((hit * 100.0 / F.count(F.lit(1))).alias("coverage_percent"))


def half_hour_bin(epoch: str = "time") -> Column:
    return (F.hour(epoch) * 2 + F.when(F.minute(epoch) >= 30, 1).otherwise(0)).cast("int")


def _dynamics(percell: DataFrame, bin_col: Column, name: str) -> DataFrame:
    v, w = F.col("cell_timeseries"), F.col("cell_weights")
    per_time = percell.where(v.isNotNull()).groupBy("time").agg(weighted_mean(v, w).alias("__v"))
    return per_time.groupBy(bin_col.alias(name)).agg(
        F.avg("__v").alias("mean"), F.stddev_pop("__v").alias("std"), F.count("__v").alias("count")
    )


def diurnal_dynamics(percell: DataFrame) -> DataFrame:
    """Weighted mean over cells per time, then mean, population std and count per hour."""
    return _dynamics(percell, F.hour("time"), "hour")


def diurnal_dynamics_30min(percell: DataFrame) -> DataFrame:
    """The same in half hours, labelled HH:MM."""
    out = _dynamics(percell, half_hour_bin(), "half_hour")
    return out.withColumn(
        "label",
        F.format_string(
            "%02d:%02d", F.floor(F.col("half_hour") / 2).cast("int"), F.pmod("half_hour", F.lit(2)) * 30
        ),
    )


def averaged_diurnal(dynamics: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Combine several datasets: hours all of them have; std is sqrt(sum var) / n."""
    n_sets = dynamics.select(F.countDistinct(dataset)).scalar()
    return (
        dynamics.where(F.col("mean").isNotNull())
        .groupBy("hour")
        .agg(
            F.avg("mean").alias("mean"),
            (F.sqrt(F.sum(F.col("std") * F.col("std"))) / F.count(F.lit(1))).alias("std"),
            F.sum("count").alias("count"),
            F.count(F.lit(1)).alias("__n"),
        )
        .where(F.col("__n") == n_sets)
        .drop("__n")
    )


def hourly_values(percell: DataFrame) -> DataFrame:
    """Values by hour of day, long; a list per hour would gather them all in one row."""
    return percell.where(F.col("cell_timeseries").isNotNull()).select(
        F.hour("time").alias("hour"), "cell", F.col("cell_timeseries").alias("value")
    )


def polar_bin(cell_theta: Column, width: float = 5.0) -> Column:
    """Left-closed polar bin; 90 degrees and beyond fall in none.

    The angle used is 90 - cell_theta, the convention of this family of reports.
    """
    polar = F.lit(90.0) - cell_theta
    return F.when((polar >= 0) & (polar < 90), F.floor(polar / F.lit(width)).cast("int"))


def radial_values(percell: DataFrame, width: float = 5.0) -> DataFrame:
    """(bin, bin centre, cell, time-mean VOD), long form."""
    per_cell = percell.groupBy("cell").agg(
        F.avg("cell_timeseries").alias("value"), F.first("cell_theta").alias("cell_theta")
    )
    return (
        per_cell.where(F.col("value").isNotNull())
        .withColumn("polar_bin", polar_bin(F.col("cell_theta"), width))
        .where(F.col("polar_bin").isNotNull())
        .withColumn("bin_centre", (F.col("polar_bin") + F.lit(0.5)) * F.lit(width))
        .select("polar_bin", "bin_centre", "cell", "value")
    )


def radial_distribution(percell: DataFrame, width: float = 5.0) -> DataFrame:
    """Mean, population std and cell count of the time-mean VOD per polar bin."""
    return radial_values(percell, width).groupBy("polar_bin", "bin_centre").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("n_cells")
    )


def averaged_radial_values(percell: DataFrame, width: float = 5.0, dataset: str = "dataset") -> DataFrame:
    """``radial_values`` of several datasets together: the polar bins in which every dataset has a cell.

    One row per dataset and cell, long form. ``percell`` carries the dataset's name.
    """
    per_cell = percell.groupBy(dataset, "cell").agg(F.avg("cell_timeseries").alias("value"), F.first("cell_theta").alias("cell_theta"))
    rows = per_cell.where(F.col("value").isNotNull()).withColumn("polar_bin", polar_bin(F.col("cell_theta"), width))
    rows = rows.where(F.col("polar_bin").isNotNull()).select(
        dataset, "polar_bin", ((F.col("polar_bin") + F.lit(0.5)) * F.lit(width)).alias("bin_centre"), "cell", "value"
    )
    n_sets = percell.select(F.countDistinct(dataset)).scalar()
    # One row per polar bin.
    common = rows.groupBy("polar_bin").agg(F.countDistinct(dataset).alias("__n")).where(F.col("__n") == n_sets)
    return rows.join(F.broadcast(common.select("polar_bin")), "polar_bin", "left_semi")


def averaged_radial(percell: DataFrame, width: float = 5.0, dataset: str = "dataset") -> DataFrame:
    """Mean, population std and number of values per common polar bin over all datasets."""
    return averaged_radial_values(percell, width, dataset).groupBy("polar_bin", "bin_centre").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("n_cells")
    )


TIME_GROUPS = {
    "diurnal": lambda t: F.hour(t),
    "daily": lambda t: F.date_format(t, "yyyy-MM-dd"),
    "weekly": lambda t: F.weekofyear(t),
    "monthly": lambda t: F.month(t),
}


def theta_time_heatmap(percell: DataFrame, group: str = "daily", width: float = 5.0) -> DataFrame:
    """Mean VOD per (polar bin, time group)."""
    return (
        percell.where(F.col("cell_timeseries").isNotNull())
        .withColumn("polar_bin", polar_bin(F.col("cell_theta"), width))
        .where(F.col("polar_bin").isNotNull())
        .groupBy("polar_bin", TIME_GROUPS[group]("time").alias("time_group"))
        .agg(F.avg("cell_timeseries").alias("mean"))
    )


def theta_timestamp_heatmap(percell: DataFrame, width: float = 5.0) -> DataFrame:
    """Mean VOD per (polar bin, timestamp)."""
    return (
        percell.where(F.col("cell_timeseries").isNotNull())
        .withColumn("polar_bin", polar_bin(F.col("cell_theta"), width))
        .where(F.col("polar_bin").isNotNull())
        .groupBy("polar_bin", "time")
        .agg(F.avg("cell_timeseries").alias("mean"))
    )


def averaged_heatmap(heatmaps: DataFrame) -> DataFrame:
    """Mean over datasets of (polar_bin, time_group, mean) rows."""
    return heatmaps.groupBy("polar_bin", "time_group").agg(F.avg("mean").alias("mean"))


def percell_stats(percell: DataFrame) -> DataFrame:
    """Mean, population std and total counts per cell over time."""
    return percell.groupBy("cell").agg(
        F.avg("cell_timeseries").alias("mean"),
        F.stddev_pop("cell_timeseries").alias("std"),
        F.sum("cell_counts").alias("counts"),
    )


def percell_median(percell: DataFrame) -> DataFrame:
    return group_median(percell, ["cell"], "cell_timeseries", "median")


def percell_temporal_stats(percell: DataFrame) -> DataFrame:
    """range, OLS trend per time step (more than 3 points) and coefficient of variation.

    The time step is the rank of the timestamp among all timestamps; ranks are
    made once per distinct time, not per cell.
    """
    from pyspark.sql import Window

    times = percell.select("time").distinct()
    # One row per distinct timestamp: the axis, not the data.
    axis = times.withColumn("idx", (F.row_number().over(Window.orderBy("time")) - 1).cast("double"))
    v = F.col("cell_timeseries")
    return (
        percell.where(v.isNotNull())
        .join(axis, "time")
        .groupBy("cell")
        .agg(
            (F.max(v) - F.min(v)).alias("range"),
            F.when(F.count(v) > 3, F.regr_slope(v, F.col("idx"))).alias("trend"),
            F.try_divide(F.stddev_pop(v), F.avg(v)).alias("cv"),
        )
    )


def percell_coverage(percell: DataFrame) -> DataFrame:
    """Share of all timestamps at which a cell has a value, in percent."""
    total = percell.select(F.countDistinct("time")).scalar()
    return percell.groupBy("cell").agg(
        (F.count("cell_timeseries") * 100.0 / total).alias("coverage_percent")
    )
