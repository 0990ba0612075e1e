"""Robust outlier detection per (cell, sid)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from leafwave.functions.timeutil import US, floor_epoch, micros
from leafwave.operators.quantiles import group_median, median_and_mad
from leafwave.operators.sliding import sliding_stats

CELL_SID = ("cell_id", "sid")
# MAD to standard deviation, the rounded and the full constant.
MAD_SCALE = 1.4826
MAD_SCALE_FULL = 1.482602218505602


def _flag(df: DataFrame, var: str, keys: Sequence[str], bad, processed) -> DataFrame:
    out = df.withColumn("hampel_outlier_mask", F.coalesce(bad, F.lit(False)))
    out = out.withColumn("hampel_processing_mask", F.coalesce(processed, F.lit(False)))
    return out.withColumn(
        f"{var}_filtered", F.when(~F.col("hampel_outlier_mask"), F.col(var))
    )


def _valid(df: DataFrame, var: str, keys: Sequence[str]) -> DataFrame:
    cond = F.col(var).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def hampel(
    df: DataFrame, threshold: float = 3.0, min_obs: int = 20, var: str = "VOD",
    keys: Sequence[str] = CELL_SID,
) -> DataFrame:
    """Outlier when |x - median| > threshold x MAD over the whole (cell, sid) series.

    The MAD is unscaled; series below ``min_obs`` are not processed.
    """
    keys = list(keys)
    stats = median_and_mad(_valid(df, var, keys), keys, var)
    out = df.join(stats, keys, "left")
    processed = (F.col("n_obs") >= min_obs) & F.col(var).isNotNull()
    bad = (
        processed
        & (F.col("mad") > 0)
        & (F.abs(F.col(var) - F.col("median")) > F.col("mad") * F.lit(float(threshold)))
    )
    return _flag(out, var, keys, bad, processed).drop("median", "mad", "n_obs")


def hampel_preaggregated(
    df: DataFrame, freq: str = "1h", method: str = "mean", var: str = "VOD",
    keys: Sequence[str] = CELL_SID, **kw,
) -> DataFrame:
    """Average each (cell, sid) to time bins first, then ``hampel``."""
    keys = list(keys)
    binned = _valid(df, var, keys).withColumn("epoch", floor_epoch("epoch", freq))
    group = ["epoch", *keys]
    if method == "mean":
        agg = binned.groupBy(*group).agg(F.avg(var).alias(var))
    elif method == "median":
        agg = group_median(binned, group, var, var)
    else:
        raise ValueError(f"unknown aggregation {method!r}")
    return hampel(agg, var=var, keys=keys, **kw)


def sigma_clip(
    df: DataFrame, sigma: float = 3.0, min_points: int = 5, var: str = "VOD",
    keys: Sequence[str] = CELL_SID,
) -> DataFrame:
    """One clipping pass at ``sigma`` robust standard deviations around the median.

    Unlike Hampel, a zero MAD clips every value off the median. Clipped values
    are NULL in the filtered column and marked in the mask.
    """
    keys = list(keys)
    stats = median_and_mad(_valid(df, var, keys), keys, var)
    out = df.join(stats, keys, "left")
    processed = (F.col("n_obs") >= min_points) & F.col(var).isNotNull()
    limit = F.col("mad") * F.lit(MAD_SCALE_FULL * sigma)
    bad = processed & (F.abs(F.col(var) - F.col("median")) > limit)
    return _flag(out, var, keys, bad, processed).drop("median", "mad", "n_obs")


def sliding_hampel(
    df: DataFrame, window_hours: float = 1.0, sigma: float = 3.0, min_points: int = 5,
    var: str = "VOD", keys: Sequence[str] = CELL_SID, block_hours: float | None = None,
    keep_window_stats: bool = False,
) -> DataFrame:
    """Outlier when |x - median| > sigma x 1.4826 x MAD within +-window_hours, both ends included.

    Rows are laid out in (keys, time block); each block also receives copies of
    the rows within one window of its edges, so a busy key is worked on by as
    many tasks as it has blocks and no window loses neighbours. NaN counts as
    missing.
    """
    keys = list(keys)
    half = int(window_hours * 3600 * US)
    block = int((block_hours or max(24.0, 4 * window_hours)) * 3600 * US)
    there = F.col(var).isNotNull() & ~F.isnan(F.col(var).cast("double")) & _all_present(keys)
    work = sliding_stats(df.where(there), keys, micros("epoch"), var, half, block)
    median, mad, n = (F.col(f"window_{c}") for c in ("median", "mad", "n"))
    # A window that is full enough says the same of its series.
    processed = n >= min_points
    bad = processed & (mad > 0) & (F.abs(F.col(var) - median) > mad * F.lit(MAD_SCALE * sigma))
    out = _flag(work, var, keys, bad, processed)
    if not keep_window_stats:
        out = out.drop("window_median", "window_mad", "window_n")
    rest = _flag(df.where(~there), var, keys, F.lit(False), F.lit(False))
    return out.unionByName(rest, allowMissingColumns=True)


def _all_present(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
