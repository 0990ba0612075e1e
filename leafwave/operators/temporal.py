"""Binning observations in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leafwave.functions.timeutil import floor_epoch, freq_seconds, micros
from leafwave.operators.ordered import with_neighbours
from leafwave.operators.quantiles import group_median, group_medians


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def poisoned_mean(c: Column) -> Column:
    """Mean that is NULL as soon as one value is missing."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def temporal_aggregate(
    obs: DataFrame, freq: str = "1min", method: str = "mean", keys: Sequence[str] = ("sid",),
    columns: Sequence[str] | None = None, nan_policy: str = "skip",
) -> DataFrame:
    """Mean or median of every variable per (time bin, keys); ``epoch`` becomes the bin start.

    Angles are averaged as plain numbers. ``nan_policy='propagate'`` makes a
    bin with a missing value missing.
    """
    if method not in ("mean", "median"):
        raise ValueError(f"unsupported aggregation method {method!r}")
    keys = list(keys)
    columns = list(columns) if columns is not None else numeric_columns(obs, keys)
    binned = obs.withColumn("epoch", floor_epoch("epoch", freq))
    group = ["epoch", *keys]
    if method == "mean":
        mean = poisoned_mean if nan_policy == "propagate" else F.avg
        return binned.groupBy(*group).agg(*[mean(F.col(c).cast("double")).alias(c) for c in columns])
    return group_medians(binned, group, columns)


def median_epoch_spacing(obs: DataFrame) -> float | None:
    """Median gap between distinct epochs, in seconds; one number reaches the driver."""
    epochs = obs.select("epoch").distinct()
    gaps = with_neighbours(epochs, [], "epoch", ["epoch"], following=False).where(
        F.col("prev_epoch").isNotNull()
    )
    gaps = gaps.select(F.lit(1).alias("k"), ((micros("epoch") - micros("prev_epoch")) / 1e6).alias("gap"))
    row = group_median(gaps, ["k"], "gap", "m").first()
    return None if row is None else row["m"]


def aggregate_unless_coarse(obs: DataFrame, freq: str, method: str = "mean", **kw) -> DataFrame:
    """``temporal_aggregate``, or ``obs`` unchanged when its spacing is already ``freq`` or wider."""
    spacing = median_epoch_spacing(obs)
    if spacing is not None and spacing >= freq_seconds(freq):
        return obs
    return temporal_aggregate(obs, freq, method, **kw)


def resample(vod: DataFrame, freq: str = "1D", columns: Sequence[str] = ("VOD", "phi", "theta")) -> DataFrame:
    """Mean per (bin, sid), missing values skipped, bins without VOD dropped."""
    present = [c for c in columns if c in vod.columns]
    out = temporal_aggregate(vod, freq, "mean", columns=present)
    return out.where(F.col("VOD").isNotNull()) if "VOD" in present else out
