"""Bringing auxiliary tables to the epochs of a reference table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from leafwave.functions.timeutil import micros
from leafwave.operators.asof import nearest_asof
from leafwave.operators.temporal import median_epoch_spacing

Interpolator = Callable[[DataFrame, DataFrame], DataFrame]


def interval_seconds(df: DataFrame) -> float:
    """Median seconds between distinct epochs, so that one gap or odd start decides nothing."""
    spacing = median_epoch_spacing(df)
    if spacing is None:
        raise ValueError("need at least two epochs")
    return spacing


def match(
    reference: DataFrame, aux: DataFrame, key: str = "sid", columns: Sequence[str] = (), name: str = "aux",
    interpolate: Interpolator | None = None,
) -> DataFrame:
    """Auxiliary values at the reference's (epoch, key).

    A finer auxiliary table is sampled at the nearest epoch, a coarser one
    interpolated, or sampled as well when no interpolator is given; then
    ``<name>_temporal_distance`` says how far the sample lies, in seconds.
    """
    wanted = reference.select("epoch", key).distinct()
    coarse = interval_seconds(aux) >= interval_seconds(reference)
    if coarse and interpolate is not None:
        return interpolate(aux, wanted)
    out = nearest_asof(wanted, aux, [key], columns)
    if coarse:
        apart = F.abs(micros("epoch") - micros("epoch_matched")) / F.lit(1e6)
        out = out.withColumn(f"{name}_temporal_distance", apart)
    return out.drop("epoch_matched")


def coverage(reference: DataFrame, aux: DataFrame) -> DataFrame:
    """Does the auxiliary time span cover the reference's?"""
    r = reference.agg(F.min("epoch").alias("ref_start"), F.max("epoch").alias("ref_end"))
    span = aux.select(F.struct(F.min("epoch").alias("a"), F.max("epoch").alias("b"))).scalar()
    out = r.withColumns({"aux_start": span["a"], "aux_end": span["b"]})
    return out.withColumn(
        "covered", (F.col("aux_start") <= F.col("ref_start")) & (F.col("aux_end") >= F.col("ref_end"))
    )
