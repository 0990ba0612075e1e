"""Canopy / reference pairing and VOD retrieval."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from leafwave.functions.vod import optical_depth
from leafwave.session import broadcast_checked

KEYS = ["epoch", "sid"]


def pair_receivers(canopy: DataFrame, reference: DataFrame, align: bool = True) -> DataFrame:
    """Join the two sides on (epoch, sid).

    ``align=True`` keeps matched rows; ``False`` keeps every canopy row, with
    a NULL reference where none matches.
    """
    ref_cols = [F.col("SNR").alias("SNR_reference")]
    if "r" in reference.columns:
        ref_cols.append(F.col("r").alias("r_reference"))
    return canopy.join(reference.select(*KEYS, *ref_cols), KEYS, "inner" if align else "left")


def tau_omega(
    canopy: DataFrame, reference: DataFrame, align: bool = True, radial_diff: bool = False,
    keep_delta_snr: bool = True,
) -> DataFrame:
    """VOD per (epoch, sid) with the canopy side's angles."""
    pairs = pair_receivers(canopy, reference, align)
    delta = F.col("SNR") - F.col("SNR_reference")
    cols = [*KEYS]
    cols += [c for c in ("phi", "theta") if c in canopy.columns]
    out = pairs.withColumn("delta_snr", delta)
    out = out.withColumn("VOD", optical_depth(F.col("delta_snr"), F.col("theta")))
    cols.append("VOD")
    if keep_delta_snr:
        cols.append("delta_snr")
    if radial_diff:
        out = out.withColumn("radial_diff", F.col("r") - F.col("r_reference"))
        cols.append("radial_diff")
    cols += [c for c in canopy.columns if c.startswith("cell_id")]
    return out.select(*cols)


CALCULATORS: dict[str, Callable[..., DataFrame]] = {"tau_omega_zeroth": tau_omega}


def register_calculator(name: str, retrieve: Callable[..., DataFrame]) -> None:
    """Add a retrieval taking (canopy, reference, ...) and returning VOD rows."""
    if not callable(retrieve):
        raise TypeError("a calculator is a callable (canopy, reference, **options) -> DataFrame")
    CALCULATORS[name] = retrieve


def calculate_vod(
    canopy: DataFrame, reference: DataFrame, calculator: str = "tau_omega_zeroth", **options
) -> DataFrame:
    for side, df in (("canopy", canopy), ("reference", reference)):
        missing = [c for c in [*KEYS, "SNR"] if c not in df.columns]
        if missing:
            raise ValueError(f"{side} side lacks {missing}")
    return CALCULATORS[calculator](canopy, reference, **options)


def explode_pairs(reference_config: DataFrame) -> DataFrame:
    """One row per (reference, canopy) from (receiver, scs_from array); name ``ref_canopy``."""
    return reference_config.select(
        F.col("receiver").alias("reference"), F.explode("scs_from").alias("canopy")
    ).withColumn("store_group", F.concat_ws("_", "reference", "canopy"))


def replicate_reference(reference_obs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Reference observations once per canopy they serve.

    Pairs are configuration; while they are few they are broadcast, so the
    observations of a busy receiver stay where they are.
    """
    few = broadcast_checked(pairs.withColumnRenamed("reference", "receiver"), 10_000)
    return reference_obs.join(few, "receiver")
