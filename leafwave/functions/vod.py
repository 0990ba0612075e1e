"""Tau-omega zeroth-order retrieval expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def transmissivity(delta_snr: Column) -> Column:
    """dB to linear."""
    return F.pow(F.lit(10.0), delta_snr / F.lit(10.0))


def optical_depth(delta_snr: Column, theta: Column) -> Column:
    """-ln(T) cos(theta); theta is the canopy side's polar angle in radians."""
    return -F.ln(transmissivity(delta_snr)) * F.cos(theta)
