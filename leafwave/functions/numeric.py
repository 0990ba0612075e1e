"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clip(c: Column, lo: float | int, hi: float | int) -> Column:
    """``c`` held within [lo, hi]; NULL stays NULL, which least and greatest would skip."""
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)
