"""Matching observations with auxiliary data at other epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from leafwave.functions.timeutil import US, from_micros, micros
from leafwave.operators.ordered import DAY, asof_both_sides


def nearest_asof(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("sid",), columns: Sequence[str] = (),
    order: str = "epoch", how: str = "inner", block_seconds: float = DAY,
) -> DataFrame:
    """Join each left row with the right row nearest in time, at any distance.

    Equal distances take the later right row. Adds ``columns`` and
    ``<order>_matched``; ``inner`` drops left rows whose key the right lacks.
    """
    keys = list(keys)
    both = asof_both_sides(left, right, keys, order, list(columns), block_seconds)
    here = micros(order)
    before = here - micros(F.col("at_before")[order])
    after = micros(F.col("at_after")[order]) - here
    pick = F.when(
        F.col("at_before").isNull() | (after <= before), F.col("at_after")
    ).otherwise(F.col("at_before"))
    pick = F.coalesce(pick, F.col("at_after"), F.col("at_before"))
    out = both.withColumn("__m", pick)
    if how == "inner":
        out = out.where(F.col("__m").isNotNull())
    return out.select(
        *left.columns,
        F.col("__m")[order].alias(f"{order}_matched"),
        *[F.col("__m")[c].alias(c) for c in columns],
    )


def nearest_on_regular_grid(
    left: DataFrame, right: DataFrame, step_seconds: float, keys: Sequence[str] = ("sid",),
    how: str = "inner",
) -> DataFrame:
    """The same for a right side sampled every ``step_seconds``: one equi-join on the rounded slot."""
    step = int(step_seconds * US)

    def slot(df: DataFrame) -> DataFrame:
        return df.withColumn("__slot", F.floor((micros("epoch") + F.lit(step // 2)) / F.lit(step)))

    r = slot(right).withColumnRenamed("epoch", "epoch_matched")
    return slot(left).join(r, [*keys, "__slot"], how).drop("__slot")


def within_buffer(aux: DataFrame, start, end, buffer_minutes: float = 5.0) -> DataFrame:
    """Auxiliary rows inside [start - buffer, end + buffer]."""
    pad = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(buffer_minutes)))
    return aux.where(
        (F.col("epoch") >= F.lit(start).cast("timestamp_ntz") - pad)
        & (F.col("epoch") <= F.lit(end).cast("timestamp_ntz") + pad)
    )


def join_broadcast_geometry(obs: DataFrame, geometry: DataFrame) -> DataFrame:
    """Receiver-reported angles by exact (epoch, sid); missing ones are NULL."""
    return obs.join(geometry, ["epoch", "sid"], "left")


def unmatched_sids(obs: DataFrame, aux: DataFrame) -> DataFrame:
    """Sids observed but absent from the auxiliary data."""
    return obs.select("sid").distinct().join(aux.select("sid").distinct(), "sid", "left_anti")


def merge_products(ephem: DataFrame, clock: DataFrame) -> DataFrame:
    """Full outer join on (epoch, sv); epochs where everything is missing are dropped."""
    merged = ephem.join(clock, ["epoch", "sv"], "full_outer")
    values = [c for c in merged.columns if c not in ("epoch", "sv")]
    present = F.max(F.greatest(*[F.col(c).isNotNull().cast("int") for c in values], F.lit(0)))
    live = merged.groupBy("epoch").agg(present.alias("__any")).where(F.col("__any") == 1)
    return merged.join(live.select("epoch"), "epoch", "left_semi")


def regular_epochs(keys: DataFrame, start, end, step_seconds: float) -> DataFrame:
    """Every key at every step of [start, end]."""
    lo, hi = micros(F.lit(start).cast("timestamp_ntz")), micros(F.lit(end).cast("timestamp_ntz"))
    steps = F.sequence(lo, hi, F.lit(int(step_seconds * US)))
    return keys.withColumn("epoch", from_micros(F.explode(steps)))
