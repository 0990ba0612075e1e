"""Ephemeris and clock interpolation as bracket joins and closed-form polynomials.

Nodes and the spans between them are written once; targets find their span by
an equi-join on (satellite, time bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.functions.timeutil import US, from_micros, micros
from leafwave.operators.ordered import DAY, asof_both_sides, probe, running_sum, with_neighbours
from leafwave.session import broadcast_checked, cut_lineage

POSITIONS = ("X", "Y", "Z")
VELOCITIES = ("Vx", "Vy", "Vz")
JUMP_THRESHOLD = 1e-6
#: Satellites whose first and last node are broadcast; of more they are shuffled.
MAX_KEYS = 100_000


def _whole_seconds(c: Column | str) -> Column:
    us = micros(c)
    return (us - F.pmod(us, F.lit(US))) / F.lit(float(US))


def node_spacing(nodes: DataFrame, block_seconds: float = DAY) -> float | None:
    """Median distance of consecutive epochs over all satellites, in whole seconds; one number reaches the driver."""
    epochs = with_neighbours(
        nodes.select("epoch").distinct(), [], "epoch", ["epoch"], block_seconds, following=False
    )
    gaps = epochs.where(F.col("prev_epoch").isNotNull()).select(
        ((micros("epoch") - micros("prev_epoch")) / F.lit(1e6)).alias("gap")
    )
    # Few different gaps are left to rank.
    counts = gaps.groupBy("gap").count()
    spacing = counts.agg(F.floor(F.percentile("gap", F.lit(0.5), F.col("count"))).cast("double")).first()[0]
    return spacing


def central_velocity(ephem: DataFrame, key: str = "sv", block_seconds: float = DAY) -> DataFrame:
    """Velocities by central differences over the median spacing, one-sided at the ends; written once."""
    ephem = cut_lineage(ephem)
    dt = F.lit(node_spacing(ephem, block_seconds)).cast("double")
    out = with_neighbours(ephem, [key], "epoch", ["epoch", *POSITIONS], block_seconds)
    for p, v in zip(POSITIONS, VELOCITIES):
        inner = (F.col(f"next_{p}") - F.col(f"prev_{p}")) / (F.lit(2.0) * dt)
        first = (F.col(f"next_{p}") - F.col(p)) / dt
        last = (F.col(p) - F.col(f"prev_{p}")) / dt
        value = F.when(F.col("prev_epoch").isNull(), first).when(F.col("next_epoch").isNull(), last)
        out = out.withColumn(v, value.otherwise(inner))
    return cut_lineage(out.select(*ephem.columns, *VELOCITIES))


def _hermite(u: Column, h: Column, p0: Column, p1: Column, v0: Column, v1: Column) -> tuple[Column, Column]:
    """Value and time derivative of the cubic Hermite segment at fraction ``u``."""
    u2, u3 = u * u, u * u * u
    value = (
        (2 * u3 - 3 * u2 + 1) * p0 + (u3 - 2 * u2 + u) * h * v0 + (3 * u2 - 2 * u3) * p1 + (u3 - u2) * h * v1
    )
    slope = (
        (6 * u2 - 6 * u) / h * p0 + (3 * u2 - 4 * u + 1) * v0 + (6 * u - 6 * u2) / h * p1 + (3 * u2 - 2 * u) * v1
    )
    return value, slope


def hermite_interpolate(
    ephem: DataFrame, targets: DataFrame, key: str = "sv", block_seconds: float = DAY
) -> DataFrame:
    """Positions and velocities at the target epochs.

    Times count in whole seconds. Outside the data the first or last segment
    is extended. A satellite without positions or velocities yields NULL.
    """
    cols = [*POSITIONS, *VELOCITIES]
    nodes = with_neighbours(ephem, [key], "epoch", ["epoch", *cols], block_seconds, previous=False)
    spans = cut_lineage(
        nodes.where(F.col("next_epoch").isNotNull()).select(
            key, micros("epoch").alias("__lo"), micros("next_epoch").alias("__hi"),
            F.struct("epoch", "next_epoch", *cols, *[f"next_{c}" for c in cols]).alias("__s"),
        )
    )
    ends = spans.groupBy(key).agg(F.min("__lo").alias("__first"), (F.max("__hi") - 1).alias("__last"))
    within = targets.join(broadcast_checked(ends, MAX_KEYS), key, "left")
    at = F.greatest(F.least(micros("epoch"), F.col("__last")), F.col("__first"))
    placed = probe(within, spans, [key], at, "__lo", "__hi", block_seconds)
    s = F.col("__s")
    t0, t1 = _whole_seconds(s["epoch"]), _whole_seconds(s["next_epoch"])
    placed = placed.withColumn("__h", t1 - t0).withColumn(
        "__u", (_whole_seconds("epoch") - t0) / F.col("__h")
    )
    out = []
    for p, v in zip(POSITIONS, VELOCITIES):
        value, slope = _hermite(
            F.col("__u"), F.col("__h"), s[p], s[f"next_{p}"], s[v], s[f"next_{v}"]
        )
        out += [value.alias(p), slope.alias(v)]
    return placed.select(*targets.columns, *out)


def linear_interpolate(
    ephem: DataFrame, targets: DataFrame, columns: Sequence[str] = POSITIONS, key: str = "sv",
    block_seconds: float = DAY,
) -> DataFrame:
    """Linear interpolation; NULL outside the data."""
    both = asof_both_sides(targets, ephem, [key], "epoch", list(columns), block_seconds)
    b, a = F.col("at_before"), F.col("at_after")
    span = micros(a["epoch"]) - micros(b["epoch"])
    u = F.when(span == 0, F.lit(0.0)).otherwise((micros("epoch") - micros(b["epoch"])) / span)
    inside = b.isNotNull() & a.isNotNull()
    return both.select(
        *targets.columns,
        *[F.when(inside, b[c] + (a[c] - b[c]) * u).alias(c) for c in columns],
    )


def clock_segments(
    clock: DataFrame, value: str = "clock_offset", key: str = "sv", threshold: float = JUMP_THRESHOLD,
    block_seconds: float = DAY,
) -> DataFrame:
    """Valid clock rows with ``segment``: how many jumps above ``threshold`` came before."""
    rows = clock.where(F.col(value).isNotNull())
    rows = with_neighbours(rows, [key], "epoch", [value], block_seconds, following=False)
    jump = F.coalesce(
        (F.abs(F.col(value) - F.col(f"prev_{value}")) > F.lit(threshold)).cast("bigint"), F.lit(0)
    )
    out = running_sum(rows, [key], "epoch", jump, "segment", block_seconds)
    return out.drop(f"prev_{value}")


def clock_interpolate(
    clock: DataFrame, targets: DataFrame, value: str = "clock_offset", key: str = "sv",
    threshold: float = JUMP_THRESHOLD, block_seconds: float = DAY,
) -> DataFrame:
    """Linear within a segment; NULL across jumps, outside the data and in one-point segments."""
    rows = with_neighbours(clock.where(F.col(value).isNotNull()), [key], "epoch", ["epoch", value], block_seconds)
    joined = lambda side: F.coalesce(F.abs(F.col(value) - F.col(f"{side}_{value}")) <= F.lit(threshold), F.lit(False))
    here = micros("epoch")
    # A node that a jump follows ends its segment: it holds for its own epoch, if a node before belongs to it.
    spans = rows.where(joined("prev") | joined("next")).select(
        key, here.alias("__lo"), F.when(joined("next"), micros("next_epoch")).otherwise(here + 1).alias("__hi"),
        F.col(value).alias("__from"), F.when(joined("next"), F.col(f"next_{value}")).otherwise(F.col(value)).alias("__to"),
        here.alias("__start"), F.when(joined("next"), micros("next_epoch") - here).otherwise(0).alias("__span"),
    )
    asked = (_whole_seconds("epoch") * US).cast("bigint")
    both = probe(targets, spans, [key], asked, "__lo", "__hi", block_seconds)
    u = F.when(F.col("__span") == 0, F.lit(0.0)).otherwise((asked - F.col("__start")) / F.col("__span"))
    estimate = F.col("__from") + (F.col("__to") - F.col("__from")) * u
    return both.select(*[F.col(c) for c in targets.columns], estimate.alias(value))
