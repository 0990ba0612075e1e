"""Ordered analytics without putting a whole key into one task.

A plain ``lag`` over (sid) sends all rows of a sid to one task. Here rows are
partitioned by (key, time block); one small summary row per block carries the
last and first values, or running extremes, across the block edges. A key
with a third of all rows is thereby spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from leafwave.functions.timeutil import block_of
from leafwave.session import broadcast_checked, cut_lineage

DAY = 86400.0


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which NULL keys match each other; the keys of ``left`` stay."""
    there = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(there[f"__right_{k}"])
    return left.join(there, match, "left").drop(*[f"__right_{k}" for k in keys])


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    block_seconds: float = DAY,
    previous: bool = True,
    following: bool = True,
) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>``: the values in the neighbouring row of the key.

    ``order`` must be unique within a key.
    """
    keys = list(keys)
    packed = F.struct(*[F.col(c) for c in dict.fromkeys([order, *columns])])
    rows = df.withColumn("__block", block_of(order, block_seconds)).withColumn("__row", packed)
    inner = Window.partitionBy(*keys, "__block").orderBy(order)
    edges = rows.groupBy(*keys, "__block").agg(
        F.max_by("__row", order).alias("__last"), F.min_by("__row", order).alias("__first")
    )
    across = Window.partitionBy(*keys).orderBy("__block")
    edges = edges.select(
        *keys,
        "__block",
        F.lag("__last").over(across).alias("__before"),
        F.lead("__first").over(across).alias("__after"),
    )
    if previous:
        rows = rows.withColumn("__p", F.lag("__row").over(inner))
    if following:
        rows = rows.withColumn("__n", F.lead("__row").over(inner))
    rows = _null_safe_join(rows, edges, [*keys, "__block"])
    for c in columns:
        if previous:
            rows = rows.withColumn(f"prev_{c}", F.coalesce("__p", "__before")[c])
        if following:
            rows = rows.withColumn(f"next_{c}", F.coalesce("__n", "__after")[c])
    return rows.drop("__block", "__row", "__p", "__n", "__before", "__after")


def probe(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], at: Column, lo: str, hi: str, bucket_seconds: float = DAY,
    max_broadcast: int = 0,
) -> DataFrame:
    """Attach to each point the span of its keys with ``lo`` <= ``at`` < ``hi``; NULLs where there is none.

    Spans are disjoint per key, their ends in microseconds; NULL keys are a key
    of their own. Both sides meet by (keys, time bucket), so it is one
    equi-join that neither sorts a key nor sends it to one task; a span is
    repeated in each bucket it touches. With ``max_broadcast`` the repeated
    spans are written once, counted, and broadcast if there are no more.
    """
    keys = list(keys)
    width = int(bucket_seconds * 1_000_000)
    bucket = lambda t: F.floor(t / F.lit(width)).cast("bigint")
    names = {k: f"__right_{k}" for k in [*keys, "__probe_bucket"]}
    s = spans.withColumn("__probe_bucket", F.explode(F.sequence(bucket(F.col(lo)), bucket(F.col(hi) - 1)))).withColumnsRenamed(names)
    if max_broadcast:
        s = broadcast_checked(cut_lineage(s), max_broadcast)
    p = points.withColumn("__probe_at", at).withColumn("__probe_bucket", bucket(F.col("__probe_at")))
    match = (p["__probe_bucket"] == s["__right___probe_bucket"]) & (p["__probe_at"] >= s[lo]) & (p["__probe_at"] < s[hi])
    for k in keys:
        match = match & p[k].eqNullSafe(s[names[k]])
    return p.join(s, match, "left").drop("__probe_at", "__probe_bucket", *names.values(), lo, hi)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    out: str,
    block_seconds: float = DAY,
) -> DataFrame:
    """Inclusive running sum of ``value`` along ``order`` within each key."""
    keys = list(keys)
    rows = df.withColumn("__block", block_of(order, block_seconds)).withColumn("__v", value)
    inner = Window.partitionBy(*keys, "__block").orderBy(order)
    across = Window.partitionBy(*keys).orderBy("__block")
    totals = rows.groupBy(*keys, "__block").agg(F.sum("__v").alias("__t"))
    totals = totals.select(
        *keys, "__block", (F.sum("__t").over(across) - F.col("__t")).alias("__before")
    )
    rows = rows.withColumn("__in", F.sum("__v").over(inner))
    rows = _null_safe_join(rows, totals, [*keys, "__block"])
    return rows.withColumn(out, F.col("__before") + F.col("__in")).drop(
        "__block", "__v", "__in", "__before"
    )


def asof_both_sides(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    block_seconds: float = DAY,
) -> DataFrame:
    """Attach to each left row the right rows just before and just after it.

    Adds ``at_before`` (last right row with order <= left's) and ``at_after``
    (first with order >= left's), structs of ``order`` and ``columns``, NULL
    where there is none. ``order`` must be unique per key on the right.
    """
    keys = list(keys)
    own = list(left.columns)
    packed = F.struct(*[F.col(c) for c in dict.fromkeys([order, *columns])])
    r = right.select(
        *keys, F.col(order), F.lit(0).alias("__side"), packed.alias("__r")
    )
    l = left.select(
        *keys, F.col(order), F.lit(1).alias("__side"), F.struct(*own).alias("__l")
    )
    both = l.unionByName(r, allowMissingColumns=True)
    both = both.withColumn("__block", block_of(order, block_seconds))

    edges = both.groupBy(*keys, "__block").agg(
        F.max_by("__r", F.when(F.col("__r").isNotNull(), F.col(order))).alias("__last"),
        F.min_by("__r", F.when(F.col("__r").isNotNull(), F.col(order))).alias("__first"),
    )
    across = Window.partitionBy(*keys).orderBy("__block")
    edges = edges.select(
        *keys,
        "__block",
        F.last("__last", True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("__pb"),
        F.first("__first", True).over(across.rowsBetween(1, Window.unboundedFollowing)).alias("__nb"),
    )
    forward = Window.partitionBy(*keys, "__block").orderBy(F.col(order), F.col("__side"))
    # The reversed pass sorts right rows first at equal epochs too, so that
    # "after" includes the epoch itself.
    backward = Window.partitionBy(*keys, "__block").orderBy(F.col(order).desc(), F.col("__side"))
    to_here = (Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("__p", F.last("__r", True).over(forward.rowsBetween(*to_here)))
    both = both.withColumn("__n", F.last("__r", True).over(backward.rowsBetween(*to_here)))
    both = both.where(F.col("__side") == 1)
    both = _null_safe_join(both, edges, [*keys, "__block"])
    return both.select(
        *[F.col("__l")[c].alias(c) for c in own],
        F.coalesce("__p", "__pb").alias("at_before"),
        F.coalesce("__n", "__nb").alias("at_after"),
    )


def prefix_max_at(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    out: str,
    block_seconds: float = DAY,
) -> DataFrame:
    """For each point, the largest ``end`` among intervals with ``start`` <= point.

    That one number decides every "is there an interval that ..." question,
    so overlap tests never list pairs.
    """
    keys = list(keys)
    own = list(points.columns)
    spread = intervals.groupBy(*keys, start).agg(F.max(end).alias("__end"))
    i = spread.select(*keys, F.col(start).alias("__t"), F.lit(0).alias("__side"), "__end")
    p = points.select(
        *keys, F.col(at).alias("__t"), F.lit(1).alias("__side"), F.struct(*own).alias("__row")
    )
    both = p.unionByName(i, allowMissingColumns=True)
    both = both.withColumn("__block", block_of("__t", block_seconds))
    across = Window.partitionBy(*keys).orderBy("__block")
    tops = both.groupBy(*keys, "__block").agg(F.max("__end").alias("__top"))
    tops = tops.select(
        *keys,
        "__block",
        F.max("__top")
        .over(across.rowsBetween(Window.unboundedPreceding, -1))
        .alias("__earlier"),
    )
    inner = (
        Window.partitionBy(*keys, "__block")
        .orderBy("__t", "__side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    both = both.withColumn("__here", F.max("__end").over(inner)).where(F.col("__side") == 1)
    both = _null_safe_join(both, tops, [*keys, "__block"])
    return both.select(
        *[F.col("__row")[c].alias(c) for c in own],
        F.greatest("__here", "__earlier").alias(out),
    )
