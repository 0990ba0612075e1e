"""Interval logic over file time ranges, by sorted running extremes and disjoint spans instead of pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from leafwave.functions.timeutil import US, block_of, micros
from leafwave.operators.ordered import DAY, prefix_max_at, probe, with_neighbours

#: Day pieces of disjoint spans that are broadcast to the points; of more both sides are shuffled.
MAX_BROADCAST_SPANS = 1_000_000


def overlapping(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str] = (), start: str = "start",
    end: str = "end", block_seconds: float = DAY,
) -> DataFrame:
    """Incoming rows whose closed interval meets any stored one.

    Some stored [s, e] meets [a, b] exactly when the largest e among s <= b is
    at least a.
    """
    marked = prefix_max_at(incoming, stored, keys, end, start, end, "__reach", block_seconds)
    return marked.where(F.col("__reach") >= F.col(start)).drop("__reach")


def merged(
    intervals: DataFrame, keys: Sequence[str] = (), start: str = "start", end: str = "end", block_seconds: float = DAY,
) -> DataFrame:
    """The union of closed intervals as disjoint ones, per key; intervals that touch are one.

    An interval opens a new span when everything that starts before it has
    ended. A span ends where the intervals before the next span's start end.
    """
    keys = list(keys)
    starts = intervals.where(F.col(start) <= F.col(end)).groupBy(*keys, start).agg(F.max(end).alias("__end"))
    starts = starts.withColumn("__block", block_of(start, block_seconds))
    earlier = lambda *by: Window.partitionBy(*keys, *by).rowsBetween(Window.unboundedPreceding, -1)
    tops = starts.groupBy(*keys, "__block").agg(F.max("__end").alias("__top"))
    tops = tops.select(
        *[F.col(k).alias(f"__right_{k}") for k in keys], F.col("__block").alias("__right_block"),
        F.max("__top").over(earlier().orderBy("__block")).alias("__far"),
    )
    near = F.max("__end").over(earlier("__block").orderBy(start))
    match = F.col("__block") == F.col("__right_block")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__right_{k}"))
    reached = starts.withColumn("__near", near).join(tops, match, "left").withColumn("__reach", F.greatest("__near", "__far"))
    opening = reached.where(F.col("__reach").isNull() | (F.col("__reach") < F.col(start))).select(*keys, start, "__reach")
    last = starts.groupBy(*keys).agg(F.max("__end").alias("__last"))
    spans = with_neighbours(opening, keys, start, ["__reach"], block_seconds, previous=False)
    match = F.lit(True)
    for k in keys:
        match = match & spans[k].eqNullSafe(last[k])
    return spans.join(last, match).select(*[spans[k] for k in keys], start, F.coalesce("next___reach", "__last").alias(end))


def inside_any(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str] = (), at: str = "epoch",
    start: str = "start", end: str = "end", invert: bool = False, block_seconds: float = DAY,
) -> DataFrame:
    """Points inside at least one closed interval, or with ``invert`` inside none.

    The intervals become disjoint spans, written once. While these are few, they
    go to the points, which are neither sorted nor shuffled.
    """
    spans = merged(intervals, keys, start, end, block_seconds)
    spans = spans.select(*keys, micros(start).alias("__lo"), (micros(end) + 1).alias("__hi"), F.lit(True).alias("__hit"))
    marked = probe(points, spans, keys, micros(at), "__lo", "__hi", block_seconds, MAX_BROADCAST_SPANS)
    hit = F.col("__hit").isNotNull()
    return marked.where(~hit if invert else hit).select(*points.columns)


def containers(
    intervals: DataFrame, keys: Sequence[str] = (), start: str = "start", end: str = "end",
    block_seconds: float = DAY,
) -> DataFrame:
    """Rows whose interval contains another row's; identical intervals contain each other.

    Ordered by start, [s, e] contains a later-starting one when the least end
    after it is at most e; among equal starts the least end decides.
    """
    keys = list(keys)
    distinct = intervals.groupBy(*keys, start, end).agg(F.count(F.lit(1)).alias("__n"))
    per_start = distinct.groupBy(*keys, start).agg(F.min(end).alias("__least"))
    per_start = per_start.withColumn("__block", block_of(start, block_seconds))
    across = Window.partitionBy(*keys).orderBy("__block").rowsBetween(1, Window.unboundedFollowing)
    later_blocks = per_start.groupBy(*keys, "__block").agg(F.min("__least").alias("__m"))
    later_blocks = later_blocks.select(*keys, "__block", F.min("__m").over(across).alias("__far"))
    within = Window.partitionBy(*keys, "__block").orderBy(start).rowsBetween(1, Window.unboundedFollowing)
    per_start = per_start.withColumn("__near", F.min("__least").over(within))
    per_start = per_start.join(later_blocks, [*keys, "__block"]).select(
        *keys, start, "__least", F.least("__near", "__far").alias("__later")
    )
    verdict = distinct.join(per_start, [*keys, start])
    hit = (
        (F.col("__n") > 1)
        | (F.col("__least") < F.col(end))
        | F.coalesce(F.col("__later") <= F.col(end), F.lit(False))
    )
    bad = verdict.where(hit).select(*keys, start, end)
    return intervals.join(bad, [*keys, start, end], "left_semi")


def overlap_pairs(
    files: DataFrame, id_col: str, keys: Sequence[str] = (), start: str = "start", end: str = "end",
    bucket_seconds: float = 3600.0,
) -> DataFrame:
    """All pairs (id_a < id_b) of half-open intervals that overlap: the pairs are the report.

    Intervals meet in the time bucket that holds the later of their starts, so
    only neighbours in time are compared and each pair appears once.
    """
    keys = list(keys)
    width = int(bucket_seconds * US)
    first = F.floor(micros(start) / F.lit(width)).cast("bigint")
    # The end is exclusive; an empty interval still lies in its start's bucket.
    last = F.greatest(first, F.floor((micros(end) - 1) / F.lit(width)).cast("bigint"))
    side = files.select(
        *keys, F.col(id_col).alias("id"), F.col(start).alias("s"), F.col(end).alias("e"), first.alias("b0"), last.alias("b1"),
    )
    spread = side.withColumn("bucket", F.explode(F.sequence("b0", "b1")))
    starts = side.withColumn("bucket", F.col("b0"))
    a = spread.select(*keys, "bucket", *[F.col(c).alias(f"x_{c}") for c in ("id", "s", "e", "b0")])
    b = starts.select(*keys, "bucket", *[F.col(c).alias(f"y_{c}") for c in ("id", "s", "e", "b0")])
    met = a.join(b, [*keys, "bucket"]).where(
        (F.col("x_s") < F.col("y_e"))
        & (F.col("y_s") < F.col("x_e"))
        # y starts later, or with x and has the larger id: each pair once.
        & ((F.col("y_s") > F.col("x_s")) | ((F.col("y_s") == F.col("x_s")) & (F.col("y_id") > F.col("x_id"))))
    )
    return met.select(
        *keys, F.least("x_id", "y_id").alias("id_a"), F.greatest("x_id", "y_id").alias("id_b")
    )
