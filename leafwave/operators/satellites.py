"""Satellite catalogue: assignments and properties with validity periods.

A period holds on day d when start <= d <= end, an open end counting as
forever. The tables have a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def in_period(day: Column, start: str = "start", end: str = "end") -> Column:
    return (F.col(start) <= day) & (F.col(end).isNull() | (day <= F.col(end)))


def prn_metadata(queries: DataFrame, assignments: DataFrame, prn: str = "prn", day: str = "day") -> DataFrame:
    """Left join of (prn, day) rows with the assignment valid that day (latest start on overlap).

    The day is looked up once per distinct (prn, day).
    """
    asked = queries.select(prn, day).distinct()
    hist = assignments.withColumnRenamed("prn", prn)
    hit = asked.join(hist, prn).where(in_period(F.col(day)))
    others = [c for c in assignments.columns if c != "prn"]
    best = hit.groupBy(prn, day).agg(F.max_by(F.struct(*others), "start").alias("__m"))
    best = best.select(prn, day, "__m.*")
    return queries.join(best, [prn, day], "left")


def active_prns(assignments: DataFrame, constellation: str, day: str) -> DataFrame:
    on = F.lit(day).cast("date")
    rows = assignments.where(F.col("prn").startswith(constellation) & in_period(on))
    return rows.select("prn").distinct()


def snapshot(assignments: DataFrame, day: str | None = None) -> DataFrame:
    """Rows valid on ``day``, or the whole history."""
    return assignments if day is None else assignments.where(in_period(F.lit(day).cast("date")))


def reassignments(assignments: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Changes of the vehicle behind a PRN: old and new svn, old end and new start."""
    w = Window.partitionBy("prn").orderBy("start")
    rows = assignments.withColumns(
        {
            "old_svn": F.lag("svn").over(w),
            "__old_end": F.lag("end").over(w),
            "__old_start": F.lag("start").over(w),
        }
    )
    cond = F.col("__old_start").isNotNull() & (F.col("old_svn") != F.col("svn"))
    if end is not None:
        cond = cond & (F.col("start") <= F.lit(end).cast("date"))
    if start is not None:
        cond = cond & (F.col("__old_end").isNull() | (F.col("__old_end") >= F.lit(start).cast("date")))
    return rows.where(cond).select(
        "prn",
        "old_svn",
        F.col("svn").alias("new_svn"),
        F.coalesce("__old_end", "start").alias("old_end"),
        F.col("start").alias("new_start"),
    )


def enrich(obs: DataFrame, assignments: DataFrame, on_date: str | None = None) -> DataFrame:
    """Observations with svn and block of their satellite at the first epoch's date (or ``on_date``)."""
    from leafwave.functions.sids import sid_part

    if on_date is None:
        day = obs.select(F.min(F.to_date("epoch"))).scalar()
    else:
        day = F.lit(on_date).cast("date")
    rows = obs.withColumn("prn", sid_part("sid", 0)).withColumn("__day", day)
    return prn_metadata(rows, assignments, day="__day").drop("__day", "start", "end")
