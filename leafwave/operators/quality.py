"""Data-quality checks on observation and product tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.functions.timeutil import micros
from leafwave.operators.ordered import with_neighbours
from leafwave.operators.quantiles import group_median


def epoch_gaps(obs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, epoch, prev_epoch, gap_s) between consecutive distinct epochs."""
    keys = list(keys)
    epochs = obs.select(*keys, "epoch").distinct()
    pairs = with_neighbours(epochs, keys, "epoch", ["epoch"], following=False)
    return pairs.where(F.col("prev_epoch").isNotNull()).withColumn(
        "gap_s", (micros("epoch") - micros("prev_epoch")) / F.lit(1e6)
    )


def large_gaps(obs: DataFrame, factor: float = 3.0, first: int = 10) -> DataFrame:
    """The first gaps wider than ``factor`` x the median spacing."""
    gaps = epoch_gaps(obs)
    limit = group_median(gaps.withColumn("__k", F.lit(1)), ["__k"], "gap_s", "m").select("m").scalar()
    wide = gaps.where(F.col("gap_s") > limit * F.lit(factor))
    return wide.orderBy("epoch").limit(first)


def missing_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, missing_ratio) by one pass and an unpivot of its single row."""
    ratios = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return ratios.unpivot([], list(columns), "variable", "missing_ratio")


def sampling_interval(obs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent positive whole-second step between epochs (smallest on ties)."""
    keys = list(keys)
    steps = epoch_gaps(obs, keys).withColumn("interval_s", F.floor("gap_s").cast("bigint"))
    counts = steps.where(F.col("interval_s") > 0).groupBy(*keys, "interval_s").count()
    best = F.max_by("interval_s", F.struct("count", -F.col("interval_s")))
    return counts.groupBy(*keys).agg(best.alias("interval_s"))


def completeness(obs: DataFrame, keys: Sequence[str], interval_s: float, dump_s: float) -> DataFrame:
    """Per key: does epochs x interval equal the dump interval exactly?"""
    return obs.groupBy(*keys).agg(F.countDistinct("epoch").alias("n_epochs")).withColumn(
        "complete", F.abs(F.col("n_epochs") * F.lit(float(interval_s)) - F.lit(float(dump_s))) < 1e-9
    )


def day_completeness(obs: DataFrame, keys: Sequence[str] = ("receiver",), expected: int = 2880, share: float = 0.95) -> DataFrame:
    """Per key and day: epochs present and whether they reach ``share`` of ``expected``."""
    by_day = obs.groupBy(*keys, F.to_date("epoch").alias("day")).agg(F.countDistinct("epoch").alias("n_epochs"))
    return by_day.withColumn("complete", F.col("n_epochs") >= int(expected * share))


def _out_of(c: Column, lo: float, hi: float) -> Column:
    return F.sum(F.when((c < lo) | (c > hi), 1).otherwise(0)).cast("bigint")


def ingest_check(obs: DataFrame, keys: Sequence[str] = ("receiver",)) -> DataFrame:
    """Per key: row count, values outside physical range and the verdict."""
    out = obs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("epoch").alias("n_epochs"),
        _out_of(F.col("SNR"), 0.0, 70.0).alias("bad_snr"),
        _out_of(F.col("theta"), -0.01, math.pi / 2 + 0.01).alias("bad_theta"),
        _out_of(F.col("phi"), -0.01, 2 * math.pi + 0.01).alias("bad_phi"),
    )
    bad = F.col("bad_snr") + F.col("bad_theta") + F.col("bad_phi")
    return out.withColumn(
        "verdict",
        F.when(F.col("n_rows") == 0, "empty").when(bad > 0, "out_of_range").otherwise("ok"),
    )


def ephemeris_check(ephem: DataFrame) -> DataFrame:
    """Share of missing positions: over half is an error, over a tenth a warning."""
    missing = F.avg(
        (F.col("X").isNull() | F.col("Y").isNull() | F.col("Z").isNull()).cast("double")
    ) * 100
    return ephem.agg(F.count(F.lit(1)).alias("n_rows"), missing.alias("missing_percent")).withColumn(
        "verdict",
        F.when(F.col("missing_percent") > 50, "error")
        .when(F.col("missing_percent") > 10, "warning")
        .otherwise("ok"),
    )


def clock_check(clock: DataFrame, min_coverage: float = 80.0) -> DataFrame:
    """Coverage, epoch and satellite counts, and the quality gate.

    A table keyed by (epoch, sv) has its epochs in order when no key repeats.
    """
    per_key = clock.groupBy("epoch", "sv").agg(
        F.count(F.lit(1)).alias("__rows"), F.count("clock_offset").alias("__valid")
    )
    out = per_key.agg(
        F.countDistinct("epoch").alias("n_epochs"),
        F.countDistinct("sv").alias("n_satellites"),
        (F.sum("__valid") * 100.0 / F.sum("__rows")).alias("valid_percent"),
        (F.max("__rows") == 1).alias("epochs_monotonic"),
    )
    return out.withColumn(
        "usable", (F.col("valid_percent") >= min_coverage) & F.col("epochs_monotonic")
    )


def distribution_summary(
    df: DataFrame, var: str, keys: Sequence[str], probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95),
    epsilon: float = 0.01, bins: int = 20,
) -> DataFrame:
    """Approximate quantiles with rank error ``epsilon`` and a histogram; both are mergeable sketches."""
    return df.where(F.col(var).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(var, list(probs), int(1 / epsilon)).alias("quantiles"),
        F.histogram_numeric(var, F.lit(bins)).alias("histogram"),
    )


def code_compliance(headers: DataFrame) -> DataFrame:
    """(path, code, issue) for observation codes outside the known systems, bands and attributes.

    ``headers`` has the file's codes as system letter + code, as the RINEX 3
    header parser gives them.
    """
    from leafwave.functions.signals import bands

    spark = headers.sparkSession
    known = bands(spark).select(
        F.col("system").alias("sys"), F.col("digit").alias("dig"), F.col("codes").alias("attributes")
    )
    rows = headers.select("path", F.explode("codes").alias("code"))
    rows = rows.withColumn("sys", F.substring("code", 1, 1)).withColumn("dig", F.substring("code", 3, 1))
    systems = F.array(*[F.lit(s) for s in "GREICSJ"])
    joined = rows.join(F.broadcast(known), ["sys", "dig"], "left")  # some thirty bands
    issue = (
        F.when(~F.array_contains(systems, F.col("sys")), "unknown system")
        .when(F.length("code") < 4, "too short")
        .when(F.col("attributes").isNull(), "unknown band")
        .when(~F.array_contains("attributes", F.substring("code", 4, 1)), "unknown attribute")
    )
    return joined.withColumn("issue", issue).where(F.col("issue").isNotNull()).select("path", "code", "issue")


def grid_integrity(cells: DataFrame) -> DataFrame:
    """Counts of cells that break a grid's rules: repeated ids, centres out of range, no solid angle."""
    bad = lambda c: F.coalesce(F.sum((~c).cast("bigint")), F.lit(0))
    out = cells.agg(
        F.count(F.lit(1)).alias("ncells"),
        (F.count(F.lit(1)) - F.countDistinct("cell_id")).alias("repeated_ids"),
        bad(F.col("phi").between(0, 2 * math.pi)).alias("bad_phi"),
        bad(F.col("theta").between(0, math.pi)).alias("bad_theta"),
        bad(F.col("solid_angle") > 0).alias("bad_solid_angle"),
    )
    total = F.col("repeated_ids") + F.col("bad_phi") + F.col("bad_theta") + F.col("bad_solid_angle")
    return out.withColumn("ok", (F.col("ncells") > 0) & (total == 0))
