"""Comparison of two datasets, variable by variable."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.functions.geometry import wrap_azimuth_difference
from leafwave.functions.sids import sid_part
from leafwave.operators.quantiles import group_quantiles

KEYS = ("epoch", "sid")


@dataclass(frozen=True)
class Tolerance:
    atol: float
    mae_atol: float
    nan_rate_atol: float = 0.0


# Defaults per tier and, for the scientific tier, per variable.
TIERS = {
    "exact": Tolerance(0.0, 0.0),
    "numerical": Tolerance(1e-6, 1e-10),
    "scientific": Tolerance(0.01, 0.01),
}
SCIENTIFIC = {
    "SNR": Tolerance(0.25, 0.0, 0.01),
    "vod": Tolerance(0.01, 0.01, 0.01),
    "phi": Tolerance(0.05, 0.0, 0.0),
    "theta": Tolerance(0.05, 0.0, 0.0),
    "carrier_phase": Tolerance(1e-6, 1e-9, 0.01),
    "pseudorange": Tolerance(1e-3, 1e-6, 0.01),
    "sat_x": Tolerance(1e-3, 1e-9, 0.05),
    "sat_y": Tolerance(1e-3, 1e-9, 0.05),
    "sat_z": Tolerance(1e-3, 1e-9, 0.05),
}
# Fixed value: VOD error explained by float32 storage of two SNR values.
FLOAT32_VOD_RESIDUAL = math.log(10) / 10 * 4e-6


def tolerance_for(variable: str, tier: str, overrides: Mapping[str, Tolerance] | None = None) -> Tolerance:
    if overrides and variable in overrides:
        return overrides[variable]
    if tier == "scientific" and variable in SCIENTIFIC:
        return SCIENTIFIC[variable]
    return TIERS[tier]


def align(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Both sides cut to the epochs and the sids they share, each axis on its own."""
    for k in keys:
        shared = a.select(k).intersect(b.select(k))
        a, b = a.join(shared, k, "left_semi"), b.join(shared, k, "left_semi")
    return a, b


def alignment_report(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per axis: shared values, values only in one side, share dropped, and the 5 % warning."""
    out = None
    for k in keys:
        sides = a.select(k).distinct().withColumn("__a", F.lit(1)).join(
            b.select(k).distinct().withColumn("__b", F.lit(1)), k, "full_outer"
        )
        count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
        has_a, has_b = F.col("__a").isNotNull(), F.col("__b").isNotNull()
        one = sides.agg(
            F.lit(k).alias("axis"),
            count(has_a & has_b).alias("shared"),
            count(has_a & ~has_b).alias("dropped_a"),
            count(~has_a & has_b).alias("dropped_b"),
        )
        out = one if out is None else out.unionByName(one)
    lost = F.col("dropped_a") + F.col("dropped_b")
    out = out.withColumn("dropped_share", F.try_divide(lost, lost + F.col("shared")))
    return out.withColumn("warn", F.col("dropped_share") > 0.05)


def paired(a: DataFrame, b: DataFrame, variables: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Full outer join in long form: (variable, a, b), one row per key and variable."""
    left = a.select(*keys, *[F.col(v).cast("double").alias(f"a_{v}") for v in variables])
    right = b.select(*keys, *[F.col(v).cast("double").alias(f"b_{v}") for v in variables])
    both = left.join(right, list(keys), "full_outer")
    per_var = F.array(
        *[
            F.struct(F.lit(v).alias("variable"), F.col(f"a_{v}").alias("a"), F.col(f"b_{v}").alias("b"))
            for v in variables
        ]
    )
    return both.select(F.explode(per_var).alias("v")).select("v.*")


def variable_stats(
    a: DataFrame, b: DataFrame, variables: Sequence[str], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Counts by validity class, difference statistics and percentiles per variable."""
    rows = paired(a, b, variables, keys)
    d = F.col("a") - F.col("b")
    has_a, has_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    n = lambda c: F.sum(c.cast("bigint"))
    stats = rows.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_total"),
        n(has_a & has_b).alias("n_compared"),
        n(has_a & ~has_b).alias("n_a_only"),
        n(~has_a & has_b).alias("n_b_only"),
        n(~has_a & ~has_b).alias("n_neither"),
        F.coalesce(n(F.abs(d) > 0), F.lit(0)).alias("n_nonzero_diff"),
        F.max(F.abs(d)).alias("max_abs_diff"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(F.abs(d)).alias("mae"),
        F.avg(d).alias("bias"),
        F.when(n(has_a & has_b) >= 2, F.corr("a", "b")).alias("correlation"),
        F.avg((has_a == has_b).cast("double")).alias("nan_agreement"),
    )
    diffs = rows.select("variable", F.abs(d).alias("__d"))
    q = group_quantiles(diffs, ["variable"], "__d", [0.5, 0.9, 0.99])
    out = stats.join(q, "variable", "left")
    for i, p in enumerate(("p50", "p90", "p99")):
        out = out.withColumn(p, F.col("q")[i])
    return out.drop("q")


def verdicts(
    stats: DataFrame, tier: str = "numerical", overrides: Mapping[str, Tolerance] | None = None,
    variables: Sequence[str] = (),
) -> DataFrame:
    """Add the tolerance and ``passed`` / ``reason`` to variable statistics."""
    names = list(variables) or sorted(set(SCIENTIFIC) | set(overrides or {}))
    default = TIERS[tier]

    def pick(attr: str) -> Column:
        out = F.lit(getattr(default, attr))
        for v in names:
            out = F.when(F.col("variable") == v, F.lit(getattr(tolerance_for(v, tier, overrides), attr))).otherwise(out)
        return out

    rate_a = (F.col("n_b_only") + F.col("n_neither")) / F.col("n_total")
    rate_b = (F.col("n_a_only") + F.col("n_neither")) / F.col("n_total")
    atol, mae_atol = pick("atol"), pick("mae_atol")
    some = F.col("n_compared") > 0
    reason = (
        F.when(some & (atol == 0) & (mae_atol == 0) & (F.col("max_abs_diff") > 0), "not identical")
        .when(some & (atol > 0) & (F.col("max_abs_diff") > atol), "max difference")
        .when(some & (mae_atol > 0) & (F.col("mae") > mae_atol), "mean difference")
        .when(F.abs(rate_a - rate_b) > pick("nan_rate_atol"), "missing rate")
        .otherwise("")
    )
    return stats.withColumn("reason", reason).withColumn("passed", F.col("reason") == "")


def compare_datasets(
    a: DataFrame, b: DataFrame, variables: Sequence[str] | None = None, tier: str = "numerical",
    overrides: Mapping[str, Tolerance] | None = None, aligned: bool = True, keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Statistics and verdict per shared variable, on the shared epochs and sids."""
    if variables is None:
        variables = sorted((set(a.columns) & set(b.columns)) - set(keys))
    if aligned:
        a, b = align(a, b, keys)
    return verdicts(variable_stats(a, b, variables, keys), tier, overrides, variables)


def diff_report(
    a: DataFrame, b: DataFrame, variables: Sequence[str], budgets: Mapping[str, float] | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Difference statistics with each variable's error budget and whether it is exceeded."""
    stats = variable_stats(a, b, variables, keys)
    budget = F.lit(None).cast("double")
    for v, x in (budgets or {}).items():
        budget = F.when(F.col("variable") == v, F.lit(float(x))).otherwise(budget)
    out = stats.withColumn("budget", budget)
    return out.withColumn(
        "exceeds_budget", F.coalesce(F.col("max_abs_diff") > F.col("budget"), F.lit(False))
    ).select(
        "variable", F.col("n_compared").alias("n_both"), "n_a_only", "n_b_only", "max_abs_diff",
        F.col("mae").alias("mean_abs"), "bias", "rmse", "p50", "p99", "budget", "exceeds_budget",
    )


def decompose_vod_difference(rows: DataFrame, cutoff_deg: float = 5.0) -> DataFrame:
    """How much of a VOD difference the two elevations explain.

    Needs vod_a, vod_b, elevation_a and elevation_b (degrees). The predicted
    difference is -ln T times the difference of the cosines.
    """
    seen = F.col("vod_a").isNotNull() & F.col("vod_b").isNotNull()
    seen = seen & F.col("elevation_a").isNotNull() & F.col("elevation_b").isNotNull()
    high = (F.col("elevation_a") > cutoff_deg) & (F.col("elevation_b") > cutoff_deg)
    cos_a = F.cos(F.radians(F.lit(90.0) - F.col("elevation_a")))
    cos_b = F.cos(F.radians(F.lit(90.0) - F.col("elevation_b")))
    both = rows.where(seen).withColumn("__ok", high)
    actual = F.when(F.col("__ok"), F.col("vod_a") - F.col("vod_b"))
    predicted = F.when(F.col("__ok"), F.try_divide(F.col("vod_a"), cos_a) * (cos_a - cos_b))
    work = both.withColumn("__d", actual).withColumn("__p", predicted)
    work = work.withColumn("__r", F.col("__d") - F.col("__p"))
    rms = lambda c: F.sqrt(F.avg(F.col(c) * F.col(c)))
    top = lambda c: F.max(F.abs(F.col(c)))
    out = work.agg(
        F.count("__d").alias("n_valid"),
        (F.count(F.lit(1)) - F.count("__d")).alias("n_excluded_horizon"),
        rms("__d").alias("actual_rmse"), top("__d").alias("actual_max"),
        rms("__p").alias("predicted_rmse"), top("__p").alias("predicted_max"),
        rms("__r").alias("residual_rmse"), top("__r").alias("residual_max"),
        (F.lit(1.0) - F.try_divide(F.var_pop("__r"), F.var_pop("__d"))).alias("explained_fraction"),
    )
    too_much = F.col("residual_max") > F.lit(FLOAT32_VOD_RESIDUAL * 10)
    return out.withColumn("residual_exceeds_noise", F.coalesce(too_much, F.lit(False)))


def merge_codes(obs: DataFrame, band_number: str, variables: Sequence[str]) -> DataFrame:
    """One row per (epoch, satellite) of band ``L<n>``: the first non-missing value in sid order."""
    rows = obs.where(F.col("sid").contains(f"|L{band_number}|"))
    first = [
        F.min_by(F.col(v), F.when(F.col(v).isNotNull(), F.col("sid"))).alias(v) for v in variables
    ]
    return rows.groupBy("epoch", sid_part("sid", 0).alias("sid")).agg(*first)


def external_frame(obs: DataFrame, band: str, code: str, snr_name: str, vod_name: str | None = None) -> DataFrame:
    """Observations of one signal per satellite in degrees, keyed by PRN."""
    rows = obs.where(F.col("sid").endswith(f"|{band}|{code}"))
    cols = [
        F.col("SNR").alias(snr_name),
        F.pmod(F.degrees("phi"), F.lit(360.0)).alias("Azimuth"),
        (F.lit(90.0) - F.degrees("theta")).alias("Elevation"),
    ]
    if vod_name and "VOD" in obs.columns:
        cols.append(F.col("VOD").alias(vod_name))
    return rows.select("epoch", sid_part("sid", 0).alias("sid"), *cols)


def external_long(frame: DataFrame, variables: Sequence[str]) -> DataFrame:
    """External rows averaged per (Epoch, SV), renamed to epoch and sid."""
    return frame.groupBy(F.col("Epoch").alias("epoch"), F.col("SV").alias("sid")).agg(
        *[F.avg(v).alias(v) for v in variables]
    )


def detect_bands(obs: DataFrame, external_columns: Sequence[str]) -> DataFrame:
    """(band_number, code, snr_column) for bands both sides have.

    The first external column whose tracking code was observed wins; without
    one, the first observed code and the first column.
    """
    names = [c for c in external_columns if c.startswith("S") and len(c) == 3]
    bands = (
        obs.select(sid_part("sid", 1).alias("band"), sid_part("sid", 2).alias("code"))
        .distinct()
        .where(F.col("band").rlike(r"^L\d$"))
        .groupBy(F.substring("band", 2, 1).alias("band_number"))
        .agg(F.sort_array(F.collect_set("code")).alias("codes"))
    )
    cols = F.filter(F.array(*map(F.lit, names)), lambda c: F.substring(c, 2, 1) == F.col("band_number"))
    bands = bands.withColumn("__cols", cols).where(F.size("__cols") > 0)
    hits = F.filter("__cols", lambda c: F.array_contains(F.col("codes"), F.substring(c, 3, 1)))
    bands = bands.withColumn("__hits", hits)
    matched = F.size("__hits") > 0
    return bands.select(
        "band_number",
        F.when(matched, F.substring(F.get("__hits", F.lit(0)), 3, 1)).otherwise(F.get("codes", F.lit(0))).alias("code"),
        F.when(matched, F.get("__hits", F.lit(0))).otherwise(F.get("__cols", F.lit(0))).alias("snr_column"),
    )


def pick_codes(obs: DataFrame, prefer: Sequence[str]) -> DataFrame:
    """Per band the first available code of ``prefer``, else the first in order."""
    codes = obs.select(sid_part("sid", 1).alias("band"), sid_part("sid", 2).alias("code")).distinct()
    by_band = codes.groupBy("band").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    wanted = F.filter(F.array(*map(F.lit, prefer)), lambda c: F.array_contains(F.col("codes"), c))
    return by_band.select("band", F.coalesce(F.get(wanted, F.lit(0)), F.get("codes", F.lit(0))).alias("code"))


def compare_band(a: DataFrame, b: DataFrame, snr_name: str) -> DataFrame:
    """Differences of two frames in degrees, with azimuths wrapped before subtracting."""
    variables = [v for v in (snr_name, "Azimuth", "Elevation") if v in a.columns and v in b.columns]
    joined = a.alias("a").join(b.alias("b"), ["epoch", "sid"])
    wrapped = {
        v: wrap_azimuth_difference(F.col(f"a.{v}"), F.col(f"b.{v}")) if v == "Azimuth" else F.col(f"a.{v}")
        for v in variables
    }
    left = joined.select("epoch", "sid", *[wrapped[v].alias(v) for v in variables])
    right = joined.select("epoch", "sid", *[F.col(f"b.{v}").alias(v) for v in variables])
    return variable_stats(left, right, variables)


def bottlenecks(timings: DataFrame, top_n: int = 10, metric_type: str | None = None) -> DataFrame:
    """The operations with the largest total time, and their share of the listed total."""
    if "metric_type" in timings.columns:
        kind = F.col("metric_type")
        timings = timings.where(kind.isNull() if metric_type is None else kind == metric_type)
    top = (
        timings.groupBy("operation")
        .agg(
            F.sum("duration_s").alias("total_s"), F.avg("duration_s").alias("mean_s"),
            F.count("duration_s").alias("count"),
        )
        .orderBy(F.desc("total_s"), "operation")
        .limit(top_n)
    )
    grand = top.select(F.sum("total_s")).scalar()
    return top.select(
        "operation", F.round("total_s", 3).alias("total_s"), F.round("mean_s", 3).alias("mean_s"), "count",
        F.round(F.coalesce(F.try_divide(F.col("total_s"), grand) * 100, F.lit(0.0)), 1).alias("pct"),
    )


def query_metrics(
    metrics: DataFrame, since=None, operation_like: str | None = None, metric_type: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Metric rows, newest first."""
    if since is not None:
        metrics = metrics.where(F.col("ts") >= F.lit(since))
    if operation_like is not None:
        metrics = metrics.where(F.col("operation").like(operation_like))
    if metric_type is not None:
        metrics = metrics.where(F.col("metric_type") == metric_type)
    metrics = metrics.orderBy(F.desc("ts"))
    return metrics if limit is None else metrics.limit(limit)
