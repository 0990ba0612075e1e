"""Cell weights: one value per grid cell, from the grid or from observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.operators.quantiles import group_median


def _on_grid(cells: DataFrame, agg: DataFrame, value: str) -> DataFrame:
    return cells.select("cell_id").join(agg, "cell_id", "left").select(
        "cell_id", F.coalesce(value, F.lit(0.0)).alias("weight")
    )


def _rows(obs: DataFrame, var: str, cell: str) -> DataFrame:
    rows = obs.where(F.col(var).isNotNull() & F.col(cell).isNotNull())
    return rows.withColumnRenamed(cell, "cell_id")


def solid_angle(cells: DataFrame) -> DataFrame:
    return cells.select("cell_id", F.greatest("solid_angle", F.lit(1e-10)).alias("weight"))


def sin_elevation(cells: DataFrame) -> DataFrame:
    return cells.select("cell_id", F.greatest(F.cos("theta"), F.lit(0.0)).alias("weight"))


def uniform(cells: DataFrame) -> DataFrame:
    n = cells.select(F.count(F.lit(1))).scalar()
    return cells.select("cell_id", (F.lit(1.0) / n).alias("weight"))


def observation_count(
    cells: DataFrame, obs: DataFrame, var: str = "VOD", cell: str = "cell_id", min_count: int = 1
) -> DataFrame:
    agg = _rows(obs, var, cell).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
    agg = agg.select(
        "cell_id", F.when(F.col("n") >= min_count, F.col("n").cast("double")).otherwise(0.0).alias("w")
    )
    return _on_grid(cells, agg, "w")


def snr(
    cells: DataFrame, obs: DataFrame, var: str = "SNR", cell: str = "cell_id", how: str = "mean"
) -> DataFrame:
    """mean / median / max of ``var`` per cell; a grid's own ``mean_snr`` wins."""
    if "mean_snr" in cells.columns:
        return cells.select("cell_id", F.col("mean_snr").alias("weight"))
    rows = _rows(obs, var, cell)
    if how == "median":
        agg = group_median(rows, ["cell_id"], var, "w")
    elif how in ("mean", "max"):
        agg = rows.groupBy("cell_id").agg({"mean": F.avg, "max": F.max}[how](var).alias("w"))
    else:
        raise ValueError(f"unknown aggregation {how!r}")
    return _on_grid(cells, agg, "w")


def inverse_variance(
    cells: DataFrame, obs: DataFrame, var: str = "VOD", cell: str = "cell_id", min_observations: int = 2,
    regularization: float = 0.0,
) -> DataFrame:
    """1 / (sample variance + regularization); 0 for thin or constant cells."""
    agg = _rows(obs, var, cell).groupBy("cell_id").agg(
        F.var_samp(var).alias("v"), F.count(F.lit(1)).alias("n")
    )
    good = (F.col("n") >= min_observations) & (F.col("v") > 0)
    agg = agg.select("cell_id", F.when(good, 1 / (F.col("v") + F.lit(float(regularization)))).alias("w"))
    return _on_grid(cells, agg, "w")


def custom(cells: DataFrame, values: DataFrame) -> DataFrame:
    """A table (cell_id, weight); cells it lacks get 0."""
    return _on_grid(cells, values.select("cell_id", F.col("weight").cast("double").alias("w")), "w")


def normalise(weights: DataFrame) -> DataFrame:
    """Scale to sum 1; missing counts as 0, and all zero becomes uniform."""
    w = F.coalesce(F.when(~F.isnan("weight"), F.col("weight")), F.lit(0.0))
    clean = weights.select("cell_id", w.alias("weight"))
    total = clean.select(F.struct(F.sum("weight").alias("s"), F.count(F.lit(1)).alias("n"))).scalar()
    scaled: Column = F.when(total["s"] > 0, F.try_divide(F.col("weight"), total["s"])).otherwise(
        F.lit(1.0) / total["n"]
    )
    return clean.select("cell_id", scaled.alias("weight"))


def combine(parts: list[DataFrame], how: str = "multiply", normalise_each: bool = True, normalise_final: bool = True) -> DataFrame:
    """Product or sum of several weights over the same grid."""
    if not parts:
        raise ValueError("no weights added")
    if how not in ("multiply", "add"):
        raise ValueError(f"unknown combination {how!r}")
    acc = None
    for i, part in enumerate(parts):
        part = (normalise(part) if normalise_each else part).withColumnRenamed("weight", f"__w{i}")
        acc = part if acc is None else acc.join(part, "cell_id")
    cols = [F.col(f"__w{i}") for i in range(len(parts))]
    total = cols[0]
    for c in cols[1:]:
        total = total * c if how == "multiply" else total + c
    out = acc.select("cell_id", total.alias("weight"))
    return normalise(out) if normalise_final else out


def area_weights(cells: DataFrame) -> DataFrame:
    return normalise(solid_angle(cells))
