"""Grids written out with their sky index, and used again without the code that built them.

A stored grid is three tables: its cells, the layout of its sky bins (one row)
and the candidate cells of each bin. Observations compute their bin from the
layout, meet the bins in one broadcast join (at most ``assign.MAX_BINS`` rows)
and compare a handful of candidates, so a grid of any kind, or from another
version of the builders, assigns as it did when it was written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafwave.operators.assign import bin_column, nearest_candidate, sky_bins
from leafwave.operators.grids import Grid, grid_hash

LAYOUT = "kind string, resolution double, cutoff double, ncells int, grid_hash string, height double, counts array<int>, offsets array<int>"


def save_grid(spark: SparkSession, grid: Grid, path: str) -> str:
    """Write a grid below ``path``; the layout comes last, so what can be loaded is whole."""
    bins = sky_bins(grid)
    grid.with_solid_angles(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    spark.createDataFrame(bins.table).write.mode("overwrite").parquet(f"{path}/bins")
    row = (grid.kind, float(grid.resolution), float(grid.cutoff), grid.ncells, grid_hash(grid), float(bins.height), bins.counts.tolist(), bins.offsets.tolist())
    spark.createDataFrame([row], LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    return path


@dataclass(frozen=True)
class StoredGrid:
    spark: SparkSession
    path: str
    kind: str
    resolution: float
    cutoff: float
    ncells: int
    grid_hash: str
    height: float
    counts: list[int]
    offsets: list[int]

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.resolution:g}deg"

    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    def assign(self, obs: DataFrame, out: str | None = None, theta: str = "theta", phi: str = "phi") -> DataFrame:
        """Add the id of the nearest cell; NULL where an angle is NULL."""
        bin_ = bin_column(F.col(theta), F.col(phi), self.height, self.counts, self.offsets)
        return nearest_candidate(obs, bin_, self.spark.read.parquet(f"{self.path}/bins"), out or f"cell_id_{self.name}", theta, phi)


def load_grid(spark: SparkSession, path: str) -> StoredGrid:
    """A grid that ``save_grid`` wrote; one row reaches the driver."""
    row = spark.read.schema(LAYOUT).parquet(f"{path}/layout").first()
    return StoredGrid(spark, path, *row)
