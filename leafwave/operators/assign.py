"""Nearest-centre cell assignment without a cross join.

Grids made of equal bands (equal_area, equal_angle) need no table at all: in a
band the nearest centre is that of the sector holding the azimuth, and only the
nearest band and its two neighbours can hold the winner, so three cosines
decide. For every other grid the sky is cut into small bins. For each bin a table lists every cell that can
be nearest to any point in it: with c the bin centre, r its radius and d the
distance from c to its nearest cell, the triangle inequality leaves only cells
within d + 2r of c. An observation computes its bin arithmetically, meets the
table in one equi-join and compares a handful of candidates. Exact for any
grid; the table's size depends on the grid alone.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafwave.functions.numeric import clip
from leafwave.operators.grids import Grid, create_grid, grid_hash

TWO_PI = 2 * math.pi
# Distances this close are ties, and the lowest cell id wins.
TIE_DIGITS = 12
MAX_BINS = 80_000
_TABLES: dict[str, "SkyBins"] = {}


class SkyBins:
    """Bin layout and candidate table of one grid."""

    def __init__(self, grid: Grid) -> None:
        spacing = math.sqrt(TWO_PI / grid.ncells)
        width = max(spacing / 2, math.sqrt(4 * math.pi / MAX_BINS))
        self.rows = math.ceil(math.pi / width)
        self.height = math.pi / self.rows
        edges = np.arange(self.rows + 1) * self.height
        widest = np.where(
            (edges[:-1] <= math.pi / 2) & (edges[1:] >= math.pi / 2),
            1.0,
            np.maximum(np.sin(edges[:-1]), np.sin(edges[1:])),
        )
        self.counts = np.maximum(1, np.ceil(TWO_PI * widest / width)).astype(int)
        self.offsets = np.concatenate([[0], np.cumsum(self.counts)[:-1]])
        self.table = self._candidates(grid, edges)

    def _candidates(self, grid: Grid, edges: np.ndarray) -> pa.Table:
        row = np.repeat(np.arange(self.rows), self.counts)
        within = np.arange(len(row)) - self.offsets[row]
        span = TWO_PI / self.counts[row]
        phi = (within + 0.5) * span
        lo, hi = edges[row], edges[row + 1]
        mid = (lo + hi) / 2
        radius = np.zeros(len(row))
        for f in np.linspace(0, 1, 5):
            t = lo + f * (hi - lo)
            dot = np.cos(t) * np.cos(mid) + np.sin(t) * np.sin(mid) * np.cos(span / 2)
            radius = np.maximum(radius, np.sqrt(np.maximum(0, 2 - 2 * dot)))
        radius = radius * 1.01 + 1e-6
        centre = np.column_stack(
            [np.sin(mid) * np.cos(phi), np.sin(mid) * np.sin(phi), np.cos(mid)]
        )
        cells, ids = grid.centres(), grid.cells["cell_id"].to_numpy()
        found = []
        step = max(1, 4_000_000 // len(ids))
        for a in range(0, len(row), step):
            d = np.sqrt(np.maximum(0, 2 - 2 * centre[a : a + step] @ cells.T))
            limit = d.min(axis=1) + 2 * radius[a : a + step]
            b, c = np.nonzero(d <= limit[:, None])
            found.append(np.column_stack([b + a, c]))
        hit = np.concatenate(found)
        hit = hit[np.lexsort((ids[hit[:, 1]], hit[:, 0]))]
        starts = np.searchsorted(hit[:, 0], np.arange(len(row) + 1)).astype(np.int32)
        chosen = hit[:, 1]
        structs = pa.StructArray.from_arrays(
            [pa.array(ids[chosen].astype(np.int32)), *[pa.array(cells[chosen, i]) for i in range(3)]],
            names=["cell_id", "x", "y", "z"],
        )
        return pa.table(
            {
                "__bin": pa.array(np.arange(len(row), dtype=np.int32)),
                "__cells": pa.ListArray.from_arrays(pa.array(starts), structs),
            }
        )

    def bin_of(self, theta: Column, phi: Column) -> Column:
        return bin_column(theta, phi, self.height, self.counts.tolist(), self.offsets.tolist())


def bin_column(theta: Column, phi: Column, height: float, counts: list[int], offsets: list[int]) -> Column:
    """Number of the sky bin of a direction: rows of one height, each cut into ``counts`` bins that start at ``offsets``."""
    row = clip(F.floor(theta / F.lit(height)).cast("int"), 0, len(counts) - 1)
    n = F.get(F.array(*map(F.lit, counts)), row)
    first = F.get(F.array(*map(F.lit, offsets)), row)
    turn = F.pmod(phi, F.lit(TWO_PI))
    k = F.floor(turn / F.lit(TWO_PI) * n).cast("int")
    return (first + F.when(k >= n, n - 1).otherwise(k)).cast("int")


def sky_bins(grid: Grid) -> SkyBins:
    key = grid_hash(grid)
    if key not in _TABLES:
        _TABLES[key] = SkyBins(grid)
    return _TABLES[key]


def candidate_table(df: DataFrame, grid: Grid) -> DataFrame:
    """(__bin, __cells) with the candidates of a bin in one array."""
    return df.sparkSession.createDataFrame(sky_bins(grid).table)


def _by_bands(obs: DataFrame, grid: Grid, theta: str, phi: str) -> tuple[DataFrame, Column]:
    """Rows with helper columns, and the nearest cell's id from them."""
    bands = grid.info["bands"]
    res = math.radians(grid.resolution)
    table = lambda values: F.array(*map(F.lit, values))
    counts, firsts = table([b[1] for b in bands]), table([b[2] for b in bands])
    sines, cosines = table([math.sin(b[0]) for b in bands]), table([math.cos(b[0]) for b in bands])
    rotation = math.radians(grid.info.get("phi_rotation", 0.0))
    t = F.col(theta)
    turn = F.pmod(F.col(phi) - F.lit(rotation), F.lit(TWO_PI)) / F.lit(TWO_PI)
    last = len(bands) - 1
    home = clip(F.floor(t / F.lit(res) + 0.5).cast("int"), 0, last)
    work = obs.withColumns(
        {"__st": F.sin(t), "__ct": F.cos(t), "__turn": turn, "__home": home}
    )
    three = range(3)
    work = work.withColumns({f"__b{i}": clip(F.col("__home") + (i - 1), 0, last) for i in three})
    work = work.withColumns({f"__n{i}": F.get(counts, F.col(f"__b{i}")) for i in three})
    work = work.withColumns({f"__x{i}": F.col("__turn") * F.col(f"__n{i}") for i in three})
    work = work.withColumns(
        {f"__k{i}": F.pmod(F.floor(f"__x{i}").cast("int"), F.col(f"__n{i}")) for i in three}
    )
    dots, ids = [], []
    for i in three:
        b, k, n, x = (F.col(f"__{c}{i}") for c in "bknx")
        away = (x - (k + F.lit(0.5))) / n * F.lit(TWO_PI)
        dot = F.col("__st") * F.get(sines, b) * F.cos(away) + F.col("__ct") * F.get(cosines, b)
        dots.append(F.round(dot, TIE_DIGITS).alias(f"__d{i}"))
        # On a sector edge both centres are equally near: the lower id.
        edge = F.when((x - k < 1e-11) & (k > 0), 1).otherwise(0)
        ids.append((F.get(firsts, b) + k - edge).alias(f"__i{i}"))
    work = work.select(*obs.columns, *dots, *ids)
    best = F.greatest("__d0", "__d1", "__d2")
    return work, F.least(*[F.when(F.col(f"__d{i}") == best, F.col(f"__i{i}")) for i in range(3)])


def assign_cells(
    obs: DataFrame, grid: Grid, out: str | None = None, theta: str = "theta", phi: str = "phi"
) -> DataFrame:
    """Add the id of the cell whose centre is nearest; NULL where an angle is NULL."""
    out = out or f"cell_id_{grid.name}"
    if "bands" in grid.info:
        work, cell = _by_bands(obs, grid, theta, phi)
        # One-element explode: a filter on the id must not be pushed down
        # through the helper columns, whose inlined copies would not compile.
        return work.select(*obs.columns, F.explode(F.array(cell.cast("int"))).alias(out))
    return assign_by_table(obs, grid, out, theta, phi)


def assign_by_table(
    obs: DataFrame, grid: Grid, out: str, theta: str = "theta", phi: str = "phi"
) -> DataFrame:
    """The candidate-table path, right for any grid."""
    return nearest_candidate(obs, sky_bins(grid).bin_of(F.col(theta), F.col(phi)), candidate_table(obs, grid), out, theta, phi)


def nearest_candidate(obs: DataFrame, bin_: Column, candidates: DataFrame, out: str, theta: str, phi: str) -> DataFrame:
    """Nearest of the candidate cells of each row's bin."""
    # At most MAX_BINS rows, whatever the observations number.
    table = F.broadcast(candidates)
    t, p = F.col(theta), F.col(phi)
    work = (
        obs.withColumn("__bin", bin_)
        .withColumn("__x", F.sin(t) * F.cos(p))
        .withColumn("__y", F.sin(t) * F.sin(p))
        .withColumn("__z", F.cos(t))
        .join(table, "__bin", "left")
    )

    def scored(c: Column) -> Column:
        dot = F.col("__x") * c["x"] + F.col("__y") * c["y"] + F.col("__z") * c["z"]
        return F.struct((-F.round(dot, TIE_DIGITS)).alias("d"), c["cell_id"].alias("id"))

    best = F.array_min(F.transform("__cells", scored))
    return work.select(*obs.columns, best["id"].cast("int").alias(out))


@lru_cache(maxsize=32)
def cached_grid(kind: str, resolution: float, cutoff: float = 0.0) -> Grid:
    return create_grid(kind, resolution, cutoff)


def assign_to(obs: DataFrame, kind: str = "equal_area", resolution: float = 10.0, **kw) -> DataFrame:
    """``assign_cells`` on a grid given by name."""
    return assign_cells(obs, cached_grid(kind, float(resolution)), **kw)
