"""Spatial masks: predicates over a grid's cells, combined with AND or OR."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

TWO_PI = 2 * math.pi


class SpatialMask:
    """Named predicates over grid columns; ``True`` keeps a cell."""

    def __init__(self) -> None:
        self.parts: list[tuple[str, Column]] = []

    def _add(self, name: str, cond: Column) -> "SpatialMask":
        self.parts.append((name, F.coalesce(cond, F.lit(False))))
        return self

    def phi_range(self, lo: float, hi: float, degrees: bool = True) -> "SpatialMask":
        """Azimuth range, inclusive; ``lo`` above ``hi`` goes through North."""
        if degrees:
            lo, hi = math.radians(lo), math.radians(hi)
        lo, hi = lo % TWO_PI, hi % TWO_PI
        p = F.pmod(F.col("phi"), F.lit(TWO_PI))
        inside = p.between(lo, hi) if lo <= hi else (p >= lo) | (p <= hi)
        return self._add("phi_range", inside)

    def theta_range(self, lo: float, hi: float, degrees: bool = True) -> "SpatialMask":
        if degrees:
            lo, hi = math.radians(lo), math.radians(hi)
        return self._add("theta_range", F.col("theta").between(lo, hi))

    def elevation_range(self, lo: float = 0.0, hi: float = 90.0, degrees: bool = True) -> "SpatialMask":
        if degrees:
            lo, hi = math.radians(lo), math.radians(hi)
        inside = F.col("theta").between(math.pi / 2 - hi, math.pi / 2 - lo)
        return self._add("elevation_range", inside)

    def cell_ids(self, ids: Iterable[int]) -> "SpatialMask":
        return self._add("cell_ids", F.col("cell_id").isin([int(i) for i in ids]))

    def exclude_cell_ids(self, ids: Iterable[int]) -> "SpatialMask":
        return self._add("exclude_cell_ids", ~F.col("cell_id").isin([int(i) for i in ids]))

    def quality_threshold(self, column: str, lo: float | None = None, hi: float | None = None) -> "SpatialMask":
        cond = F.col(column).isNotNull()
        if lo is not None:
            cond = cond & (F.col(column) >= lo)
        if hi is not None:
            cond = cond & (F.col(column) <= hi)
        return self._add(f"quality_{column}", cond)

    def boundary_cells(self, exclude: bool = True) -> "SpatialMask":
        edge = F.col("is_boundary")
        return self._add("boundary", ~edge if exclude else edge)

    def custom(self, name: str, predicate: Column | Callable[[], Column]) -> "SpatialMask":
        cond = predicate() if callable(predicate) and not isinstance(predicate, Column) else predicate
        return self._add(name, cond)

    def radial_sector(
        self, centre_phi: float, width: float, theta_min: float = 0.0, theta_max: float = 90.0,
        degrees: bool = True,
    ) -> "SpatialMask":
        self.phi_range(centre_phi - width / 2, centre_phi + width / 2, degrees)
        return self.theta_range(theta_min, theta_max, degrees)

    def clear(self) -> "SpatialMask":
        self.parts.clear()
        return self

    def condition(self, mode: str = "AND") -> Column:
        if not self.parts:
            raise ValueError("no masks added")
        conds = [c for _, c in self.parts]
        if mode.upper() == "AND":
            return reduce(lambda a, b: a & b, conds)
        if mode.upper() == "OR":
            return reduce(lambda a, b: a | b, conds)
        raise ValueError(f"unknown mode {mode!r}")

    def compute(self, cells: DataFrame, mode: str = "AND") -> DataFrame:
        """(cell_id, keep)."""
        return cells.select("cell_id", self.condition(mode).alias("keep"))

    def summary(self, cells: DataFrame) -> DataFrame:
        """(mask, n_cells, fraction) per predicate and for AND / OR of all."""
        named = [(f"{i}_{n}", c) for i, (n, c) in enumerate(self.parts)]
        named += [("AND", self.condition("AND")), ("OR", self.condition("OR"))]
        counts = cells.agg(
            F.count(F.lit(1)).alias("__total"),
            *[F.sum(c.cast("bigint")).alias(n) for n, c in named],
        )
        long = counts.unpivot(["__total"], [n for n, _ in named], "mask", "n_cells")
        return long.select("mask", "n_cells", (F.col("n_cells") / F.col("__total")).alias("fraction"))


# Azimuth sector of each compass half-quadrant in degrees.
SECTORS = {
    "north": (315.0, 45.0),
    "east": (45.0, 135.0),
    "south": (135.0, 225.0),
    "west": (225.0, 315.0),
}


def hemisphere_mask(cells: DataFrame, side: str) -> DataFrame:
    if side.lower() not in SECTORS:
        raise ValueError(f"unknown side {side!r}; one of {sorted(SECTORS)}")
    return SpatialMask().phi_range(*SECTORS[side.lower()]).compute(cells)


def elevation_mask(cells: DataFrame, lo: float = 30.0, hi: float = 90.0) -> DataFrame:
    return SpatialMask().elevation_range(lo, hi).compute(cells)


def apply_mask(df: DataFrame, mask: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Rows whose cell the mask keeps."""
    keep = mask.where("keep").select(F.col("cell_id").alias(cell))
    return df.join(keep, cell, "left_semi")
