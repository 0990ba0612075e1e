"""Hemispheric grids as small dimension tables, and their solid angles.

A grid has at most a few hundred thousand cells whatever the data size, so it
is built from parameters and may be broadcast. ``MAX_CELLS`` enforces that.

Columns: cell_id, phi, theta (centre), phi_min, phi_max, theta_min, theta_max,
and for triangular grids ``vertices`` (three unit vectors).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_CELLS = 500_000
TWO_PI = 2 * math.pi
HALF_PI = math.pi / 2


@dataclass(frozen=True)
class Grid:
    """A grid: its cells (pandas, bounded) and the parameters that made it."""

    kind: str
    resolution: float
    cutoff: float
    cells: pd.DataFrame
    info: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if len(self.cells) > MAX_CELLS:
            raise ValueError(f"{self.kind} grid has {len(self.cells)} cells, limit {MAX_CELLS}")
        if not len(self.cells):
            raise ValueError(f"{self.kind} grid has no cell above the cutoff")

    @property
    def ncells(self) -> int:
        return len(self.cells)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.resolution:g}deg"

    def centres(self) -> np.ndarray:
        """Unit vectors of the cell centres, one row per cell."""
        t, p = self.cells["theta"].to_numpy(), self.cells["phi"].to_numpy()
        return np.column_stack([np.sin(t) * np.cos(p), np.sin(t) * np.sin(p), np.cos(t)])

    def to_df(self, spark: SparkSession) -> DataFrame:
        df = spark.createDataFrame(self.cells)
        return df.withColumn("cell_id", F.col("cell_id").cast("int"))

    def with_solid_angles(self, spark: SparkSession) -> DataFrame:
        return self.to_df(spark).withColumn("solid_angle", solid_angle_column(self))


def _arange_count(start: float, stop: float, step: float) -> int:
    return max(0, math.ceil((stop - start) / step))


def _bands_to_cells(bands: list[tuple[float, float, float, int]]) -> pd.DataFrame:
    """(theta centre, theta_min, theta_max, sectors) per band to one row per cell."""
    parts = []
    for centre, lo, hi, n in bands:
        k = np.arange(n)
        left = k * (TWO_PI / n)
        right = np.append(left[1:], TWO_PI)
        mid = (left + right) / 2 if centre else np.zeros(n)
        parts.append(
            pd.DataFrame(
                {
                    "phi": mid,
                    "theta": centre,
                    "phi_min": left,
                    "phi_max": right,
                    "theta_min": lo,
                    "theta_max": hi,
                }
            )
        )
    cells = pd.concat(parts, ignore_index=True)
    cells.insert(0, "cell_id", np.arange(len(cells), dtype=np.int32))
    return cells


def _band_info(bands: list[tuple[float, float, float, int]], cutoff: float) -> dict:
    """(theta, sectors, first cell id) per band, when no band is missing."""
    if cutoff:
        return {}
    firsts = np.concatenate([[0], np.cumsum([b[3] for b in bands])])[:-1]
    return {"bands": [(b[0], int(b[3]), int(f)) for b, f in zip(bands, firsts)]}


def _theta_edges(res: float, cutoff: float) -> list[float]:
    count = _arange_count(res / 2, HALF_PI - cutoff, res)
    return [res / 2 + i * res for i in range(count)]


def equal_area(resolution: float = 10.0, cutoff: float = 0.0) -> Grid:
    """Bands one resolution wide whose sectors match the zenith cap's solid angle."""
    res, cut = math.radians(resolution), math.radians(cutoff)
    cap = TWO_PI * (1 - math.cos(res / 2))
    bands = [(0.0, max(0.0, cut), res / 2, 1)] if cut < res / 2 else []
    edges = _theta_edges(res, cut)
    for lo, hi in zip(edges, edges[1:]):
        if hi > cut:
            n = max(1, round(TWO_PI * (math.cos(lo) - math.cos(hi)) / cap))
            bands.append(((lo + hi) / 2, lo, hi, n))
    return Grid("equal_area", resolution, cutoff, _bands_to_cells(bands), _band_info(bands, cut))


def equal_angle(resolution: float = 10.0, cutoff: float = 0.0) -> Grid:
    """The same bands, each cut into the same number of sectors."""
    res, cut = math.radians(resolution), math.radians(cutoff)
    n = int(TWO_PI / res)
    edges = _theta_edges(res, cut)
    bands = [(0.0, 0.0, res / 2, 1)]
    bands += [((lo + hi) / 2, lo, hi, n) for lo, hi in zip(edges, edges[1:])]
    return Grid("equal_angle", resolution, cutoff, _bands_to_cells(bands), _band_info(bands, cut))


def equirectangular(resolution: float = 10.0, cutoff: float = 0.0) -> Grid:
    """Plain theta x phi rectangles; float steps may add an edge, which is kept."""
    res, cut = math.radians(resolution), math.radians(cutoff)
    theta = np.arange(cut, HALF_PI + res, res)
    phi = np.arange(0, TWO_PI + res, res)
    t0, p0 = np.meshgrid(theta[:-1], phi[:-1], indexing="ij")
    t1, p1 = np.meshgrid(theta[1:], phi[1:], indexing="ij")
    cells = pd.DataFrame(
        {
            "phi": ((p0 + p1) / 2).ravel(),
            "theta": ((t0 + t1) / 2).ravel(),
            "phi_min": p0.ravel(),
            "phi_max": np.minimum(TWO_PI, p1.ravel()),
            "theta_min": t0.ravel(),
            "theta_max": t1.ravel(),
        }
    )
    cells.insert(0, "cell_id", np.arange(len(cells), dtype=np.int32))
    return Grid("equirectangular", resolution, cutoff, cells)


def _polar(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """theta and phi of unit vectors on the last axis."""
    theta = np.arccos(np.clip(v[..., 2], -1, 1))
    return theta, np.mod(np.arctan2(v[..., 1], v[..., 0]), TWO_PI)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def _split_triangles(tri: np.ndarray, pattern: list[list[int]]) -> np.ndarray:
    """Each triangle into four, children in ``pattern`` order next to each other.

    Corner indices 0-2 are the parent's, 3-5 the midpoints of edges 01, 12, 20.
    """
    mids = _unit((tri + np.roll(tri, -1, axis=1)) / 2)
    corners = np.concatenate([tri, mids], axis=1)
    return corners[:, np.array(pattern)].reshape(-1, 3, 3)


def _triangles_to_cells(tri: np.ndarray, theta: np.ndarray, phi: np.ndarray) -> pd.DataFrame:
    centre_theta, centre_phi = _polar(_unit(tri.mean(axis=1)))
    cells = pd.DataFrame(
        {
            "phi": centre_phi,
            "theta": centre_theta,
            "phi_min": phi.min(axis=1),
            "phi_max": phi.max(axis=1),
            "theta_min": theta.min(axis=1),
            "theta_max": theta.max(axis=1),
            "vertices": tri.tolist(),
        }
    )
    cells.insert(0, "cell_id", np.arange(len(cells), dtype=np.int32))
    return cells


def htm(resolution: float = 10.0, cutoff: float = 0.0, level: int | None = None) -> Grid:
    """Hierarchical triangular mesh: an octahedron's faces split four-way."""
    if level is None:
        level = min(15, max(0, math.ceil(math.log2(90 / (2 * resolution)))))
    if 8 * 4**level > 4 * MAX_CELLS:
        raise ValueError(f"HTM level {level} exceeds {MAX_CELLS} cells")
    # The octahedron's corners and faces, which set the cell order.
    corner = np.array(
        [[0, 0, 1], [1, 0, 0], [0, 1, 0], [-1, 0, 0], [0, -1, 0], [0, 0, -1]], dtype=float
    )
    faces = np.array(
        [[0, 1, 2], [0, 2, 3], [0, 3, 4], [0, 4, 1], [5, 2, 1], [5, 3, 2], [5, 4, 3], [5, 1, 4]]
    )
    tri, ids = corner[faces], np.arange(8, dtype=np.int64)
    for _ in range(level):
        tri = _split_triangles(tri, [[0, 3, 5], [1, 4, 3], [2, 5, 4], [3, 4, 5]])
        ids = (ids[:, None] * 10 + np.arange(4)).ravel()
    theta, phi = _polar(tri)
    keep = ~(theta > HALF_PI - math.radians(cutoff)).all(axis=1)
    cells = _triangles_to_cells(tri[keep], theta[keep], phi[keep])
    cells["htm_id"], cells["htm_level"] = ids[keep], level
    return Grid("htm", resolution, cutoff, cells, {"htm_level": level})


def geodesic(resolution: float = 10.0, cutoff: float = 0.0, level: int | None = None) -> Grid:
    """Subdivided icosahedron."""
    if level is None:
        level = max(0, math.ceil(math.log2(63.4 / (2 * resolution))))
    if 20 * 4**level > 4 * MAX_CELLS:
        raise ValueError(f"geodesic level {level} exceeds {MAX_CELLS} cells")
    g = (1 + math.sqrt(5)) / 2
    # The icosahedron's corners and faces, which set the cell order.
    corner = np.array(
        [
            [-1, g, 0], [1, g, 0], [-1, -g, 0], [1, -g, 0], [0, -1, g], [0, 1, g],
            [0, -1, -g], [0, 1, -g], [g, 0, -1], [g, 0, 1], [-g, 0, -1], [-g, 0, 1],
        ]
    )
    faces = np.array(
        [
            [0, 11, 5], [0, 5, 1], [0, 1, 7], [0, 7, 10], [0, 10, 11],
            [1, 5, 9], [5, 11, 4], [11, 10, 2], [10, 7, 6], [7, 1, 8],
            [3, 9, 4], [3, 4, 2], [3, 2, 6], [3, 6, 8], [3, 8, 9],
            [4, 9, 5], [2, 4, 11], [6, 2, 10], [8, 6, 7], [9, 8, 1],
        ]
    )
    tri = _unit(corner)[faces]
    for _ in range(level):
        tri = _split_triangles(tri, [[0, 3, 5], [1, 4, 3], [2, 5, 4], [3, 4, 5]])
    theta, phi = _polar(tri)
    keep = (theta <= HALF_PI - math.radians(cutoff)).any(axis=1)
    tri, theta, phi = tri[keep], theta[keep], phi[keep]
    cells = _triangles_to_cells(tri, theta, phi)
    # Triangles across phi = 0 get bounds measured around their middle corner.
    middle = np.median(phi, axis=1, keepdims=True)
    turned = phi + np.where(middle - phi > math.pi, TWO_PI, 0) - np.where(phi - middle > math.pi, TWO_PI, 0)
    crossing = np.ptp(phi, axis=1) > math.pi
    cells.loc[crossing, "phi_min"] = np.mod(turned.min(axis=1), TWO_PI)[crossing]
    cells.loc[crossing, "phi_max"] = np.mod(turned.max(axis=1), TWO_PI)[crossing]
    cells["geodesic_subdivision"] = level
    return Grid("geodesic", resolution, cutoff, cells, {"subdivision": level})


def healpix(resolution: float = 10.0, cutoff: float = 0.0, nside: int | None = None) -> Grid:
    """HEALPix pixel centres in RING order, from the published formulas."""
    if nside is None:
        estimate = int(math.sqrt(3 / math.pi) * 60 / resolution)
        nside = 2 ** max(0, round(math.log2(estimate))) if estimate else 1
    if nside < 1 or nside & (nside - 1):
        raise ValueError(f"nside must be a power of 2, got {nside}")
    if 12 * nside**2 > 2 * MAX_CELLS:
        raise ValueError(f"nside {nside} exceeds {MAX_CELLS} cells")
    parts = []
    first = 0
    for ring in range(1, 4 * nside):
        polar = min(ring, 4 * nside - ring)
        if polar < nside:
            n, offset = 4 * polar, 0.5
            z = 1 - polar**2 / (3 * nside**2)
            z = z if ring < 2 * nside else -z
        else:
            n, offset = 4 * nside, 0.5 * ((ring - nside + 1) % 2)
            z = 4 / 3 - 2 * ring / (3 * nside)
        phi = (np.arange(n) + offset) * (TWO_PI / n)
        parts.append(
            pd.DataFrame({"ipix": first + np.arange(n), "theta": math.acos(z), "phi": phi})
        )
        first += n
    pix = pd.concat(parts, ignore_index=True)
    pix = pix[pix["theta"] <= HALF_PI - math.radians(cutoff)].reset_index(drop=True)
    half = math.sqrt(4 * math.pi / (12 * nside**2)) / 2
    cells = pd.DataFrame(
        {
            "cell_id": pix["ipix"].astype(np.int32),
            "phi": pix["phi"],
            "theta": pix["theta"],
            "phi_min": np.maximum(0, pix["phi"] - half),
            "phi_max": np.minimum(TWO_PI, pix["phi"] + half),
            "theta_min": np.maximum(0, pix["theta"] - half),
            "theta_max": np.minimum(HALF_PI, pix["theta"] + half),
            "healpix_ipix": pix["ipix"].astype(np.int64),
            "healpix_nside": np.int64(nside),
        }
    )
    return Grid("healpix", resolution, cutoff, cells, {"nside": nside})


def fibonacci(resolution: float = 10.0, cutoff: float = 0.0, n_points: int | None = None) -> Grid:
    """Golden-spiral centres; cells are the Voronoi regions, so bounds stay NULL."""
    if n_points is None:
        n_points = max(10, int(TWO_PI / math.radians(resolution) ** 2))
    i = np.arange(2 * n_points) + 0.5
    theta = np.arccos(1 - 2 * i / (2 * n_points))
    phi = np.mod(TWO_PI * i / ((1 + math.sqrt(5)) / 2), TWO_PI)
    keep = theta <= HALF_PI - math.radians(cutoff)
    cells = pd.DataFrame({"phi": phi[keep], "theta": theta[keep]})
    cells.insert(0, "cell_id", np.arange(len(cells), dtype=np.int32))
    return Grid("fibonacci", resolution, cutoff, cells, {"n_points": n_points})


BUILDERS: dict[str, Callable[..., Grid]] = {
    "equal_area": equal_area,
    "equal_angle": equal_angle,
    "equirectangular": equirectangular,
    "htm": htm,
    "geodesic": geodesic,
    "healpix": healpix,
    "fibonacci": fibonacci,
}


def create_grid(
    kind: str = "equal_area", resolution: float = 10.0, cutoff: float = 0.0,
    phi_rotation: float = 0.0, **kw,
) -> Grid:
    """Build a grid by name; ``phi_rotation`` (degrees) turns it about the zenith."""
    if kind not in BUILDERS:
        raise ValueError(f"unknown grid {kind!r}; one of {sorted(BUILDERS)}")
    grid = BUILDERS[kind](resolution, cutoff, **kw)
    if phi_rotation:
        cells = grid.cells.copy()
        for c in ("phi", "phi_min", "phi_max"):
            if c in cells:
                cells[c] = np.mod(cells[c] + math.radians(phi_rotation), TWO_PI)
        grid = Grid(grid.kind, grid.resolution, grid.cutoff, cells, {**grid.info, "phi_rotation": phi_rotation})
    return grid


def banded_cells(spark: SparkSession, kind: str, resolution: float, cutoff: float = 0.0) -> DataFrame:
    """The equal_area / equal_angle grids generated by Spark itself.

    Bands come from ``range``, sectors from ``explode(sequence)``; used where
    the grid is wanted as a query rather than as a built object.
    """
    res, cut = math.radians(resolution), math.radians(cutoff)
    cap = TWO_PI * (1 - math.cos(res / 2))
    n_edges = _arange_count(res / 2, HALF_PI - cut, res)
    b = spark.range(n_edges).withColumnRenamed("id", "band")
    lo = F.lit(res / 2) + (F.col("band") - 1) * F.lit(res)
    b = b.withColumn("theta_min", F.when(F.col("band") == 0, F.lit(0.0)).otherwise(lo))
    b = b.withColumn("theta_max", F.lit(res / 2) + F.col("band") * F.lit(res))
    if kind == "equal_area":
        omega = F.lit(TWO_PI) * (F.cos("theta_min") - F.cos("theta_max"))
        n = F.greatest(F.lit(1), F.bround(omega / F.lit(cap), 0).cast("int"))
    elif kind == "equal_angle":
        n = F.lit(int(TWO_PI / res))
    else:
        raise ValueError(f"{kind!r} is not a banded grid")
    b = b.withColumn("n", F.when(F.col("band") == 0, F.lit(1)).otherwise(n))
    b = b.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    span = F.lit(TWO_PI) / F.col("n")
    zenith = F.col("band") == 0
    return b.select(
        "band",
        "k",
        F.when(zenith, F.lit(0.0)).otherwise((F.col("k") + F.lit(0.5)) * span).alias("phi"),
        F.when(zenith, F.lit(0.0))
        .otherwise((F.col("theta_min") + F.col("theta_max")) / 2)
        .alias("theta"),
        (F.col("k") * span).alias("phi_min"),
        ((F.col("k") + 1) * span).alias("phi_max"),
        "theta_min",
        "theta_max",
    )


def rectangle_solid_angle() -> Column:
    return (F.col("phi_max") - F.col("phi_min")) * (F.cos("theta_min") - F.cos("theta_max"))


def _dot(a: Column, b: Column) -> Column:
    return sum((a[i] * b[i] for i in (1, 2)), a[0] * b[0])


def triangle_solid_angle(vertices: Column) -> Column:
    """Spherical excess of a triangle by L'Huilier's formula."""
    v = [vertices[i] for i in range(3)]
    side = lambda p, q: F.acos(F.least(F.greatest(_dot(p, q), F.lit(-1.0)), F.lit(1.0)))
    a, b, c = side(v[1], v[2]), side(v[0], v[2]), side(v[0], v[1])
    s = (a + b + c) / 2
    t = F.tan(s / 2) * F.tan((s - a) / 2) * F.tan((s - b) / 2) * F.tan((s - c) / 2)
    return F.lit(4.0) * F.atan(F.sqrt(F.greatest(t, F.lit(0.0))))


def solid_angle_column(grid: Grid) -> Column:
    """Solid angle in sr, by the rule that fits the grid's cells."""
    if grid.kind == "healpix":
        return F.lit(4 * math.pi / (12 * grid.info["nside"] ** 2))
    if grid.kind in ("htm", "geodesic"):
        return triangle_solid_angle(F.col("vertices"))
    if grid.kind == "fibonacci":
        # The lattice is equal-area by construction.
        return F.lit(4 * math.pi / (2 * grid.info["n_points"]))
    return rectangle_solid_angle()


def grid_stats(cells: DataFrame) -> DataFrame:
    """Count, bands and solid-angle spread of a grid with ``solid_angle``."""
    o = F.col("solid_angle")
    return cells.agg(
        F.count(F.lit(1)).alias("total_cells"),
        F.countDistinct(F.round("theta", 9)).alias("theta_bands"),
        F.avg(o).alias("solid_angle_mean_sr"),
        F.stddev_pop(o).alias("solid_angle_std_sr"),
        (F.try_divide(F.stddev_pop(o), F.avg(o)) * 100).alias("solid_angle_cv_percent"),
        F.sum(o).alias("total_solid_angle_sr"),
        F.lit(TWO_PI).alias("hemisphere_solid_angle_sr"),
    )


def vertices_of(cells: DataFrame) -> DataFrame:
    """One row per corner: (cell_id, vertex, x, y, z); corners below the ground are lifted to it."""
    if "vertices" in cells.columns:
        corners = F.transform(
            "vertices",
            lambda v: F.struct(v[0].alias("x"), v[1].alias("y"), F.greatest(v[2], F.lit(0.0)).alias("z")),
        )
    else:
        def corner(t: str, p: str) -> Column:
            return F.struct(
                (F.sin(t) * F.cos(p)).alias("x"), (F.sin(t) * F.sin(p)).alias("y"), F.cos(t).alias("z")
            )

        corners = F.array(
            corner("theta_min", "phi_min"), corner("theta_min", "phi_max"),
            corner("theta_max", "phi_max"), corner("theta_max", "phi_min"),
        )
    return cells.select("cell_id", F.posexplode(corners).alias("vertex", "__v")).select(
        "cell_id", "vertex", "__v.*"
    )


def select_cells(
    cells: DataFrame,
    theta_range: tuple[float, float] | None = None,
    phi_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Cells whose centre lies in the ranges (degrees, inclusive; phi may wrap)."""
    cond = F.lit(True)
    if theta_range is not None:
        cond = cond & F.degrees("theta").between(*map(float, theta_range))
    if phi_range is not None:
        lo, hi = map(float, phi_range)
        p = F.degrees("phi")
        cond = cond & (p.between(lo, hi) if lo <= hi else (p >= lo) | (p <= hi))
    return cells.where(cond)


def grid_hash(grid: Grid) -> str:
    """Short identity of a grid: its kind, resolution and centres."""
    import hashlib

    h = hashlib.sha256()
    h.update(grid.cells["phi"].to_numpy().tobytes())
    h.update(grid.cells["theta"].to_numpy().tobytes())
    h.update(f"{grid.kind}_{grid.resolution}".encode())
    return h.hexdigest()[:16]


def neighbour_edges(grid: Grid, spark: SparkSession) -> DataFrame:
    """(cell_id, neighbor_id): cells whose centres are within 1.5 mean spacings, both directions."""
    centres, ids = grid.centres(), grid.cells["cell_id"].to_numpy()
    reach = 1.5 * math.sqrt(TWO_PI / grid.ncells)
    limit = math.cos(min(reach, math.pi))
    parts = []
    step = max(1, 4_000_000 // len(ids))
    for a in range(0, len(ids), step):
        i, j = np.nonzero(centres[a : a + step] @ centres.T >= limit)
        keep = i + a != j
        parts.append(pd.DataFrame({"cell_id": ids[i[keep] + a], "neighbor_id": ids[j[keep]]}))
    edges = spark.createDataFrame(pd.concat(parts, ignore_index=True))
    return edges.select(F.col("cell_id").cast("int"), F.col("neighbor_id").cast("int"))


def ragged_offsets(parts: DataFrame) -> DataFrame:
    """(cell_id, n, offset): where each cell's rows start when laid end to end."""
    from pyspark.sql import Window

    # One row per cell of a grid.
    before = Window.orderBy("cell_id").rowsBetween(Window.unboundedPreceding, -1)
    n = parts.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
