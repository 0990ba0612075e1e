"""Spherical Voronoi cells of centres on the upper hemisphere.

A cell is the hemisphere cut by the bisectors with its neighbours, and only
centres nearer than twice the cell's farthest corner can cut it. Spark finds
the neighbours: centres lie in bins of rows and azimuth, a cell asks the bins
that its search circle touches, and one equi-join gives each cell its few near
centres. Each cell is then cut on its own, one row a cell. A cell whose corners
show that centres beyond the circle might still cut it asks again with a circle
twice as wide; in an even grid hardly any does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafwave.session import cut_lineage

TWO_PI = 2 * math.pi
#: Corners this near to the ground lie on it.
ON_GROUND = 1e-9
#: The first search circle, in mean spacings of the centres.
FIRST_REACH = 3.0
CORNERS = "vertices array<array<double>>, solid_angle double, is_boundary boolean, settled boolean"


# -- cutting one cell ---------------------------------------------------------------


def cut(corners: np.ndarray, normal: np.ndarray) -> np.ndarray:
    """The part of a convex spherical polygon where ``normal`` . u >= 0 (corners in order, arcs below half a circle)."""
    side = corners @ normal
    if (side >= 0).all():
        return corners
    out = []
    for i, a in enumerate(corners):
        j = (i + 1) % len(corners)
        if side[i] >= 0:
            out.append(a)
        if (side[i] > 0 > side[j]) or (side[i] < 0 < side[j]):
            # Linear in the chord, so the point lies on the arc.
            p = a * abs(side[j]) + corners[j] * abs(side[i])
            out.append(p / np.linalg.norm(p))
    # A bisector from ground to ground is half a circle: its highest point makes two arcs of it.
    whole = []
    for p, q in zip(out, [*out[1:], *out[:1]]):
        whole.append(p)
        if float(p @ q) < ON_GROUND - 1:
            top = np.cross(normal, p)
            top *= 1 if top[2] >= 0 else -1
            whole.append(top / np.linalg.norm(top))
    return np.array(whole).reshape(-1, 3)


def solid_angle(centre: np.ndarray, corners: np.ndarray) -> float:
    """Sum of the triangles between the centre and each edge."""
    total = 0.0
    for a, b in zip(corners, np.roll(corners, -1, axis=0)):
        volume = abs(float(centre @ np.cross(a, b)))
        total += 2 * math.atan2(volume, 1 + float(centre @ a) + float(a @ b) + float(b @ centre))
    return total


def cell_of(centre: np.ndarray, near: np.ndarray, reach: float) -> tuple[np.ndarray, bool]:
    """Corners of a cell from the centres within ``reach``, nearest first, and whether no farther one can change it."""
    corners = np.array([[1.0, 0, 0], [0, 1, 0], [-1, 0, 0], [0, -1, 0]])
    farthest = lambda: float(np.arccos(np.clip(corners @ centre, -1, 1)).max())
    widest = farthest()
    for other in near:
        if math.acos(max(-1.0, min(1.0, float(centre @ other)))) > 2 * widest:
            break
        normal = centre - other
        if normal.any():  # equal centres share their cell
            corners = cut(corners, normal)
            widest = farthest()
    return corners, reach >= math.pi or 2 * widest <= reach


# -- neighbours -------------------------------------------------------------------------


def _row(theta: Column, height: float) -> Column:
    return F.floor(theta / F.lit(height)).cast("int")


def _bins(row: Column, height: float) -> Column:
    """Bins of a row: as wide as the row is high where the row is widest."""
    widest = F.sin(F.least(F.lit(math.pi / 2), (row + 1) * F.lit(height)))
    return F.greatest(F.lit(1), F.floor(F.lit(TWO_PI / height) * widest)).cast("int")


def near_centres(cells: DataFrame, asking: DataFrame, reach: float, height: float) -> DataFrame:
    """``asking`` (cell_id, theta, phi, x, y, z) with ``near``: the other centres within ``reach``, nearest first."""
    turn = F.pmod(F.col("phi"), F.lit(TWO_PI)) / F.lit(TWO_PI)
    points = cells.withColumn("row", _row(F.col("theta"), height)).withColumn("n", _bins(F.col("row"), height))
    points = points.select(
        "row", F.least(F.floor(turn * F.col("n")).cast("int"), F.col("n") - 1).alias("bin"), F.col("cell_id").alias("other"),
        *[F.col(c).alias(f"o{c}") for c in "xyz"],
    )
    theta = F.col("theta")
    rows = F.sequence(F.greatest(F.lit(0), _row(theta - reach, height)), _row(F.least(F.lit(math.pi), theta + reach), height))
    asks = asking.select("cell_id", "theta", turn.alias("turn"), "x", "y", "z", F.explode(rows).alias("row")).withColumn("n", _bins(F.col("row"), height))
    # A circle over a pole meets every azimuth.
    open_circle = (theta > reach) & (theta < math.pi - reach) & F.lit(reach < math.pi / 2)
    half = F.when(open_circle, F.asin(F.least(F.lit(1.0), F.lit(math.sin(reach)) / F.sin(theta))) / TWO_PI).otherwise(F.lit(1.0))
    lo, hi = (F.floor((F.col("turn") + s * half) * F.col("n")).cast("int") for s in (-1, 1))
    wanted = F.when(hi - lo + 1 >= F.col("n"), F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.transform(F.sequence(lo, hi), lambda b: F.pmod(b, F.col("n"))))
    asks = asks.select("cell_id", "x", "y", "z", "row", F.explode(wanted).alias("bin"))
    dot = F.col("x") * F.col("ox") + F.col("y") * F.col("oy") + F.col("z") * F.col("oz")
    met = asks.join(points, ["row", "bin"]).where((F.col("cell_id") != F.col("other")) & (dot >= math.cos(min(reach, math.pi)) - 1e-12))
    near = met.groupBy("cell_id").agg(F.sort_array(F.collect_list(F.struct((-dot).alias("d"), "other", "ox", "oy", "oz"))).alias("near"))
    return asking.join(near, "cell_id", "left")


def _cut_all(asked: DataFrame, reach: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for cell, x, y, z, near in zip(*(b.column(i).to_pylist() for i in range(5))):
                centre = np.array([x, y, z])
                others = np.array([[n["ox"], n["oy"], n["oz"]] for n in near or []]).reshape(-1, 3)
                corners, settled = cell_of(centre, others, reach)
                out.append((cell, corners.tolist(), solid_angle(centre, corners), bool((np.abs(corners[:, 2]) < ON_GROUND).any()), settled))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, (pa.int32(), pa.list_(pa.list_(pa.float64())), pa.float64(), pa.bool_(), pa.bool_()))],
                ["cell_id", "vertices", "solid_angle", "is_boundary", "settled"],
            )

    return asked.select("cell_id", "x", "y", "z", "near").mapInArrow(run, f"cell_id int, {CORNERS}")


def voronoi_cells(centres: DataFrame) -> DataFrame:
    """(cell_id, phi, theta) with the corners, bounds and solid angle of each cell on the upper hemisphere.

    Columns added: ``vertices`` (unit vectors in order), ``n_vertices``,
    ``solid_angle``, ``theta_min``, ``theta_max`` and ``is_boundary`` (the cell
    meets the ground). The solid angles sum to that of the hemisphere; centres
    in the same place share their cell, each with its whole area. A few jobs
    run here: a count, and one round of cutting for each width of the circle.
    """
    t, p = F.col("theta"), F.col("phi")
    cells = centres.select(
        F.col("cell_id").cast("int").alias("cell_id"), "phi", "theta", (F.sin(t) * F.cos(p)).alias("x"), (F.sin(t) * F.sin(p)).alias("y"), F.cos(t).alias("z")
    )
    cells = cut_lineage(cells)
    n = cells.count()
    reach = min(math.pi, FIRST_REACH * math.sqrt(TWO_PI / max(n, 1)))
    height = min(reach, math.pi / 2)
    asking, done = cells, None
    while True:
        found = cut_lineage(_cut_all(near_centres(cells, asking, reach, height), reach))
        settled = found.where("settled")
        done = settled if done is None else done.unionByName(settled)
        if found.where("NOT settled").isEmpty():
            break
        asking = cells.join(found.where("NOT settled").select("cell_id"), "cell_id", "left_semi")
        reach = min(math.pi, 2 * reach)
    heights = F.transform("vertices", lambda v: F.acos(F.least(F.greatest(v[2], F.lit(-1.0)), F.lit(1.0))))
    # The zenith may lie inside a cell, where no corner shows it.
    over = F.forall(F.transform("vertices", lambda v, i: v[0] * F.element_at(F.col("vertices"), F.pmod(i + 1, F.size("vertices")) + 1)[1] - v[1] * F.element_at(F.col("vertices"), F.pmod(i + 1, F.size("vertices")) + 1)[0]), lambda z: z > 0)
    out = done.drop("settled").withColumn("theta_max", F.array_max(heights)).withColumn("theta_min", F.when(over, F.lit(0.0)).otherwise(F.array_min(heights)))
    return centres.select("cell_id", "phi", "theta").join(out.withColumn("n_vertices", F.size("vertices")), "cell_id")
