import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafwave.operators.assign import assign_by_table, assign_cells
from leafwave.operators.grids import BUILDERS, banded_cells, create_grid, grid_stats, select_cells, vertices_of
from leafwave.operators.masks import SpatialMask

KINDS = sorted(BUILDERS)


@pytest.mark.parametrize(
    "kind,counts",
    [
        ("equal_area", {2: 6448, 5: 1005, 10: 240, 15: 101, 30: 22}),
        ("equal_angle", {2: 7921, 5: 1225, 10: 289, 15: 121, 30: 25}),
        ("equirectangular", {2: 8100, 5: 1296, 10: 324, 15: 144, 30: 39}),
    ],
)
def test_cell_counts(kind, counts):
    for res, n in counts.items():
        assert create_grid(kind, res).ncells == n


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(42)
    theta = np.arccos(rng.uniform(0, 1, 3000))
    phi = rng.uniform(0, 2 * math.pi, 3000)
    edge = [(0.0, 0.0), (0.0, 3.0), (math.pi / 2, 1.0), (1.0, 0.0), (1.0, 2 * math.pi - 1e-9), (1.0, 2 * math.pi)]
    theta = np.append(theta, [e[0] for e in edge])
    phi = np.append(phi, [e[1] for e in edge])
    pdf = pd.DataFrame({"i": np.arange(len(theta)), "theta": theta, "phi": phi})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def brute_force(grid, pdf):
    v = np.column_stack(
        [np.sin(pdf.theta) * np.cos(pdf.phi), np.sin(pdf.theta) * np.sin(pdf.phi), np.cos(pdf.theta)]
    )
    dots = np.round(v @ grid.centres().T, 12)
    return grid.cells["cell_id"].to_numpy()[dots.argmax(axis=1)], dots


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("options", [{}, {"cutoff": 12.0}, {"phi_rotation": 33.0}])
def test_assignment_matches_brute_force(points, kind, options):
    pdf, df = points
    for res in (4.0, 10.0, 30.0):
        grid = create_grid(kind, res, **options)
        want, dots = brute_force(grid, pdf)
        for fn in (assign_cells, assign_by_table):
            got = fn(df, grid, "cell").orderBy("i").toPandas()["cell"].to_numpy()
            differ = np.nonzero(got != want)[0]
            # Only ties at the twelfth digit may differ.
            index = {c: j for j, c in enumerate(grid.cells["cell_id"])}
            for d in differ:
                assert abs(dots[d, index[got[d]]] - dots[d].max()) <= 2e-12


def test_missing_angles_have_no_cell(spark):
    df = spark.createDataFrame([(None, 1.0), (0.5, None), (0.5, 1.0)], "theta double, phi double")
    for kind in ("equal_area", "htm"):
        cells = [r["c"] for r in assign_cells(df, create_grid(kind, 10), "c").collect()]
        assert cells[0] is None and cells[1] is None and cells[2] is not None


@pytest.mark.parametrize("kind", ["equal_area", "equal_angle"])
def test_spark_generated_bands_equal_the_builder(spark, kind):
    built = create_grid(kind, 10).cells
    made = banded_cells(spark, kind, 10).orderBy("band", "k").toPandas()
    for c in ("phi", "theta", "phi_min", "phi_max", "theta_min", "theta_max"):
        assert np.allclose(built[c], made[c])


@pytest.mark.parametrize("kind", ["htm", "geodesic", "healpix"])
def test_solid_angles_cover_the_sphere(spark, kind):
    # A cutoff of -90 degrees keeps every cell of the sphere.
    stats = grid_stats(create_grid(kind, 10, cutoff=-90).with_solid_angles(spark)).first()
    assert stats["total_solid_angle_sr"] == pytest.approx(4 * math.pi, rel=1e-9)


@pytest.mark.parametrize("kind", ["equal_area", "equal_angle", "fibonacci"])
def test_solid_angles_cover_the_hemisphere(spark, kind):
    # Bands stop short of the horizon by less than one resolution.
    stats = grid_stats(create_grid(kind, 2).with_solid_angles(spark)).first()
    assert 2 * math.pi * (1 - math.sin(math.radians(2))) <= stats["total_solid_angle_sr"] <= 2 * math.pi + 1e-9


def test_vertices_and_selection(spark):
    htm = create_grid("htm", 15).to_df(spark)
    v = vertices_of(htm)
    assert v.count() == 3 * htm.count() and v.where("z < 0").count() == 0
    cells = create_grid("equal_area", 10).to_df(spark)
    assert vertices_of(cells).count() == 4 * cells.count()
    sel = select_cells(cells, (0, 30), (350, 10))
    assert sel.where(F.degrees("theta") > 30).count() == 0 and 0 < sel.count() < cells.count()


def test_mask_modes(spark):
    cells = create_grid("equal_area", 10).to_df(spark)
    m = SpatialMask().phi_range(350, 10).theta_range(0, 40)
    both = m.compute(cells, "AND").where("keep").count()
    either = m.compute(cells, "OR").where("keep").count()
    assert 0 < both < either
    with pytest.raises(ValueError):
        SpatialMask().compute(cells)
