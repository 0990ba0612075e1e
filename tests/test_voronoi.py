"""Voronoi cells: areas, sampled areas, cutting by every other centre, and few centres in odd places."""

import math

import numpy as np
import pandas as pd
import pytest

from leafwave.operators.grids import create_grid
from leafwave.operators.voronoi import cell_of, solid_angle, voronoi_cells


def unit(pdf):
    t, p = pdf.theta.to_numpy(), pdf.phi.to_numpy()
    return np.column_stack([np.sin(t) * np.cos(p), np.sin(t) * np.sin(p), np.cos(t)])


def cells_of(spark, pdf):
    return voronoi_cells(spark.createDataFrame(pdf)).toPandas().sort_values("cell_id").reset_index(drop=True)


def everything(centres):
    """Each cell cut by all other centres."""
    out = []
    for i, c in enumerate(centres):
        others = np.delete(centres, i, axis=0)
        others = others[np.argsort(-(others @ c), kind="stable")]
        corners, settled = cell_of(c, others, math.pi)
        assert settled
        out.append(solid_angle(c, corners))
    return np.array(out)


@pytest.mark.parametrize("resolution", [30.0, 10.0, 4.0])
def test_fibonacci_areas_fill_the_hemisphere(spark, resolution):
    grid = create_grid("fibonacci", resolution)
    got = cells_of(spark, grid.cells[["cell_id", "phi", "theta"]])
    assert len(got) == grid.ncells and abs(got.solid_angle.sum() - 2 * math.pi) < 1e-9
    if resolution >= 10:
        assert np.allclose(got.solid_angle, everything(unit(got)), atol=1e-12)
        rng = np.random.default_rng(1)
        z, p = rng.random(400_000), rng.random(400_000) * 2 * math.pi
        s = np.sqrt(1 - z * z)
        hit = np.bincount((np.column_stack([s * np.cos(p), s * np.sin(p), z]) @ unit(got).T).argmax(axis=1), minlength=len(got))
        share = got.solid_angle.to_numpy() / (2 * math.pi)
        assert (np.abs(hit / 400_000 - share) < 5 * np.sqrt(share / 400_000)).all()
    edge = got[got.is_boundary]
    assert 0 < len(edge) < len(got) and np.allclose(edge.theta_max, math.pi / 2) and (got[~got.is_boundary].theta_max < math.pi / 2 - 1e-9).all()
    assert (got.n_vertices >= 3).all() and (got.theta_min <= got.theta + 1e-9).all() and (got.theta_max >= got.theta).all()


def test_uneven_centres_ask_again(spark):
    """A crowd in one corner of the sky and a few centres elsewhere, whose cells are far wider than the mean spacing."""
    rng = np.random.default_rng(2)
    crowd = pd.DataFrame({"phi": 1 + rng.normal(size=300) * 0.02, "theta": 1 + rng.normal(size=300) * 0.02})
    few = pd.DataFrame({"phi": [4.0, 2.5, 6.2, 0.0], "theta": [0.4, 1.4, 1.2, math.pi / 2]})
    pdf = pd.concat([crowd, few], ignore_index=True)
    pdf.insert(0, "cell_id", np.arange(len(pdf), dtype=np.int32))
    got = cells_of(spark, pdf)
    assert np.allclose(got.solid_angle, everything(unit(got)), atol=1e-12) and abs(got.solid_angle.sum() - 2 * math.pi) < 1e-9


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_centres(spark, n):
    pdf = pd.DataFrame({"cell_id": np.arange(n, dtype=np.int32), "phi": np.arange(n) * 2.0, "theta": [0.3, 0.9, 1.2][:n]})
    got = cells_of(spark, pdf)
    assert abs(got.solid_angle.sum() - 2 * math.pi) < 1e-9 and got.is_boundary.all()


def test_no_and_equal_centres(spark):
    none = spark.createDataFrame([], "cell_id int, phi double, theta double")
    assert voronoi_cells(none).collect() == []
    pdf = pd.DataFrame({"cell_id": np.array([5, 6, 7], np.int32), "phi": [0.0, 0.0, 3.0], "theta": [0.5, 0.5, 0.5]})
    got = cells_of(spark, pdf)
    assert got.solid_angle[0] == got.solid_angle[1] and abs(got.solid_angle[0] + got.solid_angle[2] - 2 * math.pi) < 1e-9
