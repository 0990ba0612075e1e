"""Stored and fresh grids assign alike."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafwave.operators.assign import assign_cells
from leafwave.operators.grids import BUILDERS, create_grid, grid_hash
from leafwave.store import ObservationStore


@pytest.fixture(scope="module")
def directions(spark):
    rng = np.random.default_rng(12)
    n = 3000
    pdf = pd.DataFrame({"id": range(n), "theta": np.arccos(rng.random(n)), "phi": rng.random(n) * 4 * math.pi - math.pi})
    corners = pd.DataFrame([(n + i, t, p) for i, (t, p) in enumerate([(0.0, 0.0), (math.pi / 2, 0.0), (math.pi / 2, 2 * math.pi), (1.0, 0.0), (3.0, 1.0)])], columns=pdf.columns)
    df = spark.createDataFrame(pd.concat([pdf, corners]))
    return df.unionByName(spark.createDataFrame([(-1, None, 1.0), (-2, 1.0, None)], df.schema)).withColumn("cells", F.lit("x"))


@pytest.mark.parametrize("kind", sorted(BUILDERS))
def test_assigns_as_it_did_when_written(spark, directions, tmp_path, kind):
    store = ObservationStore(spark, str(tmp_path / "s"))
    grid = create_grid(kind, 15.0, phi_rotation=7.0 if kind != "htm" else 0.0)
    name = store.store_grid(grid)
    stored = ObservationStore(spark, str(tmp_path / "s")).load_grid(name)
    assert (stored.kind, stored.ncells, stored.grid_hash, stored.name) == (kind, grid.ncells, grid_hash(grid), grid.name)
    fresh, again = ({r["id"]: r[grid_column] for r in f(directions).collect()} for grid_column, f in ((f"cell_id_{grid.name}", lambda d: assign_cells(d, grid)), (f"cell_id_{grid.name}", stored.assign)))
    assert fresh == again and fresh[-1] is None and fresh[-2] is None and len(set(fresh.values())) > grid.ncells // 2
    assert stored.cells().count() == grid.ncells and stored.assign(directions.limit(0)).collect() == []
    assert stored.assign(directions).columns == [*directions.columns, f"cell_id_{grid.name}"]


def test_overwritten_and_missing(spark, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "s"))
    store.store_grid(create_grid("equal_area", 20.0), "g")
    store.store_grid(create_grid("fibonacci", 30.0), "g")
    assert store.load_grid("g").kind == "fibonacci"
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        store.load_grid("none")
