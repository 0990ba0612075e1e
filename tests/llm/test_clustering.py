"""k-means with bounds against comparing every vector in every round, and the bound against points of the sphere."""

import hashlib

import numpy as np
import pytest

from leafwave.llm import clustering
from leafwave.llm.queries import QUERIES


def brute(rows, k, dims, rounds, seed="3:"):
    sound = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([np.floor(1024 * np.array(v, float)) for _, v in sound], np.int64).reshape(-1, dims)
    starts = sorted((hashlib.sha256(f"{seed}{i}".encode()).hexdigest(), x[n].astype("<i4").tobytes(), n) for n, (i, _) in enumerate(sound) if i is not None)[:k]
    c = np.array([x[n] for _, _, n in starts], np.int64).reshape(-1, dims)
    for turn in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        at = d.argmin(axis=1)
        if turn < rounds:
            c = np.array([[int(s) // int((at == j).sum()) for s in x[at == j].sum(axis=0)] if (at == j).any() else c[j] for j in range(len(c))], np.int64)
    best = d.min(axis=1)
    return [(i, int(at[n]), int(best[n]), int(best[at == at[n]].sum()), int(best.sum()), c[at[n]].tolist()) for n, (i, _) in enumerate(sound)]


def keyed(rows):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_brute_force(spark, sf):
    path = f"/root/testdata/sf{sf}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want = [(*r[:5], hashlib.sha256(",".join(map(str, r[5])).encode()).hexdigest()) for r in brute(rows, 8, 64, 10)]
    got = QUERIES["op13_centroid_clusters"](spark, path)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert keyed(map(tuple, got.collect())) == keyed(want)


def test_odd_vectors_ties_and_empty_clusters(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 150), [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(300)]
    rows += [(None, [0.5, 0.5, 0.5]), (None, [9.0, 9.0, 9.0]), (400, None), (401, [1.0, None, 1.0]), (402, [float("nan")] * 3), (403, [float("inf")] * 3), (404, []), (405, [1.0, 2.0]), (406, [0.1] * 4)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>").selectExpr("*", "'x' AS cluster", "1 AS upper").repartition(5)
    for k, rounds in ((8, 10), (30, 4), (1, 3), (2, 0)):
        assert keyed(map(tuple, clustering.cluster(df, k, 3, rounds).collect())) == keyed(brute(rows, k, 3, rounds)), (k, rounds)
    same = spark.createDataFrame([(i, [1.0, 1.0, 1.0]) for i in range(20)], df.select("vec_id", "embedding").schema)
    assert {(r["cluster"], r["distance"]) for r in clustering.cluster(same, 8, 3).collect()} == {(0, 0)}  # all others stay empty
    few = clustering.cluster(same.limit(3), 8, 3, 2).collect()
    assert len(few) == 3
    empty = clustering.cluster(df.limit(0), 8, 3)
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and empty.collect() == []
    assert clustering.cluster(same.selectExpr("CAST(NULL AS INT) AS vec_id", "embedding"), 8, 3).collect() == []  # none to start with


def test_too_large_components_take_no_part(spark):
    rows = [(1, [0.0, 0.0]), (2, [131_072.0, -131_072.0]), (3, [131_073.0, 0.0]), (4, [1e300, 0.0])]
    got = clustering.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1, 2, 1).collect()
    assert {r["vec_id"] for r in got} == {1, 2} and all(r["distance"] == 2 * (1 << 26) ** 2 for r in got)


@pytest.mark.parametrize("dims", [2, 3, 64])
def test_bound_holds_for_points_of_the_sphere(dims):
    rng = np.random.default_rng(dims)
    less = 0
    for _ in range(400):
        centre, old = rng.normal(size=dims) * 5, rng.normal(size=dims) * 5
        new, radius = old + rng.normal(size=dims) * rng.choice([0.01, 1, 5]), abs(rng.normal()) * 4
        bound = clustering.loosening(centre, radius, old, new)
        way = rng.normal(size=(500, dims))
        points = centre + radius * way / np.linalg.norm(way, axis=1, keepdims=True) * rng.random((500, 1)) ** 0.2
        nearer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
        drift = np.linalg.norm(new - old)
        assert nearer.max() <= bound + 1e-9 and bound <= drift + 1e-12
        less += bound < 0.9 * drift
    assert less > 100


def test_bound_is_tight_in_the_plane():
    """Along the axis nothing is gained, across it the best point of the circle is met."""
    old, new = np.array([-1.0, 0.0]), np.array([1.0, 0.0])
    turn = np.linspace(0, 2 * np.pi, 100_001)
    for centre, radius in (([-3.0, 1.0], 1.0), ([0.0, 4.0], 1.5), ([2.0, 2.0], 0.5), ([0.0, 0.0], 0.3), ([5.0, 0.0], 1.0)):
        p = np.array(centre) + radius * np.stack([np.cos(turn), np.sin(turn)], axis=1)
        most = (np.linalg.norm(p - old, axis=1) - np.linalg.norm(p - new, axis=1)).max()
        assert max(most, 0) - 1e-9 <= clustering.loosening(np.array(centre), radius, old, new) <= max(most, 0) + 1e-4


def test_most_vectors_keep_their_cluster_unseen():
    rng = np.random.default_rng(9)
    middle = rng.integers(-2_000, 2_000, (8, 16))
    x = (middle[rng.integers(8, size=5_000)] + rng.integers(-300, 300, (5_000, 16))).astype(np.int64)
    old = x[rng.choice(5_000, 8, replace=False)]
    zero = np.zeros(8)
    at, up, low, rows = clustering.assign(x, np.full(5_000, -1), np.zeros(5_000), np.zeros(5_000), clustering.Step(old, zero, zero, zero))
    assert len(rows) == 5_000
    looked, fully = [], []
    for _ in range(8):
        new = np.array([x[at == c].sum(axis=0) // max(1, (at == c).sum()) if (at == c).any() else old[c] for c in range(8)])
        step = clustering.Step.between(old, new, np.array([up[at == c].max(initial=0) for c in range(8)]))
        others = [max(step.drift[j] for j in range(8) if j != i) for i in range(8)]
        assert (step.loosen <= np.array(others) + 1e-9).all()
        at, up, low, rows = clustering.assign(x, at, up, low, step)
        assert (at == ((x[:, None] - new[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
        looked.append(len(rows))
        fully.append(5_000)
        old = new
    assert sum(looked) < 0.5 * sum(fully)
