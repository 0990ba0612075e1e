"""k-means in exact integers, with bounds that geometry loosens less than the centroids drift.

Vectors become integers, floor(1024 * x). Each keeps its centroid's number, an
upper bound of the distance to that centroid and a lower bound of the distance
to every other one. When the centroids have moved, the upper bound grows by the
drift of its centroid. The lower bound would have to give way by the largest
drift of any other centroid, were nothing known of where the vectors are; but
those of a cluster lie in a sphere around its centroid, so it gives way only by
the most that a point of that sphere can have come nearer to a moved centroid.

That is a question in the plane through the sphere's centre, the old and the
new place of the other centroid. Points that came nearer by 2m or more fill one
branch of a hyperboloid with the two places as foci. The branch is convex, so
where a line separates it from the sphere no point of the sphere came nearer by
2m. For a line at any angle the smallest such m has a closed form; the least
over many angles is the bound, and each angle alone would do.

A vector whose upper bound is below its lower bound, or below half the way to
the nearest other centroid, keeps its cluster unseen. Others get an exact
distance first, and those still ambiguous are compared with every centroid in
64-bit integers, ties to the smaller number. Bounds carry slack for rounding,
so the result is that of comparing every vector in every round.

A round is one pass that writes vectors and bounds anew, together with each
batch's changes to the sums of its clusters, whose total is one row per cluster
and component; that and the centroids are all the driver sees. The table
before last is deleted, so two are kept, and a lost executor costs its tasks of
the running round. ``k`` times the components has to fit the driver.

Vectors that are null, of another length or hold null or non-finite components
take no part, nor do those with a component beyond 2**27 after scaling, whose
distances could pass 64 bits. Rows with a null id are clustered but never start
as centroids; repeated rows count each, and repeated ids start in the order of
their vectors. With fewer rows to start with than ``k`` there are fewer
clusters. Other columns are never looked at. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from leafwave.llm.common import only, remove, saved_at

SCALE = 1024.0
LARGEST = 1 << 27
#: Angles tried for a separating line.
ANGLES = np.linspace(-np.pi / 2, np.pi / 2, 2049)
#: Relative slack of comparisons between bounds.
SLACK = 1e-9


# -- geometry -------------------------------------------------------------------


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """Bound of how much nearer to ``new`` than to ``old`` a point within ``radius`` of ``centre`` can be."""
    drift = float(np.linalg.norm(new - old))
    if drift == 0:
        return 0.0
    axis = (new - old) / drift
    relative = centre - (old + new) / 2
    along = float(relative @ axis)
    across = float(np.sqrt(max(0.0, float(relative @ relative) - along * along)))
    reach = np.maximum(0.0, along * np.cos(ANGLES) + across * np.sin(ANGLES) + radius)
    nearest = np.sqrt((reach**2 + (drift / 2 * np.sin(ANGLES)) ** 2).min())
    return min(drift, 2 * float(nearest))


@dataclass(frozen=True)
class Step:
    """What a round needs to know of the centroids: where they are, and how bounds change with their last move."""

    centroids: np.ndarray
    drift: np.ndarray
    loosen: np.ndarray
    halfway: np.ndarray

    @classmethod
    def between(cls, old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Step:
        a, b, k = old.astype(float), new.astype(float), len(old)
        loosen = [max([loosening(a[i], radius[i], a[j], b[j]) for j in range(k) if j != i], default=0.0) for i in range(k)]
        apart = np.linalg.norm(b[:, None] - b[None], axis=2) + np.diag([np.inf] * k)
        return cls(new, np.linalg.norm(b - a, axis=1), np.array(loosen), apart.min(axis=1) / 2)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    gap = vectors - centroid
    return np.einsum("nd,nd->n", gap, gap)


def assign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, step: Step) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """New cluster, upper and lower bound of each vector, and which of them were compared with every centroid."""
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    known = cluster >= 0
    upper[known] += step.drift[cluster[known]]
    lower[known] -= step.loosen[cluster[known]]

    def open_rows(rows: np.ndarray) -> np.ndarray:
        bound = np.maximum(lower[rows], step.halfway[cluster[rows]])
        return rows[upper[rows] * (1 + SLACK) + SLACK >= bound * (1 - SLACK)]

    rows = open_rows(np.flatnonzero(known))
    upper[rows] = np.sqrt(squared(x[rows], step.centroids[cluster[rows]]))
    rows = np.concatenate([np.flatnonzero(~known), open_rows(rows)])
    if len(rows):
        all_distances = np.stack([squared(x[rows], c) for c in step.centroids], axis=1)
        cluster[rows] = all_distances.argmin(axis=1)
        nearest = np.sort(all_distances, axis=1)
        upper[rows] = np.sqrt(nearest[:, 0])
        lower[rows] = np.sqrt(nearest[:, 1]) if len(step.centroids) > 1 else np.inf
    return cluster, upper, lower, rows


# -- passes ---------------------------------------------------------------------


def integers(vectors: DataFrame, dims: int) -> DataFrame:
    """vec_id and the integers of each vector that takes part, as little-endian 32-bit values."""
    id_type = vectors.schema["vec_id"].dataType
    sound = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > LARGEST / SCALE))
    kept = vectors.where((F.size("embedding") == dims) & ~sound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.floor(SCALE * b.column(1).flatten().to_numpy(zero_copy_only=False).astype(float)).astype("<i4")
            width = 4 * dims
            whole = x.tobytes()
            rows = pa.array([whole[i * width : (i + 1) * width] for i in range(len(b))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), rows], ["vec_id", "vector"])

    return kept.mapInArrow(run, f"vec_id {id_type.simpleString()}, vector binary")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def round_of(state: DataFrame, step: Step, dims: int) -> DataFrame:
    """The rows of ``state`` under the centroids of ``step``, and each batch's changes: rows without a vector that hold a
    cluster's largest upper bound and what came to its number of rows and sums."""
    id_type = to_arrow_type(state.schema["vec_id"].dataType)
    names = ["vec_id", "vector", "cluster", "upper", "lower", "sums"]
    types = [id_type, pa.binary(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int64())]

    def changes(x, before, cluster, upper):
        moved = before != cluster
        for c in np.unique(np.concatenate([before[moved], cluster])):
            if c >= 0:
                came, left = x[moved & (cluster == c)], x[moved & (before == c)]
                here = upper[cluster == c]
                yield int(c), float(here.max()) if len(here) else 0.0, [len(came) - len(left), *(came.sum(axis=0) - left.sum(axis=0)).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x = matrix(b.column(1), dims)
            before, upper, lower = (b.column(i).to_numpy() for i in (2, 3, 4))
            cluster, upper, lower, _ = assign(x, before, upper, lower, step)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower), pa.nulls(len(b), types[5])], names)
            told = list(changes(x, before, cluster, upper))
            if told:
                number, most, sums = zip(*told)
                n = len(told)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, id_type), pa.nulls(n, pa.binary()), pa.array(number, pa.int32()), pa.array(most), pa.nulls(n, pa.float64()), pa.array(sums, types[5])], names)

    return state.mapInArrow(run, f"vec_id {state.schema['vec_id'].dataType.simpleString()}, vector binary, cluster int, upper double, lower double, sums array<long>")


def nearest(state: DataFrame, centroids: np.ndarray, dims: int) -> DataFrame:
    """vec_id, cluster and exact squared distance of the rows of an assigned ``state``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster = b.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(squared(matrix(b.column(1), dims), centroids[cluster]))], ["vec_id", "cluster", "distance"])

    rows = state.where("vector IS NOT NULL").select("vec_id", "vector", "cluster")
    return rows.mapInArrow(lambda bs: run(pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2)], ["a", "b", "c"]) for b in bs if len(b)), f"vec_id {state.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = 8, dims: int = 64, rounds: int = 10, seed: str = "3:") -> DataFrame:
    """Per vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid (its components)."""
    spark = vectors.sparkSession
    start = integers(only(vectors, vec_id="vec_id", embedding="embedding"), dims)
    state, path = saved_at(start.select("*", F.lit(-1).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"), F.lit(None).cast("array<long>").alias("sums")))
    by_hash = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = state.where("vec_id IS NOT NULL").orderBy(by_hash, "vector").limit(k).select("vector").collect()
    centroids = np.array([np.frombuffer(r["vector"], "<i4") for r in first], np.int64).reshape(-1, dims)
    k = len(centroids)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    if not k:
        remove(spark, path)
        empty = [F.lit(None).cast(t).alias(c) for c, t in zip(columns[1:], ("int", "long", "long", "long", "array<long>"))]
        return vectors.select(F.col("`vec_id`").alias("vec_id"), *empty).where(F.lit(False))
    step = Step(centroids, np.zeros(k), np.zeros(k), np.zeros(k))
    counts, sums = [0] * k, [[0] * dims for _ in range(k)]
    for turn in range(rounds + 1):
        before = path
        state, path = saved_at(round_of(state.where("vector IS NOT NULL"), step, dims))
        remove(spark, before)
        if turn == rounds:
            break
        told = state.where("vector IS NULL")
        radius = np.zeros(k)
        for r in told.groupBy("cluster").agg(F.max("upper").alias("most")).collect():
            radius[r["cluster"]] = r["most"]
        for r in told.select("cluster", F.posexplode("sums").alias("at", "more")).groupBy("cluster", "at").agg(F.sum("more").alias("more")).collect():
            if r["at"]:
                sums[r["cluster"]][r["at"] - 1] += r["more"]
            else:
                counts[r["cluster"]] += r["more"]
        moved = np.array([[s // n for s in sums[c]] if n else centroids[c].tolist() for c, n in enumerate(counts)], np.int64)
        step, centroids = Step.between(centroids, moved, radius), moved
    out, _ = saved_at(nearest(state, centroids, dims))
    remove(spark, path)
    per = {r["cluster"]: r["inertia"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    told = [(c, per[c], sum(per.values()), centroids[c].tolist()) for c in per]
    final = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return out.join(F.broadcast(final), "cluster").select(*columns)
