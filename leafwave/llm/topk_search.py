"""Exact top-k by inner product: M-trees over blocks of vectors, searched best first.

Vectors become integers, floor(1024 * x). With one more coordinate that brings
all vectors of a block to the same length, a larger inner product with a query
is a smaller Euclidean distance, so a metric tree can answer. Every vector is
indexed: rows are dealt to blocks of bounded size by a hash, and each block
becomes a tree of pages. An inner page holds routing objects with covering
radii and their distances to the page's own routing object; a leaf holds
vectors with those distances.

Queries come in blocks too; each pair of a tree and a query block is one group,
bounded on both sides. Every query has its own queue of leaves by the least
distance anything in them can have, which the routing objects above them give.
The queries of a block go through their queues together: each round takes the
next leaves of every queue, twice as many as the round before, and a leaf meets
all queries that want it then in one product. Of a leaf's vectors, sorted by
their stored distances, only those are scored that the triangle inequality
leaves to one of these queries. A query ends when its next leaf is farther than
its k-th best. Bounds carry slack for rounding, scores are exact 64-bit integers,
and ties go to the smaller id, so the answer is that of comparing with every
vector. A window over the few candidates per query and tree ranks them. Nothing
is collected or broadcast.

Vectors that are null, hold null or non-finite components, or components whose
integer is no 64-bit one take no part, nor do rows with null id. Vectors of
different lengths are compared over their common length; an empty one scores 0.
Rows with the query's id are its own and no candidates; other repeated rows
count each. A query id with several vectors is answered for each of them. With
fewer candidates than k all are returned; an empty table gives an empty one.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from leafwave.llm.common import only, saved

SCALE = 1024.0
#: Candidates of a query block that are held before they are ranked.
HELD = 1 << 20
#: Pairs of a query and a page whose bounds are held at once.
BOUNDS = 1 << 22


@dataclass(frozen=True)
class Layout:
    block_rows: int = 20_000
    query_rows: int = 2_000
    page: int = 128
    fan: int = 32


def stacked(vectors) -> np.ndarray:
    """Integer rows of one width, shorter ones filled with zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one point or to each of several."""
    if to.ndim == 1:
        return np.sqrt(((points - to) ** 2).sum(axis=1))
    return np.sqrt(np.stack([((points - t) ** 2).sum(axis=1) for t in to], axis=1))


class MTree:
    """Pages of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, layout: Layout = Layout()):
        self.page, self.fan = layout.page, layout.fan
        self.pages: list[dict] = []
        flat = vectors.astype(np.float64)
        square = (flat**2).sum(axis=1)
        self.reach = float(square.max()) if len(square) else 0.0
        self.width = vectors.shape[1]
        self._ids, self._vectors = ids, vectors
        self._points = np.hstack([flat, np.sqrt(np.maximum(self.reach - square, 0))[:, None]])
        self.centre = self._points.mean(axis=0) if len(ids) else np.zeros(self.width + 1)
        self.root = self._grow(np.arange(len(ids)), self.centre)
        del self._ids, self._vectors, self._points

    def _grow(self, rows: np.ndarray, router: np.ndarray) -> int:
        at = len(self.pages)
        self.pages.append({})
        away = distances(self._points[rows], router)
        if len(rows) <= self.page:
            order = np.argsort(away, kind="stable")
            self.pages[at] = {"ids": self._ids[rows[order]], "vectors": self._vectors[rows[order]], "away": away[order]}
            return at
        # Routing objects are spread over the distances to the page's own.
        chosen = rows[np.argsort(away, kind="stable")[np.linspace(0, len(rows) - 1, self.fan).astype(int)]]
        routers = np.unique(self._points[chosen], axis=0)
        nearest = distances(self._points[rows], routers).argmin(axis=1)
        groups = [rows[nearest == i] for i in range(len(routers))]
        if max(map(len, groups)) == len(rows):  # all alike: cut by count
            routers = np.repeat(routers[nearest[:1]], self.fan, axis=0)
            groups = np.array_split(rows, self.fan)
        full = [i for i, g in enumerate(groups) if len(g)]
        self.pages[at] = {
            "routers": routers[full],
            "radii": np.array([distances(self._points[groups[i]], routers[i]).max() for i in full]),
            "away": distances(routers[full], router),
            "below": [self._grow(groups[i], routers[i]) for i in full],
        }
        return at

    def leaves(self, points: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """The leaves, and per point the least distance of anything in them and bounds of the distance to their routers."""
        squares = (points**2).sum(axis=1)
        # Of a squared distance that is worked out from a product.
        rounding = 4 * (points.shape[1] + 8) * np.finfo(float).eps

        def between(routers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sums = squares[:, None] + (routers**2).sum(axis=1)
            d = sums - 2 * (points @ routers.T)
            return np.sqrt(np.maximum(d - rounding * sums, 0)), np.sqrt(np.maximum(d + rounding * sums, 0))

        found: list[tuple] = []
        near, far = between(self.centre[None, :])
        open_pages = [(self.root, np.zeros(len(points)), near[:, 0], far[:, 0])]
        while open_pages:
            at, least, near, far = open_pages.pop()
            page = self.pages[at]
            if "below" not in page:
                found.append((at, least, near, far))
                continue
            near, far = between(page["routers"])
            lower = np.maximum(near - page["radii"], least[:, None])
            open_pages += [(page["below"][i], lower[:, i], near[:, i], far[:, i]) for i in range(len(page["below"]))]
        at, *bounds = zip(*found)
        return list(at), *[np.stack(x, axis=1) for x in bounds]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries, ids and scores of the ``k`` best of each."""
        most = max(1, BOUNDS // len(self.pages))
        if len(queries) > most:
            parts = [(i, self.search(queries[i : i + most], own[i : i + most], k)) for i in range(0, len(queries), most)]
            return tuple(np.concatenate(x) for x in zip(*[(who + i, ids, scores) for i, (who, ids, scores) in parts]))
        width, n = self.width, len(queries)
        rows = np.zeros((n, width), np.int64)
        rows[:, : min(width, queries.shape[1])] = queries[:, :width]
        points = np.hstack([rows.astype(np.float64), np.zeros((n, 1))])
        lengths = (points**2).sum(axis=1)
        base = lengths + self.reach
        slack = 1e-9 * np.sqrt(base) + 1e-6
        rounding = 4 * (width + 9) * np.finfo(float).eps * base
        # While all sums are integers that a double holds, its products are exact.
        exact = np.float64 if np.sqrt(lengths.max() * self.reach) < 2.0**52 else np.int64
        rows = rows.astype(exact)
        at, least, near, far = self.leaves(points)
        least = least - slack[:, None]
        queue = np.argsort(least, axis=1, kind="stable")
        limit = np.full(n, np.inf)
        worst, worst_id = np.full(n, np.iinfo(np.int64).min), np.full(n, np.iinfo(np.int64).max)
        held = [(np.zeros(0, np.int64),) * 3]
        waiting = 0

        def rank() -> None:
            nonlocal held, waiting
            who, ids, scores = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((ids, -scores, who))
            who, ids, scores = who[order], ids[order], scores[order]
            place = np.arange(len(who)) - np.searchsorted(who, who)
            full = np.flatnonzero(place == k - 1)
            worst[who[full]], worst_id[who[full]] = scores[full], ids[full]
            left = np.maximum(base[who[full]] - 2.0 * scores[full], 0.0)
            limit[who[full]] = np.sqrt(left + rounding[who[full]]) + slack[who[full]]
            held, waiting = [tuple(x[place < k] for x in (who, ids, scores))], 0

        start, ahead = 0, 1
        while start < len(at):
            taken = queue[:, start : start + ahead]
            asks, column = np.nonzero(np.take_along_axis(least, taken, axis=1) <= limit[:, None])
            if not len(asks):
                break
            leaf = taken[asks, column]
            order = np.argsort(leaf, kind="stable")
            asks, leaf = asks[order], leaf[order]
            for asked in np.split(asks, np.flatnonzero(leaf[1:] != leaf[:-1]) + 1):
                number = int(leaf[0])
                leaf = leaf[len(asked) :]
                page = self.pages[at[number]]
                reach = limit[asked] + slack[asked]
                lo = np.searchsorted(page["away"], (near[asked, number] - reach).min())
                hi = np.searchsorted(page["away"], (far[asked, number] + reach).max(), side="right")
                ids = page["ids"][lo:hi]
                scores = (rows[asked] @ page["vectors"][lo:hi].T.astype(exact)).astype(np.int64)
                better = (scores > worst[asked, None]) | ((scores == worst[asked, None]) & (ids < worst_id[asked, None]))
                who, which = np.nonzero(better & (ids != own[asked, None]))
                held.append((asked[who], ids[which], scores[who, which]))
                waiting += len(who)
                if waiting >= HELD:
                    rank()
            rank()
            start, ahead = start + ahead, 2 * ahead
        return held[0]


def integer_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    rows = only(df, vec_id=vec_id, v=vector).where("vec_id is not null and v is not null")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("v", lambda x: F.lit(SCALE) * x.cast("double")).alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(9.2e18)))
    return rows.where(sound).select("vec_id", F.transform("v", lambda x: F.floor(x).cast("long")).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", layout: Layout = Layout()) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of each query."""
    held = saved(integer_vectors(vectors, vec_id, vector))
    asked = saved(integer_vectors(queries, vec_id, vector).distinct())
    n_blocks = max(1, -(-held.count() // layout.block_rows))
    n_query_blocks = max(1, -(-asked.count() // layout.query_rows))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        tree = MTree(rows["vec_id"].to_numpy(np.int64), stacked(list(rows["v"])), layout)
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "tree": [pickle.dumps(tree.__dict__)]})

    dealt = held.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).cast("int"))
    trees = saved(dealt.groupBy("block").applyInPandas(build, "block int, tree binary"))

    def answer(tree_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        if len(tree_rows) and len(query_rows):
            tree = MTree.__new__(MTree)
            tree.__dict__.update(pickle.loads(tree_rows["tree"].iloc[0]))
            own, key = query_rows["vec_id"].to_numpy(np.int64), query_rows["key"].to_numpy(np.int64)
            who, ids, scores = tree.search(stacked(list(query_rows["v"])), own, k)
            return pd.DataFrame({"query_id": own[who], "key": key[who], "vec_id": ids, "score": scores})
        return pd.DataFrame(columns=["query_id", "key", "vec_id", "score"], dtype=np.int64)

    many_trees = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))))
    parts = asked.select("vec_id", "v", F.xxhash64("vec_id", "v").alias("key"))
    parts = parts.withColumn("part", F.pmod("key", F.lit(n_query_blocks)).cast("int"))
    parts = parts.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    found = (
        many_trees.groupBy("block", "part")
        .cogroup(parts.groupBy("block", "part"))
        .applyInPandas(answer, "query_id long, key long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
