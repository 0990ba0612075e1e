"""Median and MAD of sliding time windows, kept in order while rows come and go.

Rows are dealt by (keys, time block) and sorted in Spark; each block also gets
copies of the rows within one window of its edges. A task then walks a block
once: rows enter and leave a sorted structure as the window moves, the median
is read by position, and the MAD is the middle of two sorted runs, the values
below and above the median, found by bisection without building the deviations.
A row costs the logarithm of its window, and a task holds one block.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

LOAD = 512


class SortedBlocks:
    """A sorted multiset in blocks of bounded length: add, remove, and the i-th smallest."""

    def __init__(self) -> None:
        self.blocks: list[list[float]] = []
        self.largest: list[float] = []
        self.size = 0
        self._ends: list[int] | None = None

    def add(self, x: float) -> None:
        self.size += 1
        self._ends = None
        if not self.blocks:
            self.blocks, self.largest = [[x]], [x]
            return
        k = min(bisect_left(self.largest, x), len(self.blocks) - 1)
        block = self.blocks[k]
        insort(block, x)
        self.largest[k] = block[-1]
        if len(block) > 2 * LOAD:
            self.blocks[k : k + 1] = block[:LOAD], block[LOAD:]
            self.largest[k : k + 1] = block[LOAD - 1], block[-1]

    def remove(self, x: float) -> None:
        self.size -= 1
        self._ends = None
        k = bisect_left(self.largest, x)
        block = self.blocks[k]
        del block[bisect_left(block, x)]
        if block:
            self.largest[k] = block[-1]
        else:
            del self.blocks[k], self.largest[k]

    def __getitem__(self, i: int) -> float:
        if len(self.blocks) == 1:
            return self.blocks[0][i]
        if self._ends is None:
            self._ends = list(accumulate(map(len, self.blocks)))
        k = bisect_right(self._ends, i)
        return self.blocks[k][i - (self._ends[k - 1] if k else 0)]

    def median(self) -> float:
        n = self.size
        return (self[(n - 1) // 2] + self[n // 2]) / 2

    def deviation(self, k: int, middle: float) -> float:
        """The k-th smallest distance from ``middle``, the median."""
        below = self.size // 2  # values at and after this place are not below the median
        above = self.size - below
        lo, hi = max(0, k + 1 - above), min(k + 1, below)
        while lo < hi:  # how many of the k + 1 nearest lie below
            i = (lo + hi) // 2
            if middle - self[below - 1 - i] < self[below + k - i] - middle:
                lo = i + 1
            else:
                hi = i
        best = middle - self[below - lo] if lo else 0.0
        return max(best, self[below + k - lo] - middle) if lo <= k else best

    def mad(self, middle: float) -> float:
        n = self.size
        low = self.deviation((n - 1) // 2, middle)
        return low if n % 2 else (low + self.deviation(n // 2, middle)) / 2


def window_stats(times: list[int], values: list[float], wanted: list[bool], half: int) -> Iterator[tuple[float, float, int]]:
    """Median, MAD and count of [t - half, t + half] for the wanted rows of one series in order of time."""
    held = SortedBlocks()
    lo = hi = 0
    last: tuple[int, tuple[float, float, int]] | None = None
    for i, t in enumerate(times):
        while hi < len(times) and times[hi] <= t + half:
            held.add(values[hi])
            hi += 1
        while times[lo] < t - half:
            held.remove(values[lo])
            lo += 1
        if wanted[i]:
            if last is None or last[0] != t:
                middle = held.median()
                last = t, (middle, held.mad(middle), held.size)
            yield last[1]


def _changes(columns: Sequence[pa.Array], n: int) -> np.ndarray:
    """Rows at which any of the columns differs from the row before."""
    differs = np.zeros(max(0, n - 1), bool)
    for c in columns:
        codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        differs |= codes[1:] != codes[:-1]
    return np.flatnonzero(differs) + 1


def sliding_stats(df: DataFrame, keys: Sequence[str], time: Column, value: str, half: int, block: int) -> DataFrame:
    """``df`` with ``window_median``, ``window_mad`` and ``window_n`` of the rows of its keys within ``half`` of ``time``.

    ``time``, ``half`` and ``block`` are whole numbers of one unit. Keys, time
    and value must not be NULL, the value no NaN.
    """
    keys = list(keys)
    n_keys = len(keys)
    timed = df.withColumn("__t", time.cast("bigint"))
    at = lambda t: F.floor(t / F.lit(block)).cast("bigint")
    spread = timed.withColumn("__block", F.explode(F.sequence(at(F.col("__t") - half), at(F.col("__t") + half))))
    own = F.col("__block") == at(F.col("__t"))
    # A copy carries nothing but what the window needs.
    laid = spread.select(*keys, "__block", "__t", F.col(value).cast("double").alias("__v"), F.when(own, F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("__row"))
    laid = laid.repartition(*keys, "__block").sortWithinPartitions(*keys, "__block", "__t")
    schema = StructType([*df.schema.fields, StructField("window_median", DoubleType()), StructField("window_mad", DoubleType()), StructField("window_n", LongType())])

    def blocks(part: pa.RecordBatch, edges: list[int]) -> pa.RecordBatch:
        t, v = part.column(n_keys + 1).to_pylist(), part.column(n_keys + 2).to_pylist()
        row = part.column(n_keys + 3)
        wanted = row.is_valid().to_pylist()
        stats = [s for lo, hi in zip(edges, edges[1:]) for s in window_stats(t[lo:hi], v[lo:hi], wanted[lo:hi], half)]
        median, mad, n = zip(*stats) if stats else ((), (), ())
        kept = row.filter(row.is_valid()).flatten()
        return pa.RecordBatch.from_arrays([*kept, pa.array(median, pa.float64()), pa.array(mad, pa.float64()), pa.array(n, pa.int64())], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            edges = _changes([whole.column(i) for i in range(n_keys + 1)], len(whole))
            if len(edges):  # the last block may go on in the next batch
                yield blocks(whole.slice(0, edges[-1]), [0, *edges.tolist()])
                held = [whole.slice(edges[-1])]
            else:
                held = [whole]
        if held:
            yield blocks(held[0], [0, len(held[0])])

    return laid.mapInArrow(run, schema)
