"""Outlier filters over the whole table and per grid cell.

A filter adds ``<var>_filtered_<suffix>`` and ``mask_<suffix>`` (True = keep).
Whole-table statistics enter as scalar subqueries, per-cell statistics as one
aggregate joined back by cell, so no filter holds a group in one task.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from leafwave.operators.quantiles import group_quantiles


class Filter(ABC):
    """A mask over one variable, computed from the whole table."""

    name = "filter"

    @abstractmethod
    def mask(self, df: DataFrame, var: str) -> Column:
        """Boolean column, True = keep."""

    def apply(self, df: DataFrame, var: str = "VOD", suffix: str | None = None) -> DataFrame:
        suffix = suffix or self.name
        keep = F.coalesce(self.mask(df, var), F.lit(False))
        out = df.withColumn(f"mask_{suffix}", keep)
        return out.withColumn(f"{var}_filtered_{suffix}", F.when(F.col(f"mask_{suffix}"), F.col(var)))


def filter_stats(filtered: DataFrame, suffix: str) -> DataFrame:
    """n_total, n_removed and fraction_removed; missing values count as removed."""
    removed = F.sum(F.when(F.col(f"mask_{suffix}"), 0).otherwise(1)).cast("bigint")
    return filtered.agg(F.count(F.lit(1)).alias("n_total"), removed.alias("n_removed")).withColumn(
        "fraction_removed", F.try_divide(F.col("n_removed"), F.col("n_total"))
    )


class ZScoreFilter(Filter):
    """|x - mean| / population std within ``threshold``."""

    name = "zscore"

    def __init__(self, threshold: float = 3.0) -> None:
        self.threshold = threshold

    def mask(self, df: DataFrame, var: str) -> Column:
        stats = df.select(F.struct(F.avg(var).alias("m"), F.stddev_pop(var).alias("s"))).scalar()
        z = F.abs(F.try_divide(F.col(var) - stats["m"], stats["s"]))
        return z <= F.lit(float(self.threshold))


def _global_quantiles(df: DataFrame, var: str, probs: list[float]) -> Column:
    return group_quantiles(df, [], var, probs).select("q").scalar()


class IQRFilter(Filter):
    """Within ``factor`` inter-quartile ranges of the quartiles."""

    name = "iqr"

    def __init__(self, factor: float = 1.5) -> None:
        self.factor = factor

    def mask(self, df: DataFrame, var: str) -> Column:
        q = _global_quantiles(df, var, [0.25, 0.75])
        spread = (q[1] - q[0]) * F.lit(float(self.factor))
        return F.col(var).between(q[0] - spread, q[1] + spread)


class RangeFilter(Filter):
    """Inclusive bounds; without any bound everything, even missing values, is kept."""

    name = "range"

    def __init__(self, min_value: float | None = None, max_value: float | None = None) -> None:
        self.min_value, self.max_value = min_value, max_value

    def mask(self, df: DataFrame, var: str) -> Column:
        keep = F.lit(True)
        if self.min_value is not None:
            keep = keep & (F.col(var) >= F.lit(float(self.min_value)))
        if self.max_value is not None:
            keep = keep & (F.col(var) <= F.lit(float(self.max_value)))
        return keep


class PercentileFilter(Filter):
    """Between two percentiles, inclusive."""

    name = "percentile"

    def __init__(self, lower: float = 5.0, upper: float = 95.0) -> None:
        self.lower, self.upper = lower, upper

    def mask(self, df: DataFrame, var: str) -> Column:
        q = _global_quantiles(df, var, [self.lower / 100, self.upper / 100])
        return F.col(var).between(q[0], q[1])


class CustomFilter(Filter):
    """A callable from Column to boolean Column."""

    def __init__(self, name: str, func: Callable[[Column], Column]) -> None:
        self.name, self.func = name, func

    def mask(self, df: DataFrame, var: str) -> Column:
        return self.func(F.col(var))


class FilterPipeline:
    """Several filters on one variable.

    Every mask is computed on the original variable in both modes. Sequential
    mode also emits the running combination after each filter.
    """

    def __init__(self, var: str = "VOD") -> None:
        self.var = var
        self.filters: list[Filter] = []

    def add(self, f: Filter) -> "FilterPipeline":
        self.filters.append(f)
        return self

    def apply(self, df: DataFrame, mode: str = "sequential", output_name: str | None = None) -> DataFrame:
        if not self.filters:
            raise ValueError("no filters added")
        if mode not in ("sequential", "combined"):
            raise ValueError(f"unknown mode {mode!r}")
        masks = {f.name: F.coalesce(f.mask(df, self.var), F.lit(False)) for f in self.filters}
        out = df.withColumns({f"mask_{n}": m for n, m in masks.items()})
        names, keep = [], F.lit(True)
        final = output_name or "combined"
        for f in self.filters:
            names.append(f.name)
            keep = keep & F.col(f"mask_{f.name}")
            if mode == "sequential":
                out = self._emit(out, "_".join(names), keep)
        if mode == "combined" or output_name:
            out = self._emit(out, final, keep)
        return out

    def _emit(self, df: DataFrame, suffix: str, keep: Column) -> DataFrame:
        return df.withColumn(f"mask_{suffix}", keep).withColumn(
            f"{self.var}_filtered_{suffix}", F.when(keep, F.col(self.var))
        )


class PerCellFilter(ABC):
    """A mask from statistics of each cell's observations.

    Cells below ``min_observations`` are left alone, and rows without a value
    or cell keep the default mask True.
    """

    name = "per_cell"
    needs = 1

    def stats(self, rows: DataFrame, var: str, cell: str) -> DataFrame:
        """Per-cell row count ``__n`` and further statistics, columns prefixed ``__``."""
        return rows.groupBy(cell).agg(F.count(F.lit(1)).alias("__n"))

    @abstractmethod
    def keep(self, var: str) -> Column:
        """Boolean column over ``var`` and the statistics."""

    def apply(
        self, df: DataFrame, var: str = "VOD", cell: str = "cell_id", suffix: str | None = None,
        min_observations: int = 5,
    ) -> DataFrame:
        suffix = suffix or self.name
        rows = df.where(F.col(var).isNotNull() & F.col(cell).isNotNull())
        stats = self.stats(rows, var, cell)
        enough = F.col("__n") >= max(min_observations, self.needs)
        drop = enough & F.col(var).isNotNull() & ~self.keep(var)
        out = df.join(stats, cell, "left")
        mask = ~F.coalesce(drop, F.lit(False))
        return out.select(
            *df.columns,
            mask.alias(f"mask_{suffix}"),
            F.when(mask, F.col(var)).alias(f"{var}_filtered_{suffix}"),
        )


class PerCellIQR(PerCellFilter):
    name, needs = "iqr", 4

    def __init__(self, factor: float = 1.5) -> None:
        self.factor = factor

    def stats(self, rows, var, cell):
        return group_quantiles(rows, [cell], var, [0.25, 0.75], out="__q", count="__n")

    def keep(self, var):
        q = F.col("__q")
        spread = (q[1] - q[0]) * F.lit(float(self.factor))
        return (q[1] == q[0]) | F.col(var).between(q[0] - spread, q[1] + spread)


class PerCellZScore(PerCellFilter):
    name, needs = "zscore", 3

    def __init__(self, threshold: float = 3.0) -> None:
        self.threshold = threshold

    def stats(self, rows, var, cell):
        return rows.groupBy(cell).agg(
            F.count(F.lit(1)).alias("__n"), F.avg(var).alias("__m"), F.stddev_pop(var).alias("__s")
        )

    def keep(self, var):
        z = F.abs(F.try_divide(F.col(var) - F.col("__m"), F.col("__s")))
        return (F.col("__s") == 0) | (z <= F.lit(float(self.threshold)))


class PerCellRange(PerCellFilter):
    name = "range"

    def __init__(self, min_value: float | None = None, max_value: float | None = None) -> None:
        self.range = RangeFilter(min_value, max_value)

    def keep(self, var):
        return self.range.mask(None, var)


class PerCellPercentile(PerCellFilter):
    name, needs = "percentile", 5

    def __init__(self, lower: float = 5.0, upper: float = 95.0) -> None:
        self.lower, self.upper = lower, upper

    def stats(self, rows, var, cell):
        return group_quantiles(rows, [cell], var, [self.lower / 100, self.upper / 100], out="__q", count="__n")

    def keep(self, var):
        return F.col(var).between(F.col("__q")[0], F.col("__q")[1])


class PerCellFilterPipeline:
    """Per-cell filters in a chain.

    Sequential: each filter reads the previous filter's output. Combined: all
    masks on the original variable, ANDed.
    """

    def __init__(self, var: str = "VOD", cell: str = "cell_id") -> None:
        self.var, self.cell = var, cell
        self.filters: list[tuple[PerCellFilter, dict]] = []

    def add(self, f: PerCellFilter, **kw) -> "PerCellFilterPipeline":
        self.filters.append((f, kw))
        return self

    def apply(self, df: DataFrame, mode: str = "sequential", output_name: str | None = None) -> DataFrame:
        if not self.filters:
            raise ValueError("no filters added")
        if mode == "sequential":
            out, current = df, self.var
            for i, (f, kw) in enumerate(self.filters):
                suffix = f"{f.name}_{i}" if i else f.name
                out = f.apply(out, current, self.cell, suffix, **kw)
                target = f"{self.var}_filtered_{suffix}"
                out = out.withColumnRenamed(f"{current}_filtered_{suffix}", target)
                current = target
            return out
        if mode == "combined":
            names, out = [], df
            for f, kw in self.filters:
                out = f.apply(out, self.var, self.cell, f.name, **kw)
                names.append(f.name)
            final = output_name or "_".join(names)
            keep = F.lit(True)
            for n in names:
                keep = keep & F.col(f"mask_{n}")
            return out.select(
                *df.columns,
                keep.alias(f"mask_{final}"),
                F.when(keep, F.col(self.var)).alias(f"{self.var}_filtered_{final}"),
            )
        raise ValueError(f"unknown mode {mode!r}")


def compare_filtering(df: DataFrame, filters: dict[str, PerCellFilter | Filter], var: str = "VOD") -> DataFrame:
    """(method, n_kept, mean, std) of the variable after each filter."""
    out = None
    for name, f in filters.items():
        kept = f.apply(df, var, suffix="m")
        row = kept.agg(
            F.lit(name).alias("method"), F.count(f"{var}_filtered_m").alias("n_kept"),
            F.avg(f"{var}_filtered_m").alias("mean"), F.stddev_samp(f"{var}_filtered_m").alias("std"),
        )
        out = row if out is None else out.unionByName(row)
    return out
