"""Preprocessing steps chained over one table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from leafwave.operators.assign import assign_to
from leafwave.operators.temporal import aggregate_unless_coarse


@dataclass
class StepResult:
    name: str
    parameters: dict
    notes: str = ""

    def to_dict(self) -> dict:
        return {"name": self.name, "parameters": self.parameters, "notes": self.notes}


@dataclass
class Step:
    """A named function from DataFrame to DataFrame with its parameters on record."""

    name: str
    apply: Callable[[DataFrame], DataFrame]
    parameters: dict = field(default_factory=dict)

    def __call__(self, df: DataFrame) -> tuple[DataFrame, StepResult]:
        out = self.apply(df)
        return out, StepResult(self.name, self.parameters, "no-op" if out is df else "")


def temporal_step(freq: str = "1min", method: str = "mean", **kw) -> Step:
    return Step(
        "temporal_aggregate", lambda df: aggregate_unless_coarse(df, freq, method, **kw), {"freq": freq, "method": method}
    )


def grid_step(kind: str = "equal_area", resolution: float = 2.0) -> Step:
    """Cell assignment; a table without angles passes through."""

    def apply(df: DataFrame) -> DataFrame:
        if not {"phi", "theta"} <= set(df.columns):
            return df
        return assign_to(df, kind, resolution)

    return Step("grid_assignment", apply, {"grid": kind, "resolution": resolution})


class Pipeline:
    def __init__(self, *steps: Step) -> None:
        self.steps = list(steps)

    def add(self, step: Step) -> "Pipeline":
        self.steps.append(step)
        return self

    def __call__(self, df: DataFrame) -> tuple[DataFrame, list[StepResult]]:
        results = []
        for step in self.steps:
            df, result = step(df)
            results.append(result)
        return df, results


def default_pipeline(
    freq: str | None = "1min", method: str = "mean", grid: str | None = "equal_area", resolution: float = 2.0
) -> Pipeline:
    """Time binning, then cell assignment; None leaves a step out."""
    out = Pipeline()
    if freq is not None:
        out.add(temporal_step(freq, method))
    if grid is not None:
        out.add(grid_step(grid, resolution))
    return out
