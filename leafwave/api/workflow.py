"""Deferred workflow: steps are noted down and run when a result is asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafwave.api.registry import read_any
from leafwave.operators import augment
from leafwave.operators.assign import assign_to
from leafwave.operators.pipeline import Pipeline
from leafwave.operators.retrieval import calculate_vod
from leafwave.store import ObservationStore

Tables = dict[str, DataFrame]


class Workflow:
    """read -> preprocess -> augment -> grid -> vod over named receivers.

    Each step maps a dict of tables to another. Spark plans the whole chain at
    once, so nothing runs before ``result`` is used.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.plan: list[tuple[str, Callable[[Tables], Tables]]] = []

    def _step(self, label: str, fn: Callable[[Tables], Tables]) -> "Workflow":
        self.plan.append((label, fn))
        return self

    def read(self, receiver: str, path: str, reader: str | None = None, **options) -> "Workflow":
        def run(t: Tables) -> Tables:
            df = read_any(self.spark, path, reader, **options)
            old = t.get(receiver)
            return {**t, receiver: df if old is None else old.unionByName(df, allowMissingColumns=True)}

        return self._step(f"read({receiver}, {path})", run)

    def table(self, receiver: str, df: DataFrame) -> "Workflow":
        return self._step(f"table({receiver})", lambda t: {**t, receiver: df})

    def preprocess(self, pipeline: Pipeline) -> "Workflow":
        return self._step("preprocess", lambda t: {k: pipeline(v)[0] for k, v in t.items()})

    def augment(self, ephem: DataFrame, position: tuple[float, float, float], clock: DataFrame | None = None) -> "Workflow":
        def run(t: Tables) -> Tables:
            out = {k: augment.add_geometry(v, ephem, position) for k, v in t.items()}
            return out if clock is None else {k: augment.add_clock(v, clock) for k, v in out.items()}

        return self._step("augment", run)

    def grid(self, kind: str = "equal_area", resolution: float = 2.0) -> "Workflow":
        return self._step(
            f"grid({kind}, {resolution:g})", lambda t: {k: assign_to(v, kind, resolution) for k, v in t.items()}
        )

    def vod(self, canopy: str, reference: str, calculator: str = "tau_omega_zeroth", **options) -> "Workflow":
        return self._step(
            f"vod({canopy}, {reference})",
            lambda t: {**t, "vod": calculate_vod(t[canopy], t[reference], calculator, **options)},
        )

    def result(self, name: str = "vod") -> DataFrame:
        tables: Tables = {}
        for _, fn in self.plan:
            tables = fn(tables)
        self.plan = []
        return tables[name]

    def to_store(self, store: ObservationStore, group: str, name: str = "vod") -> str:
        return store.append(self.result(name), group)

    def explain(self) -> list[str]:
        """Pending steps, in order."""
        return [label for label, _ in self.plan]
