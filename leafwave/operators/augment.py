"""Attaching satellite geometry and clocks to observations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from leafwave.functions.geometry import with_spherical_coords
from leafwave.functions.sids import sid_part
from leafwave.operators.interpolation import clock_interpolate, hermite_interpolate

Augmentation = Callable[[DataFrame], DataFrame]


def _satellite_epochs(obs: DataFrame) -> DataFrame:
    """Distinct (epoch, sv): interpolation runs once for all signals of a satellite."""
    return obs.select("epoch", sid_part("sid", 0).alias("sv")).distinct()


def _attach(obs: DataFrame, values: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    keyed = obs.withColumn("sv", sid_part("sid", 0))
    return keyed.join(values.select("epoch", "sv", *columns), ["epoch", "sv"], how).drop("sv")


def add_geometry(obs: DataFrame, ephem: DataFrame, receiver: tuple[float, float, float]) -> DataFrame:
    """theta, phi and r from interpolated orbits (with velocities); satellites without orbit are dropped."""
    known = ephem.select("sv").distinct()
    wanted = _satellite_epochs(obs).join(known, "sv", "left_semi")
    placed = with_spherical_coords(hermite_interpolate(ephem, wanted), receiver)
    return _attach(obs, placed, ["theta", "phi", "r"], "inner")


def add_clock(obs: DataFrame, clock: DataFrame) -> DataFrame:
    """``clock`` by piecewise-linear interpolation; NULL where undefined."""
    at = clock_interpolate(clock, _satellite_epochs(obs)).withColumnRenamed("clock_offset", "clock")
    return _attach(obs, at, ["clock"], "left")


def add_broadcast_geometry(obs: DataFrame, angles: DataFrame) -> DataFrame:
    """Receiver-reported theta and phi by exact (epoch, sid)."""
    return obs.join(angles.select("epoch", "sid", "theta", "phi"), ["epoch", "sid"], "left")


class Augmenter:
    """Augmentations applied in order."""

    def __init__(self, *steps: Augmentation) -> None:
        self.steps = list(steps)

    def add(self, step: Augmentation) -> "Augmenter":
        self.steps.append(step)
        return self

    def __call__(self, obs: DataFrame) -> DataFrame:
        for step in self.steps:
            obs = step(obs)
        return obs


def nearest_receiver_position(headers: DataFrame) -> DataFrame:
    """Per receiver: the approximate position of its first file (by name) that states one."""
    stated = headers.where(F.col("approx_x").isNotNull())
    at = F.struct("approx_x", "approx_y", "approx_z")
    return stated.groupBy("receiver").agg(F.min_by(at, "path").alias("p")).select("receiver", "p.*")
