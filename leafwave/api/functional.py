"""One call per stage, and the same with parquet in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafwave.api.registry import read_any
from leafwave.functions.timeutil import between
from leafwave.operators.assign import assign_cells
from leafwave.operators.augment import add_geometry
from leafwave.operators.dedup import keep_first
from leafwave.operators.grids import Grid, create_grid
from leafwave.operators.retrieval import calculate_vod
from leafwave.store import ObservationStore

__all__ = [
    "add_geometry", "assign_cells", "assign_cells_to_file", "calculate_vod", "calculate_vod_to_file",
    "compute_vod", "create_grid", "create_grid_to_file", "read_any", "read_to_file",
]


def read_to_file(spark: SparkSession, path: str, out: str, **options) -> str:
    read_any(spark, path, **options).write.mode("overwrite").parquet(out)
    return out


def create_grid_to_file(spark: SparkSession, out: str, kind: str = "equal_area", resolution: float = 2.0, **kw) -> str:
    create_grid(kind, resolution, **kw).with_solid_angles(spark).write.mode("overwrite").parquet(out)
    return out


def assign_cells_to_file(spark: SparkSession, vod_path: str, grid: Grid, out: str) -> str:
    assign_cells(spark.read.parquet(vod_path), grid).write.mode("overwrite").parquet(out)
    return out


def calculate_vod_to_file(spark: SparkSession, canopy: str, reference: str, out: str, **options) -> str:
    vod = calculate_vod(spark.read.parquet(canopy), spark.read.parquet(reference), align=False, **options)
    vod.write.mode("overwrite").parquet(out)
    return out


def compute_vod(
    store: ObservationStore, canopy: str, reference: str, start=None, end=None, date: str | None = None, **options
) -> DataFrame:
    """VOD from two stored groups: one day (``date``, YYYYDOY), a range, or everything.

    The reference stored for this canopy (``<reference>_<canopy>``) is used
    when the plain group is absent. The first row of a repeated (epoch, sid)
    counts; nothing is gathered on the driver.
    """
    if not store.group_exists(reference):
        reference = f"{reference}_{canopy}"
    span = (start, end) if start is not None or end is not None else None

    def side(group: str) -> DataFrame:
        rows = store.read(group, time_range=span, date=date)
        if "rinex_hash" not in rows.columns:
            return keep_first(rows.withColumn("position", F.lit(0))).drop("position")
        # Rows have no position in a table: the file that starts the earliest is "first", then the smaller hash.
        files = store.registry(group).where(F.col("action") != "skipped").groupBy("rinex_hash").agg(F.min("start").alias("__start"))
        order = F.struct(F.coalesce("__start", "epoch"), "rinex_hash")
        return keep_first(rows.join(files, "rinex_hash", "left").withColumn("position", order)).drop("position", "__start")

    return calculate_vod(side(canopy), side(reference), align=options.pop("align", False), **options)


def preview(listing: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Files per (date, receiver) that a run over the date keys would read."""
    rows = listing.where(between("date", start, end))
    return rows.groupBy("date", "receiver").agg(F.count(F.lit(1)).alias("n_files"))
