"""What a set of stores holds, as a table and as STAC collections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafwave.store.store import ObservationStore


def inventory(spark: SparkSession, roots: Mapping[str, str]) -> DataFrame:
    """One row per store (id -> root): groups, files, time span."""
    out = None
    for store_id, root in roots.items():
        store = ObservationStore(spark, root)
        files = store.registry().where(F.col("action") != "skipped").agg(
            F.countDistinct("rinex_hash").alias("file_count"),
            F.min("start").alias("time_start"), F.max("end").alias("time_end"),
        )
        groups = store.groups().agg(F.sort_array(F.collect_set("group")).alias("groups"))  # receivers of a site
        row = files.withColumn("groups", groups.scalar()).select(
            F.lit(store_id).alias("id"), F.lit(root).alias("path"), "groups", "file_count", "time_start", "time_end"
        )
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no stores given")
    return out


def as_stac(stores: DataFrame, licence: str = "proprietary") -> DataFrame:
    """(id, collection): a STAC collection as JSON per inventory row."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    collection = F.struct(
        F.lit("Collection").alias("type"), F.lit("1.1.0").alias("stac_version"), F.col("id"), F.col("id").alias("title"),
        F.lit("").alias("description"), F.lit(licence).alias("license"),
        F.struct(
            F.struct(F.array(F.array().cast("array<double>")).alias("bbox")).alias("spatial"),
            F.struct(F.array(F.array(stamp("time_start"), stamp("time_end"))).alias("interval")).alias("temporal"),
        ).alias("extent"),
        F.array().cast("array<string>").alias("links"),
    )
    return stores.select("id", F.to_json(collection).alias("collection"))


def shared_groups(a: ObservationStore, b: ObservationStore) -> DataFrame:
    return a.groups().intersect(b.groups())
