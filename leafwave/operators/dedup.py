"""Duplicate detection and resolution at ingest and at read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from leafwave.operators.intervals import containers, inside_any, overlapping

HASH = "rinex_hash"


def skip_reasons(incoming: DataFrame, registry: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``reason``: hash_match, temporal_overlap or ''; without a hash never skipped."""
    keys = list(keys)
    known = registry.select(*keys, HASH).where(F.col(HASH).isNotNull()).distinct().withColumn("__known", F.lit(True))
    meets = (
        overlapping(incoming.where(F.col(HASH).isNotNull()), registry, keys)
        .select(*keys, HASH, "start", "end")
        .distinct()
        .withColumn("__meets", F.lit(True))
    )
    out = incoming.join(known, [*keys, HASH], "left").join(meets, [*keys, HASH, "start", "end"], "left")
    reason = (
        F.when(F.col(HASH).isNull(), "")
        .when(F.col("__known"), "hash_match")
        .when(F.col("__meets"), "temporal_overlap")
        .otherwise("")
    )
    return out.select(*incoming.columns, reason.alias("reason"))


def new_hashes(incoming: DataFrame, registry: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Layer 1: files whose hash the registry lacks."""
    return incoming.join(registry.select(*keys, HASH), [*keys, HASH], "left_anti")


def mark_existing(incoming: DataFrame, registry: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``exists_layer``: hash, store_overlap, batch_container or NULL.

    Files without a hash leave the batch. Each layer looks only at what the
    one before let through.
    """
    keys = list(keys)
    batch = incoming.where(F.col(HASH).isNotNull())
    fresh = new_hashes(batch, registry, keys)
    by_hash = batch.join(registry.select(*keys, HASH), [*keys, HASH], "left_semi")
    stored = overlapping(fresh, registry, keys)
    left = fresh.join(stored.select(*keys, HASH).distinct(), [*keys, HASH], "left_anti")
    inside = containers(left, keys)
    layer = None
    for name, part in (("hash", by_hash), ("store_overlap", stored), ("batch_container", inside)):
        one = part.select(*keys, HASH).distinct().withColumn("exists_layer", F.lit(name))
        layer = one if layer is None else layer.unionByName(one)
    return batch.join(layer, [*keys, HASH], "left")


def batch_actions(marked: DataFrame, strategy: str, group_exists: bool) -> DataFrame:
    """Add ``action`` by the write strategy: initial, written, skipped, appended or overwritten."""
    if strategy not in ("skip", "append", "overwrite"):
        raise ValueError(f"unknown strategy {strategy!r}")
    known = F.col("exists_layer").isNotNull()
    on_known = {
        "skip": F.lit("skipped"),
        "append": F.lit("appended"),
        "overwrite": F.lit("overwritten" if group_exists else "initial"),
    }[strategy]
    fresh = F.lit("written" if group_exists else "initial")
    return marked.withColumn("action", F.when(known, on_known).otherwise(fresh))


def keep_last(rows: DataFrame, keys: Sequence[str] = ("start", "end"), order: str = "written_at") -> DataFrame:
    """The latest row per key; an aggregate, so a hot key is combined map-side."""
    keys = list(keys)
    packed = F.struct(*rows.columns)
    best = rows.groupBy(*keys).agg(F.max_by(packed, order).alias("__r"))
    return best.select("__r.*").select(*rows.columns)


def keep_first(rows: DataFrame, keys: Sequence[str] = ("epoch", "sid"), order: str = "position") -> DataFrame:
    """The row that came first per key."""
    keys = list(keys)
    packed = F.struct(*rows.columns)
    best = rows.groupBy(*keys).agg(F.min_by(packed, order).alias("__r"))
    return best.select("__r.*").select(*rows.columns)


def dedup_read(
    obs: DataFrame, registry: DataFrame | None, keys: Sequence[str] = (), order: str = "position"
) -> DataFrame:
    """Epochs covered by the latest registry row of some (start, end); without a registry the first row of each (keys, epoch, sid)."""
    if registry is None:
        return keep_first(obs, [*keys, "epoch", "sid"], order)
    kept = keep_last(registry, [*keys, "start", "end"])
    return inside_any(obs, kept, keys)


def prepare_overwrite(stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Stored epochs outside every interval about to be written again."""
    return inside_any(stored, incoming, keys, invert=True)


def schema_drift(new: DataFrame, stored: DataFrame) -> dict[str, list[str]]:
    """Variables only the store has (stale) and only the new data has (missing)."""
    return {
        "stale": sorted(set(stored.columns) - set(new.columns)),
        "missing": sorted(set(new.columns) - set(stored.columns)),
    }
