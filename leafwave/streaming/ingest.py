"""Incremental ingest and binning with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from leafwave.session import broadcast_checked, cut_lineage
from leafwave.sources import rinex3
from leafwave.sources.lines import file_registry
from leafwave.store import ObservationStore


def rinex3_stream(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Stream of (path, record) epoch blocks and headers; a file arrives whole in one batch."""
    raw = (
        spark.readStream.option("lineSep", "\n>").option("maxFilesPerTrigger", max_files).format("text").load(landing)
    )
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("record"))


def ingest_batch(store: ObservationStore, group: str, strategy: str) -> Callable[[DataFrame, int], None]:
    """The per-batch step: parse, hash, decide against the registry, write.

    A replayed batch finds its own hashes in the registry and is skipped, so
    delivery is effectively once.
    """

    def step(records: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in records.select("path").distinct().collect()]  # maxFilesPerTrigger
        if not paths:
            return
        # A batch has at most max_files headers.
        headers = broadcast_checked(cut_lineage(rinex3.parse_header(records)), rinex3.MAX_BROADCAST_FILES)
        obs = rinex3.parse_epochs(records, headers)
        hashes = file_registry(records.sparkSession, paths).select("path", F.col("file_hash").alias("rinex_hash"))
        # Whole paths: receivers reuse names per folder. Only the URI's form (file:/ or file:///) differs.
        place = lambda c: F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:/+|^/+", "/")
        obs = obs.withColumn("__place", place(F.col("path"))).join(
            hashes.select(place(F.col("path")).alias("__place"), "rinex_hash"), "__place"
        )
        store.write_batch(obs.drop("__place"), group, strategy, message=f"batch {batch_id}")

    return step


def ingest(
    spark: SparkSession, landing: str, store: ObservationStore, group: str, checkpoint: str,
    strategy: str = "skip", max_files: int = 1000,
) -> StreamingQuery:
    """Ingest what has landed and stop; run it on a schedule. ``checkpoint`` is a shared folder."""
    return (
        rinex3_stream(spark, landing, max_files)
        .writeStream.foreachBatch(ingest_batch(store, group, strategy))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streaming_aggregate(
    stream: DataFrame, freq: str = "1 minute", watermark: str = "10 minutes",
    keys: Sequence[str] = ("receiver", "sid"), columns: Sequence[str] = ("SNR", "phi", "theta"),
) -> DataFrame:
    """Tumbling mean per (window, keys); bins are final once the watermark passes them."""
    # Watermarks need TIMESTAMP; session zone UTC makes the cast exact.
    timed = stream.withColumn("epoch", F.col("epoch").cast("timestamp")).withWatermark("epoch", watermark)
    out = timed.groupBy(F.window("epoch", freq), *keys).agg(*[F.avg(c).alias(c) for c in columns])
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("epoch"), *keys, *columns)


def drop_repeated_files(stream: DataFrame, watermark: str = "30 days") -> DataFrame:
    """First arrival of each (rinex_hash, epoch, sid) within the watermark."""
    timed = stream.withColumn("epoch", F.col("epoch").cast("timestamp")).withWatermark("epoch", watermark)
    return timed.dropDuplicatesWithinWatermark(["rinex_hash", "epoch", "sid"])
