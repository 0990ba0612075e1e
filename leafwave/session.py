"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter makes one."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("leafwave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the one runtime setting results depend on.

    Epochs are TIMESTAMP_NTZ; converting them to microseconds goes through
    TIMESTAMP, which is only loss-free when the session zone has no DST.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the cluster's, or a new one in local tests."""
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = os.path.join(tempfile.mkdtemp(prefix="leafwave-"), "checkpoints")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def broadcast_checked(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when ``df`` has at most ``max_rows`` rows; otherwise leave the join to Spark.

    Counts at most one row more than the limit. Meant for tables already
    written out or cheap to compute.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
