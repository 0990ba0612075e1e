"""Schemas of the tidy tables and the NaN-to-NULL normaliser."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

OBS_SCHEMA = T.StructType(
    [
        T.StructField("receiver", T.StringType(), False),
        T.StructField("epoch", T.TimestampNTZType(), False),
        T.StructField("sid", T.StringType(), False),
        T.StructField("SNR", T.FloatType()),
        T.StructField("Pseudorange", T.DoubleType()),
        T.StructField("Phase", T.DoubleType()),
        T.StructField("Doppler", T.FloatType()),
        T.StructField("LLI", T.ByteType()),
        T.StructField("SSI", T.ByteType()),
    ]
)

OBSERVABLES = ("SNR", "Pseudorange", "Phase", "Doppler", "LLI", "SSI")
GEOMETRY = ("theta", "phi", "r", "clock")

EPHEMERIS_SCHEMA = "epoch timestamp_ntz, sv string, X double, Y double, Z double"
CLOCK_SCHEMA = "epoch timestamp_ntz, sv string, clock_offset double"

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("rinex_hash", T.StringType()),
        T.StructField("start", T.TimestampNTZType()),
        T.StructField("end", T.TimestampNTZType()),
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("commit_msg", T.StringType()),
        T.StructField("written_at", T.TimestampNTZType()),
        T.StructField("write_strategy", T.StringType()),
        T.StructField("attrs", T.StringType()),
        T.StructField("canonical_name", T.StringType()),
        T.StructField("physical_path", T.StringType()),
    ]
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float column.

    Spark aggregates let NaN through and rank it above every number, so it
    must never enter the tables.
    """
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(field.name))
    return df.select(out)


def missing_fields(df: DataFrame, required: tuple[str, ...]) -> list[str]:
    """Names in ``required`` that ``df`` lacks."""
    return [name for name in required if name not in df.columns]


def validate_observations(df: DataFrame, required_vars: tuple[str, ...] = ("SNR",)) -> DataFrame:
    """Raise when an observation table lacks its keys or has wrong key types."""
    problems = [f"missing column {m}" for m in missing_fields(df, ("epoch", "sid") + required_vars)]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if "epoch" in kinds and not isinstance(kinds["epoch"], (T.TimestampNTZType, T.TimestampType)):
        problems.append(f"epoch is {kinds['epoch'].simpleString()}, expected a timestamp")
    if "sid" in kinds and not isinstance(kinds["sid"], T.StringType):
        problems.append(f"sid is {kinds['sid'].simpleString()}, expected string")
    if problems:
        raise ValueError("; ".join(problems))
    return df
