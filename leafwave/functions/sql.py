"""The core formulas as SQL functions of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Name and signature -> body.
FUNCTIONS = {
    "vod(canopy DOUBLE, reference DOUBLE, theta DOUBLE) RETURNS DOUBLE": (
        "-ln(pow(10.0D, (canopy - reference) / 10.0D)) * cos(theta)"
    ),
    "sid_sv(sid STRING) RETURNS STRING": "split(sid, '[|]')[0]",
    "sid_band(sid STRING) RETURNS STRING": "get(split(sid, '[|]'), 1)",
    "sid_code(sid STRING) RETURNS STRING": "get(split(sid, '[|]'), 2)",
    "yyyydoy(t TIMESTAMP_NTZ) RETURNS STRING": "date_format(t, 'yyyyDDD')",
    "gps_week(t TIMESTAMP_NTZ) RETURNS INT": "cast(floor(datediff(t, DATE'1980-01-06') / 7) as int)",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session; returns their names."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in FUNCTIONS]
