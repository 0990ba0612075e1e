"""RINEX files written from the tables and read back through the data source, by time and by header."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from leafwave.plans.base import query
from leafwave.plans.source_queries import HEADER3, SAT_SQL, rinex3_records
from leafwave.session import checkpoint_dir
from leafwave.sources import rinex_source
from leafwave.sources.sbf_source import open_store

FIRST, DAYS = datetime(1990, 1, 1), 50
BETWEEN = datetime(1995, 2, 11), datetime(1996, 7, 3)
RANGE = 50_000
_FOLDERS: dict[tuple[str, str], str] = {}


def files(spark, sf) -> str:
    """Folder of files named by the canonical convention, one per receiver and fifty days; written by Spark tasks once."""
    where = spark.sparkContext.applicationId, sf
    if where not in _FOLDERS:
        folder = f"{checkpoint_dir(spark).rstrip('/')}/leafwave-rinex/{uuid.uuid4().hex}"

        def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            start = FIRST + timedelta(days=DAYS * int(key[1]))
            site = "LEAA01TUW" if key[0] == "canopy" else "LEAR01TUW"
            text = HEADER3 + "".join(f">{r}\n" for r in rows.sort_values("epoch").record)
            store, inside = open_store(folder)
            store.create_dir(inside)
            with store.open_output_stream(f"{inside}/{site}_R_{start:%Y%j}0000_{DAYS}D_01D_AA.rnx") as out:
                out.write(text.encode())
            return pd.DataFrame({"size": [len(text)]})

        _, blocks = rinex3_records(spark, sf)
        day = F.to_timestamp_ntz(F.substring(F.ltrim("record"), 1, 10), F.lit("yyyy MM dd"))
        piece = F.floor(F.datediff(day, F.lit(FIRST.date())) / F.lit(DAYS)).cast("int")
        blocks.select("path", day.alias("epoch"), "record").groupBy("path", piece.alias("piece")).applyInPandas(write, "size bigint").agg(F.sum("size")).collect()
        _FOLDERS[where] = folder
    return _FOLDERS[where]


def _receiver():
    return F.when(F.col("path").contains("LEAA"), "canopy").otherwise("reference").alias("receiver")


@query(
    "rinex_files_between",
    f"""WITH {SAT_SQL} SELECT receiver, epoch, sv || '|' || CASE sys WHEN 'G' THEN 'L1' WHEN 'R' THEN 'G1' WHEN 'E' THEN 'E1' ELSE 'B1C' END || '|C' AS sid,
  round(CAST(CAST(round(SNR,3) AS FLOAT) AS DOUBLE),3) AS SNR, round(code,3) AS Pseudorange FROM v WHERE epoch BETWEEN TIMESTAMP '{BETWEEN[0]}' AND TIMESTAMP '{BETWEEN[1]}'""",
)
def rinex_files_between(spark, sf):
    rows = rinex_source.read_between(spark, files(spark, sf), *BETWEEN, RANGE)
    return rows.select(_receiver(), "epoch", "sid", F.round(F.col("SNR").cast("double"), 3).alias("SNR"), F.round("Pseudorange", 3).alias("Pseudorange"))


@query(
    "rinex_files_summary",
    f"""WITH {SAT_SQL}, f AS (SELECT *, date_diff('day', DATE '{FIRST:%Y-%m-%d}', CAST(epoch AS DATE)) // {DAYS} AS piece FROM v)
SELECT receiver, min(epoch) AS start_time, max(epoch) AS end_time, count(DISTINCT epoch) AS num_epochs, count(DISTINCT sv) AS num_satellites,
  array_to_string(list_sort(list_distinct(list(sys))), '') AS systems FROM f GROUP BY receiver, piece""",
)
def rinex_files_summary(spark, sf):
    rows = rinex_source.read_between(spark, files(spark, sf), range_bytes=RANGE)
    return rinex_source.file_summary(rows).select(_receiver(), "start_time", "end_time", "num_epochs", "num_satellites", F.array_join("systems", "").alias("systems"))
