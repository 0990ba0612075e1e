"""Binary receiver files, checked by packing the event table into blocks and reading the files back in byte ranges.

Every event becomes one measurement epoch with a GPS signal, its second signal
and a GLONASS signal, and by its number the status blocks before it. A file
holds 2,000 events, tells its leap seconds and frequency numbers once, and is
cut into ranges, so most ranges get both from a neighbour.
"""

from __future__ import annotations

import binascii
import struct
import uuid

import pandas as pd
from pyspark.sql import functions as F

from leafwave.functions.timeutil import micros
from leafwave.plans.base import query, rounded, table
from leafwave.session import checkpoint_dir
from leafwave.sources import sbf
from leafwave.sources.sbf_source import open_store

EVENTS_PER_FILE, RANGE = 2_000, 100_000
GPS_EPOCH, LEAP, WEEK_MS = 315_964_800, 18, 604_800_000
_FOLDERS: dict[tuple[str, str], str] = {}


def pack_block(number: int, tow: int, week: int, body: bytes) -> bytes:
    payload = struct.pack("<HIH", 0, tow, week) + body
    payload += b"\0" * (-(len(payload) + 6) % 4)
    payload = struct.pack("<HH", number, len(payload) + 6) + payload[2:]
    return b"$@" + struct.pack("<H", binascii.crc_hqx(payload, 0)) + payload


def pack_event(e: int, u: int, v: int, ms: int, first: bool) -> bytes:
    """The blocks of one event."""
    week, tow = divmod(ms - GPS_EPOCH * 1000 + LEAP * 1000, WEEK_MS)
    g, r = u % 37 + 1, u % 24 + 38
    out = []
    add = lambda number, body: out.append(pack_block(number, tow, week, body))
    if first:
        add(5914, struct.pack("<bbbbbbbB", 0, 0, 0, 0, 0, 0, LEAP, 7))
        add(4013, struct.pack("<BBB3x", 24, 12, 8) + b"".join(struct.pack("<BB2xHHbBBx", s, 1 + s % 14, 0, 0, 0, 0, 0) for s in range(38, 62)))
    if e % 3 == 0:
        add(4001, struct.pack("<BBHHHH", 9, 0, e % 500, 0, e % 400, e % 300))
    if e % 4 == 0:
        accuracy = 65_535 if e % 7 == 0 else e % 1000
        add(4007, struct.pack("<BBddd34xBBHHIBBHHHHH", e % 11, 0, 0.8, 0.3, 250.0, u % 30, 0, 0, v, 0, 0, 0, 0, 0, accuracy, e % 900, 0))
    if e % 5 == 0:
        add(4014, struct.pack("<BBIIIBBBB", e % 100, 0, 0, 0, e % 64, 0, 0, 0, e % 60 + 80 if e % 20 else 0))
    if e % 3 != 1:
        rows = [(g, e * 37 % 36_000, v % 9_000), (r, e * 11 % 36_000, e % 9_000)]
        add(4012, struct.pack("<BB", 2, 8) + b"".join(struct.pack("<BBHhBB", s, 0, a, el, (0, 1, 255)[e % 5 % 3], 0) for s, a, el in rows))
    if e % 2 == 0:
        told = (v - 100, e % 200 - 100, 65_535 if e % 5 == 0 else v, 65_535 if e % 9 == 0 else e % 300, 65_535 if e % 11 == 0 else e % 1000, e % 256, e % 256 - 128, 0, e % 8 + 16)
        add(4000, struct.pack("<BBf", 3, 16, 1.0) + b"".join(struct.pack("<BBhhHHHBbBB", c, s, *told) for c, s in ((3, 0), (3, 3), (4, 8))))
    both = (0, v * 1000 - 200_000, v % 65_536, e % 100, 255 if v % 7 == 0 else v % 200)
    master = lambda channel, kind, svid, n2: struct.pack("<BBBBIiHbBHBB", channel, kind, svid, 5, (e * 1000 + v) % 2**32, *both[1:], 9, 0, n2)
    slave = struct.pack("<BBBBbBHHH", 3, 9, 120, 0b11110_111, 1, 0, (e * 1000 + v) % 60_000, 2_000, 100)
    add(4027, struct.pack("<BBBBBB", 2, 20, 12, 0, 0, 0) + master(3, 0, g, 1) + slave + master(4, 8, r, 0))
    return b"".join(out)


def files(spark, sf) -> str:
    """Folder of the packed files, written by Spark tasks once per session and data folder."""
    where = spark.sparkContext.applicationId, sf
    if where not in _FOLDERS:
        folder = f"{checkpoint_dir(spark).rstrip('/')}/leafwave-sbf/{uuid.uuid4().hex}"

        def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("e")
            data = b"".join(pack_event(e, u, v, ms, i == 0) for i, (e, u, v, ms) in enumerate(zip(rows.e, rows.u, rows.v, rows.ms)))
            store, inside = open_store(folder)
            store.create_dir(inside)
            with store.open_output_stream(f"{inside}/{key[0]}.sbf") as out:
                out.write(data)
            return pd.DataFrame({"size": [len(data)]})

        events = table(spark, sf, "events").select(
            F.col("event_id").alias("e"), F.col("user_id").alias("u"), F.floor("value").cast("bigint").alias("v"), F.floor(micros("ts") / 1000).cast("bigint").alias("ms"),
        )
        events.groupBy(F.floor(F.col("e") / EVENTS_PER_FILE).cast("bigint").alias("file")).applyInPandas(write, "size bigint").agg(F.sum("size")).collect()
        _FOLDERS[where] = folder
    return _FOLDERS[where]


def raw(spark, sf, *kinds):
    return sbf.read_raw(spark, files(spark, sf), RANGE, kinds=kinds)


PACKED_SQL = """p AS (SELECT event_id AS e, CAST(floor(value) AS BIGINT) AS v, make_timestamp(epoch_us(ts) // 1000 * 1000) AS epoch,
    'G' || lpad(CAST(user_id % 37 + 1 AS VARCHAR), 2, '0') AS g, 'R' || lpad(CAST(user_id % 24 + 1 AS VARCHAR), 2, '0') AS r, user_id AS u,
    1602.0::DOUBLE + (1 + (user_id % 24 + 38) % 14 - 8) * 9 / 16.0::DOUBLE AS fr FROM events),
m AS (SELECT *, (5*4294967296::BIGINT + (e*1000 + v) % 4294967296)*1e-3::DOUBLE AS pr, (v*1000-200000)*1e-4::DOUBLE AS d, ((e % 100)*65536 + v % 65536)*1e-3::DOUBLE AS ph,
  CASE WHEN v % 7 <> 0 THEN (v % 200)*0.25::DOUBLE + 10 END AS snr FROM p),
o AS (SELECT e, epoch, g || '|L1|C' AS sid, snr, pr, pr*1575.42::DOUBLE*1e6/299792458.0::DOUBLE + ph AS ph, d FROM m
  UNION ALL SELECT e, epoch, r || '|G1|C', snr, pr, pr*fr*1e6/299792458.0::DOUBLE + ph, d FROM m
  UNION ALL SELECT e, epoch, g || '|L2|L', 40.0::DOUBLE, pr + (-65536 + (e*1000+v) % 60000)*1e-3::DOUBLE,
    (pr + (-65536 + (e*1000+v) % 60000)*1e-3::DOUBLE)*1227.60::DOUBLE*1e6/299792458.0::DOUBLE + (65536+2000)*1e-3::DOUBLE, d*1227.60::DOUBLE/1575.42::DOUBLE + (-2*65536+100)*1e-4::DOUBLE FROM m)"""


def _observed(rows, *more):
    return rows.select(
        "epoch", "sid", F.round(F.col("SNR").cast("double"), 4).alias("SNR"), F.round("Pseudorange", 3).alias("Pseudorange"), F.round("Phase", 2).alias("Phase"),
        F.round(F.col("Doppler").cast("double"), 2).alias("Doppler"), *more,
    )


_OBSERVED_SQL = "epoch, sid, round(snr,4) AS SNR, round(pr,3) AS Pseudorange, round(ph,2) AS Phase, round(CAST(CAST(d AS FLOAT) AS DOUBLE),2) AS Doppler"


@query("sbf_files_observations", f"WITH {PACKED_SQL} SELECT {_OBSERVED_SQL} FROM o")
def sbf_observations(spark, sf):
    return _observed(sbf.observations(raw(spark, sf, "obs")))


@query("sbf_files_fdma", f"WITH {PACKED_SQL} SELECT sid, count(*) AS n, round(avg(ph - pr*1602.0::DOUBLE*1e6/299792458.0::DOUBLE),0) AS mean_shift FROM o WHERE sid LIKE 'R%' GROUP BY sid")
def sbf_fdma(spark, sf):
    """Phase beyond that of the middle carrier, which shows each satellite's own frequency."""
    rows = sbf.observations(raw(spark, sf, "obs")).where("sid LIKE 'R%'")
    shift = F.col("Phase") - F.col("Pseudorange") * (1602.0 * 1e6 / 299_792_458.0)
    return rows.groupBy("sid").agg(F.count("*").alias("n"), F.round(F.avg(shift), 0).alias("mean_shift"))


@query(
    "sbf_files_status",
    f"""WITH {PACKED_SQL} SELECT epoch, CASE WHEN e % 3 = 0 THEN round((e % 500)*0.01::DOUBLE,6) END AS pdop, CASE WHEN e % 3 = 0 THEN round((e % 400)*0.01::DOUBLE,6) END AS hdop, CASE WHEN e % 3 = 0 THEN round((e % 300)*0.01::DOUBLE,6) END AS vdop,
  CASE WHEN e % 4 = 0 THEN CAST(u % 30 AS DOUBLE) END AS n_sv, CASE WHEN e % 4 = 0 AND e % 7 <> 0 THEN round((e % 1000)*0.01::DOUBLE,6) END AS h_accuracy_m, CASE WHEN e % 4 = 0 THEN round((e % 900)*0.01::DOUBLE,6) END AS v_accuracy_m,
  CASE WHEN e % 4 = 0 THEN CAST(e % 11 AS DOUBLE) END AS pvt_mode, CASE WHEN e % 4 = 0 THEN round(v*0.01::DOUBLE,6) END AS mean_corr_age_s,
  CASE WHEN e % 5 = 0 THEN CAST(e % 100 AS DOUBLE) END AS cpu_load, CASE WHEN e % 20 <> 0 AND e % 5 = 0 THEN CAST(e % 60 - 20 AS DOUBLE) END AS temperature_c, CASE WHEN e % 5 = 0 THEN CAST(e % 64 AS DOUBLE) END AS rx_error FROM p""",
)
def sbf_status(spark, sf):
    out = sbf.epoch_quality(raw(spark, sf, "obs", "pvt", "dop", "status")).drop("path")
    return rounded(out.withColumns({c: F.col(c).cast("double") for c in ("n_sv", "pvt_mode", "cpu_load", "rx_error")}))


_EXTRA = "CASE WHEN e % 2 = 0 THEN {} END"


@query(
    "sbf_files_signal_quality",
    f"""WITH {PACKED_SQL}, s AS (SELECT *, sid LIKE 'R%' AS glo FROM o JOIN (SELECT e, v FROM p) USING (e))
SELECT epoch, sid, {", ".join(_EXTRA.format(x) + " AS " + n for n, x in {
    "mp_correction_m": "round((v - 100)*0.001::DOUBLE,6)", "smoothing_corr_m": "round((e % 200 - 100)*0.001::DOUBLE,6)",
    "code_var": "CASE WHEN e % 5 <> 0 THEN round(v*1e-4::DOUBLE,6) END", "carrier_var": "CASE WHEN e % 9 <> 0 THEN CAST(e % 300 AS DOUBLE) END",
    "lock_time_s": "CASE WHEN e % 11 <> 0 THEN CAST(e % 1000 AS DOUBLE) END", "cum_loss_cont": "CAST(e % 256 AS DOUBLE)",
    "car_mp_corr_cycles": "round((e % 256 - 128)/512.0::DOUBLE,6)", "cn0_highres_correction": "round((e % 8)*0.03125::DOUBLE,6)"}.items())},
  CASE WHEN e % 3 <> 1 THEN round(radians(90.0::DOUBLE - (CASE WHEN glo THEN e % 9000 ELSE v % 9000 END)*0.01::DOUBLE),6) END AS broadcast_theta,
  CASE WHEN e % 3 <> 1 THEN round(radians((CASE WHEN glo THEN e*11 % 36000 ELSE e*37 % 36000 END)*0.01::DOUBLE),6) END AS broadcast_phi,
  CASE WHEN e % 3 <> 1 AND e % 5 % 3 < 2 THEN CAST(e % 5 % 3 AS DOUBLE) END AS rise_set FROM s""",
)
def sbf_signal_quality(spark, sf):
    out = sbf.signal_quality(raw(spark, sf, "obs", "extra", "sky")).drop("path", "epoch_at")
    return rounded(out.withColumn("rise_set", F.col("rise_set").cast("double")))


@query(
    "sbf_files_without_corrections",
    f"""WITH {PACKED_SQL}, c AS (SELECT o.*, CASE WHEN e % 2 = 0 THEN (p.v - 100)*0.001::DOUBLE END AS mp, CASE WHEN e % 2 = 0 THEN (e % 200 - 100)*0.001::DOUBLE END AS sm,
  CASE WHEN e % 2 = 0 THEN (e % 256 - 128)/512.0::DOUBLE END AS cm, CASE WHEN e % 2 = 0 THEN (e % 8)*0.03125::DOUBLE ELSE 0 END AS fine FROM o JOIN (SELECT e, v FROM p) p USING (e))
SELECT {_OBSERVED_SQL.replace("round(snr,4)", "round(snr + fine,4)")}, round(snr,4) AS SNR_raw, round(pr + sm,3) AS Pseudorange_unsmoothed, round(pr + sm + mp,3) AS Pseudorange_raw, round(ph + cm,2) AS Phase_raw FROM c""",
)
def sbf_without_corrections(spark, sf):
    rows = sbf.corrected_observations(raw(spark, sf, "obs", "extra"))
    more = [F.round(F.col(c).cast("double"), d).alias(c) for c, d in (("SNR_raw", 4), ("Pseudorange_unsmoothed", 3), ("Pseudorange_raw", 3), ("Phase_raw", 2))]
    return _observed(rows, *more)
