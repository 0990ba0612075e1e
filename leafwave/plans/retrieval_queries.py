"""VOD retrieval, time binning and cell assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwave.operators import temporal
from leafwave.operators.aggregate import aggregate_by_cell
from leafwave.operators.assign import assign_cells, cached_grid
from leafwave.operators.retrieval import calculate_vod, tau_omega
from leafwave.plans.base import OBS_SQL, PASSES_SQL, grid_sql, nearest_sql, obs, passes, query, rounded

# Hourly (events) and daily (lineitem) receiver tables shared by the queries.
HOURLY_SQL = OBS_SQL + """,
hourly AS (SELECT receiver, time_bucket(INTERVAL 1 HOUR, epoch) AS epoch, sid, avg(SNR) AS SNR, avg(phi) AS phi, avg(theta) AS theta
  FROM obs GROUP BY 1, 2, 3)"""
DAILY_SQL = OBS_SQL + """,
daily AS (SELECT receiver, CAST(date_trunc('day', epoch) AS TIMESTAMP) AS epoch, sid, avg(SNR) AS SNR, avg(phi) AS phi, avg(theta) AS theta
  FROM obs GROUP BY 1, 2, 3)"""
VOD_EXPR = "-ln(pow(10.0, (c.SNR - r.SNR)/10.0))*cos(c.theta)"
DAILY_VOD_SQL = DAILY_SQL + f""",
vod AS (SELECT c.epoch, c.sid, c.phi, c.theta, c.SNR - r.SNR AS delta_snr, {VOD_EXPR} AS VOD
  FROM (SELECT * FROM daily WHERE receiver='canopy') c JOIN (SELECT * FROM daily WHERE receiver='reference') r USING (epoch, sid))"""
PASS_VOD_SQL = PASSES_SQL + f""",
daily AS (SELECT receiver, epoch, sid, avg(SNR) AS SNR, avg(phi) AS phi, avg(theta) AS theta FROM passes GROUP BY 1, 2, 3),
vod AS (SELECT c.epoch, c.sid, c.phi, c.theta, c.SNR - r.SNR AS delta_snr, {VOD_EXPR} AS VOD
  FROM (SELECT * FROM daily WHERE receiver='canopy') c JOIN (SELECT * FROM daily WHERE receiver='reference') r USING (epoch, sid))"""
# VOD rows with their 10-degree equal-area cell.
CELL_VOD_SQL = "WITH " + DAILY_VOD_SQL + "," + grid_sql() + "," + nearest_sql("vod", "cells")
CELL_PASS_SQL = "WITH " + PASS_VOD_SQL + "," + grid_sql() + "," + nearest_sql("vod", "cells")
CELL_OBS_SQL = "WITH " + OBS_SQL + "," + grid_sql() + "," + nearest_sql("obs", "cells")


def sides(spark, sf, freq="1D", source=obs):
    """Canopy and reference tables, averaged to ``freq``: one shared aggregation."""
    binned = temporal.temporal_aggregate(
        source(spark, sf), freq, keys=("receiver", "sid"), columns=("SNR", "phi", "theta")
    )
    return tuple(
        binned.where(F.col("receiver") == side).drop("receiver") for side in ("canopy", "reference")
    )


def vod_table(spark, sf, source=obs):
    return tau_omega(*sides(spark, sf, source=source))


def cell_vod(spark, sf, source=obs, resolution=10.0):
    grid = cached_grid("equal_area", resolution)
    return assign_cells(vod_table(spark, sf, source), grid, out="cell_id")


def cell_obs(spark, sf, source=obs):
    return assign_cells(source(spark, sf), cached_grid("equal_area", 10.0), out="cell_id")


@query(
    "flagship_vod_per_cell",
    CELL_PASS_SQL + """
SELECT cell_id, count(*) AS n, round(avg(VOD), 6) AS mean_vod, round(stddev_samp(VOD), 6) AS std_vod FROM cells GROUP BY cell_id""",
)
def flagship(spark, sf):
    """Bin in time, pair the receivers, retrieve VOD, find cells, summarise per cell."""
    vod = cell_vod(spark, sf, passes)
    return rounded(
        vod.groupBy("cell_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("VOD").alias("mean_vod"),
            F.stddev_samp("VOD").alias("std_vod"),
        )
    )


@query(
    "vod_tau_omega_inner",
    "WITH " + DAILY_VOD_SQL + " SELECT epoch, sid, round(phi,6) AS phi, round(theta,6) AS theta, round(VOD,6) AS VOD, round(delta_snr,6) AS delta_snr FROM vod",
)
def vod_inner(spark, sf):
    return rounded(vod_table(spark, sf))


@query(
    "vod_tau_omega_left",
    "WITH " + DAILY_SQL + f""" SELECT c.epoch, c.sid, round(c.phi,6) AS phi, round(c.theta,6) AS theta, round({VOD_EXPR},6) AS VOD, round(c.SNR - r.SNR,6) AS delta_snr
  FROM (SELECT * FROM daily WHERE receiver='canopy') c LEFT JOIN (SELECT * FROM daily WHERE receiver='reference') r USING (epoch, sid)""",
)
def vod_left(spark, sf):
    return rounded(calculate_vod(*sides(spark, sf), align=False))


@query(
    "vod_daily_summary",
    "WITH " + PASS_VOD_SQL + " SELECT epoch, round(avg(VOD),6) AS mean_vod, round(stddev_pop(VOD),6) AS std_vod, count(*) AS n_rows, count(DISTINCT sid) AS n_sids FROM vod GROUP BY epoch",
)
def vod_summary(spark, sf):
    return rounded(
        vod_table(spark, sf, passes)
        .groupBy("epoch")
        .agg(
            F.avg("VOD").alias("mean_vod"),
            F.stddev_pop("VOD").alias("std_vod"),
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("sid").alias("n_sids"),
        )
    )


@query(
    "delta_snr",
    "WITH " + PASS_VOD_SQL + " SELECT sid, count(*) AS n, round(avg(delta_snr),6) AS mean_delta, round(min(delta_snr),6) AS min_delta, round(max(delta_snr),6) AS max_delta FROM vod GROUP BY sid",
)
def delta_snr(spark, sf):
    return rounded(
        vod_table(spark, sf, passes).groupBy("sid").agg(
            F.count(F.lit(1)).alias("n"), F.avg("delta_snr").alias("mean_delta"),
            F.min("delta_snr").alias("min_delta"), F.max("delta_snr").alias("max_delta"),
        )
    )


@query(
    "temporal_agg_mean",
    "WITH " + HOURLY_SQL + " SELECT receiver, epoch, sid, round(SNR,6) AS SNR, round(phi,6) AS phi, round(theta,6) AS theta FROM hourly",
)
def temporal_mean(spark, sf):
    return rounded(temporal.temporal_aggregate(obs(spark, sf), "1h", keys=("receiver", "sid")))


@query(
    "temporal_agg_median",
    "WITH " + OBS_SQL + " SELECT date_trunc('day', epoch)::TIMESTAMP AS epoch, sid, round(median(SNR),6) AS SNR, round(median(phi),6) AS phi, round(median(theta),6) AS theta FROM obs GROUP BY 1, 2",
)
def temporal_median(spark, sf):
    return rounded(temporal.temporal_aggregate(obs(spark, sf), "1D", "median"))


@query(
    "median_epoch_spacing",
    "WITH " + OBS_SQL + """, e AS (SELECT DISTINCT epoch FROM obs), g AS (SELECT (epoch_us(epoch) - lag(epoch_us(epoch)) OVER (ORDER BY epoch))/1e6 AS gap FROM e)
SELECT round(median(gap), 6) AS spacing_s, count(gap) AS n_gaps FROM g WHERE gap IS NOT NULL""",
)
def spacing(spark, sf):
    from leafwave.operators.quality import epoch_gaps
    from leafwave.operators.quantiles import group_median

    gaps = epoch_gaps(obs(spark, sf)).withColumn("k", F.lit(1))
    med = group_median(gaps, ["k"], "gap_s", "spacing_s")
    n = gaps.groupBy("k").agg(F.count(F.lit(1)).alias("n_gaps"))
    return rounded(med.join(n, "k").drop("k"))


@query(
    "resample_weekly",
    "WITH " + PASS_VOD_SQL + " SELECT to_timestamp((epoch_us(epoch)//1000000)//604800*604800)::TIMESTAMP AS epoch, sid, round(avg(VOD),6) AS VOD, round(avg(phi),6) AS phi, round(avg(theta),6) AS theta FROM vod GROUP BY 1, 2",
)
def resample_weekly(spark, sf):
    return rounded(temporal.resample(vod_table(spark, sf, passes), "7D"))


@query("cell_assign_nearest", CELL_OBS_SQL + " SELECT receiver, epoch, sid, cell_id FROM cells")
def cell_assign(spark, sf):
    return cell_obs(spark, sf).select("receiver", "epoch", "sid", "cell_id")


@query(
    "cell_assign_5deg_count",
    "WITH " + PASSES_SQL + "," + grid_sql(5.0) + "," + nearest_sql("passes", "cells") + " SELECT cell_id, count(*) AS n FROM cells GROUP BY cell_id",
)
def cell_assign_fine(spark, sf):
    cells = assign_cells(passes(spark, sf), cached_grid("equal_area", 5.0), out="cell_id")
    return aggregate_by_cell(cells.withColumn("n", F.col("SNR")), "n", "count")
