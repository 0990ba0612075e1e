"""Global and per-cell filters, Hampel family, masks and weights."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from leafwave.functions import sids, signals
from leafwave.operators import filters as fl
from leafwave.operators import hampel as hp
from leafwave.operators import masks as mk
from leafwave.operators import weights as wt
from leafwave.operators.assign import cached_grid
from leafwave.operators.assign import assign_cells
from leafwave.operators.grids import banded_cells, create_grid, grid_stats
from leafwave.operators.voronoi import voronoi_cells
from leafwave.plans.base import OBS_SQL, PASSES_SQL, grid_sql, nearest_sql, obs, passes, query, rounded
from leafwave.plans.retrieval_queries import CELL_OBS_SQL, CELL_PASS_SQL, cell_obs, cell_vod

WITH_OBS = "WITH " + OBS_SQL
WITH_PASSES = "WITH " + PASSES_SQL
KEY = "receiver, epoch, sid"
FULL_KEY = "receiver, epoch, sid, round(phi,6) AS phi, round(theta,6) AS theta, round(SNR,6) AS SNR"


def _masked(df, suffix, var="SNR"):
    """Row count, kept count and value sum by receiver and sid: every row counts."""
    return rounded(
        df.groupBy("receiver", "sid").agg(
            F.count(F.lit(1)).alias("n_total"),
            F.sum(F.col(f"mask_{suffix}").cast("bigint")).alias("n_kept"),
            F.sum(f"{var}_filtered_{suffix}").alias("kept_sum"),
        )
    )


def _masked_sql(keep: str, source: str, var: str = "SNR") -> str:
    return (
        f" SELECT receiver, sid, count(*) AS n_total, count(*) FILTER (WHERE {keep}) AS n_kept,"
        f" round(sum({var}) FILTER (WHERE {keep}),6) AS kept_sum FROM {source} GROUP BY 1, 2"
    )


# -- signal ids ---------------------------------------------------------------


@query(
    "sid_split",
    WITH_OBS + " SELECT DISTINCT sid, split_part(sid,'|',1) AS sv, substr(sid,1,1) AS system, split_part(sid,'|',2) AS band, split_part(sid,'|',3) AS code FROM obs",
)
def sid_split(spark, sf):
    return sids.with_sid_parts(obs(spark, sf).select("sid").distinct())


@query(
    "sid_pattern_filter",
    WITH_OBS + " SELECT receiver, sid, count(*) AS n FROM obs WHERE sid LIKE 'E%' AND split_part(sid,'|',2)='E1' AND split_part(sid,'|',3)='C' GROUP BY 1, 2",
)
def sid_pattern(spark, sf):
    rows = obs(spark, sf).where(sids.matches_pattern("sid", "E", "E1", "C"))
    return rows.groupBy("receiver", "sid").agg(F.count(F.lit(1)).alias("n"))


@query(
    "overlap_group_filter",
    WITH_OBS + " SELECT split_part(sid,'|',2) AS band, count(*) AS n FROM obs WHERE split_part(sid,'|',2) NOT IN ('E1','B1I') AND split_part(sid,'|',2) NOT IN ('G2','E5b','B2b') GROUP BY 1",
)
def overlap_group(spark, sf):
    kept = signals.prefer_overlapping(obs(spark, sf), {"group_1": "L1", "group_3": "L2"})
    return kept.groupBy(signals.band_of(F.col("sid")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


BANDS_SQL = "bands(system, band, codes) AS (VALUES " + ", ".join(
    f"('{r[0]}','{r[1]}',{r[3]!r})" for r in signals.band_rows()
) + ")"
SV_SQL = """svs AS (SELECT DISTINCT substr('GREC', CAST(s_suppkey % 4 + 1 AS INT), 1) || lpad(CAST((s_suppkey // 4) % 24 + 1 AS VARCHAR), 2, '0') AS sv FROM supplier)"""


@query(
    "sv_to_sid_expand",
    f"WITH {BANDS_SQL}, {SV_SQL} SELECT sv || '|' || band || '|' || code AS sid FROM (SELECT sv, band, unnest(codes) AS code FROM svs JOIN bands ON system = substr(sv,1,1))",
)
def sv_to_sid(spark, sf):
    from leafwave.plans.base import table

    k = F.col("s_suppkey")
    sv = F.concat(
        F.substring(F.lit("GREC"), (F.pmod(k, F.lit(4)) + 1).cast("int"), F.lit(1)),
        F.lpad((F.pmod(F.floor(k / 4), F.lit(24)) + 1).cast("string"), 2, "0"),
    )
    return signals.expand_sv_to_sid(table(spark, sf, "supplier").select(sv.alias("sv")).distinct())


@query(
    "densify_sid",
    WITH_PASSES + f""", {BANDS_SQL}, slots(system, n) AS (VALUES ('G',32),('E',36),('R',24),('C',63),('I',14),('S',36),('J',10)),
universe AS (SELECT s.system || lpad(CAST(k+1 AS VARCHAR),2,'0') || '|' || band || '|' || code AS sid FROM (SELECT system, n, band, unnest(codes) AS code FROM bands JOIN slots s2 USING (system)) s, range(0, 63) r(k) WHERE k < n),
keep AS (SELECT sid FROM universe WHERE sid LIKE '%|L1|C'),
d AS (SELECT epoch, sid, avg(SNR) AS SNR FROM passes GROUP BY 1, 2),
full_ AS (SELECT e.epoch, k.sid, d.SNR FROM (SELECT DISTINCT epoch FROM passes) e CROSS JOIN keep k LEFT JOIN d ON d.epoch = e.epoch AND d.sid = k.sid)
SELECT sid, count(*) AS n_epochs, count(SNR) AS n_observed, round(sum(SNR),6) AS total FROM full_ GROUP BY sid""",
)
def densify(spark, sf):
    daily = passes(spark, sf).groupBy("epoch", "sid").agg(F.avg("SNR").alias("SNR"))
    keep = [f"{s}{i:02d}|L1|C" for s, n in signals.SLOTS.items() for i in range(1, n + 1)]
    full = signals.densify(daily, keep)
    return rounded(
        full.groupBy("sid").agg(
            F.count(F.lit(1)).alias("n_epochs"), F.count("SNR").alias("n_observed"), F.sum("SNR").alias("total")
        )
    )


@query(
    "signals_outside_space",
    WITH_OBS + f""", {BANDS_SQL}, slots(system, n) AS (VALUES ('G',32),('E',36),('R',24),('C',63),('I',14),('S',36),('J',10)),
universe AS (SELECT s.system || lpad(CAST(k+1 AS VARCHAR),2,'0') || '|' || band || '|' || code AS sid FROM (SELECT system, n, band, unnest(codes) AS code FROM bands JOIN slots s2 USING (system)) s, range(0, 63) r(k) WHERE k < n)
SELECT sid, count(*) AS n FROM obs WHERE sid NOT IN (SELECT sid FROM universe) GROUP BY 1""",
)
def unknown_sids(spark, sf):
    known = signals.signals(spark).select("sid")
    rows = obs(spark, sf).groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(known, "sid", "left_anti")


# -- global filters -----------------------------------------------------------


@query(
    "filter_zscore",
    WITH_PASSES + ", s AS (SELECT avg(SNR) AS m, stddev_pop(SNR) AS sd FROM passes)"
    + _masked_sql("abs(SNR-m)/sd <= 1.5", "passes, s"),
)
def filter_zscore(spark, sf):
    return _masked(fl.ZScoreFilter(1.5).apply(passes(spark, sf), "SNR"), "zscore")


@query(
    "filter_iqr",
    WITH_PASSES + ", s AS (SELECT quantile_cont(SNR,0.25) AS a, quantile_cont(SNR,0.75) AS b FROM passes)"
    + _masked_sql("SNR BETWEEN a-0.5*(b-a) AND b+0.5*(b-a)", "passes, s"),
)
def filter_iqr(spark, sf):
    return _masked(fl.IQRFilter(0.5).apply(passes(spark, sf), "SNR"), "iqr")


@query("filter_range", WITH_PASSES + _masked_sql("SNR BETWEEN 25 AND 40", "passes"))
def filter_range(spark, sf):
    return _masked(fl.RangeFilter(25, 40).apply(passes(spark, sf), "SNR"), "range")


@query(
    "filter_percentile",
    WITH_PASSES + ", s AS (SELECT quantile_cont(SNR,0.05) AS a, quantile_cont(SNR,0.95) AS b FROM passes)"
    + _masked_sql("SNR BETWEEN a AND b", "passes, s"),
)
def filter_percentile(spark, sf):
    return _masked(fl.PercentileFilter(5, 95).apply(passes(spark, sf), "SNR"), "percentile")


@query("filter_custom", WITH_PASSES + _masked_sql("floor(SNR) = SNR", "passes"))
def filter_custom(spark, sf):
    return _masked(fl.CustomFilter("whole", lambda c: F.floor(c) == c).apply(passes(spark, sf), "SNR"), "whole")


@query(
    "filter_stats",
    WITH_PASSES + ", s AS (SELECT avg(SNR) AS m, stddev_pop(SNR) AS sd FROM passes) SELECT count(*) AS n_total, count(*) FILTER (WHERE abs(SNR-m)/sd > 1.5) AS n_removed, round(count(*) FILTER (WHERE abs(SNR-m)/sd > 1.5)/count(*),6) AS fraction_removed FROM passes, s",
)
def filter_stats(spark, sf):
    return rounded(fl.filter_stats(fl.ZScoreFilter(1.5).apply(passes(spark, sf), "SNR"), "zscore"))


PIPE_SQL = WITH_PASSES + ", s AS (SELECT avg(SNR) AS m, stddev_pop(SNR) AS sd, quantile_cont(SNR,0.25) AS a, quantile_cont(SNR,0.75) AS b FROM passes)"


@query(
    "filter_chain_combined",
    PIPE_SQL + _masked_sql("abs(SNR-m)/sd <= 1.8 AND SNR BETWEEN a-0.6*(b-a) AND b+0.6*(b-a) AND SNR >= 21", "passes, s"),
)
def pipeline_combined(spark, sf):
    p = fl.FilterPipeline("SNR").add(fl.ZScoreFilter(1.8)).add(fl.IQRFilter(0.6)).add(fl.RangeFilter(21))
    return _masked(p.apply(passes(spark, sf), "combined"), "combined")


@query(
    "filter_chain_sequential",
    PIPE_SQL + _masked_sql("abs(SNR-m)/sd <= 1.8 AND SNR BETWEEN a-0.6*(b-a) AND b+0.6*(b-a)", "passes, s"),
)
def pipeline_sequential(spark, sf):
    p = fl.FilterPipeline("SNR").add(fl.ZScoreFilter(1.8)).add(fl.IQRFilter(0.6))
    return _masked(p.apply(passes(spark, sf), "sequential"), "zscore_iqr")


# -- per-cell filters ---------------------------------------------------------

CELL_SNR_SQL = "WITH " + PASSES_SQL + "," + grid_sql() + "," + nearest_sql("passes", "cells")
CSTAT = """, s AS (SELECT cell_id, count(*) AS n, avg(SNR) AS m, stddev_pop(SNR) AS sd, quantile_cont(SNR,0.25) AS a, quantile_cont(SNR,0.75) AS b,
  quantile_cont(SNR,0.05) AS p5, quantile_cont(SNR,0.95) AS p95 FROM cells GROUP BY 1), j AS (SELECT * FROM cells JOIN s USING (cell_id))"""
IQR_KEEP = "(n < 5 OR a = b OR SNR BETWEEN a-0.5*(b-a) AND b+0.5*(b-a))"
Z_KEEP = "(n < 5 OR sd = 0 OR abs(SNR-m)/sd <= 1.5)"


def cell_passes(spark, sf):
    return cell_obs(spark, sf, passes)


@query("percell_iqr", CELL_SNR_SQL + CSTAT + _masked_sql(IQR_KEEP, "j"))
def percell_iqr(spark, sf):
    return _masked(fl.PerCellIQR(0.5).apply(cell_passes(spark, sf), "SNR"), "iqr")


@query("percell_zscore", CELL_SNR_SQL + CSTAT + _masked_sql(Z_KEEP, "j"))
def percell_zscore(spark, sf):
    return _masked(fl.PerCellZScore(1.5).apply(cell_passes(spark, sf), "SNR"), "zscore")


@query("percell_range", CELL_SNR_SQL + CSTAT + _masked_sql("(n < 300 OR SNR BETWEEN 25 AND 40)", "j"))
def percell_range(spark, sf):
    return _masked(fl.PerCellRange(25, 40).apply(cell_passes(spark, sf), "SNR", min_observations=300), "range")


@query("percell_percentile", CELL_SNR_SQL + CSTAT + _masked_sql("(n < 5 OR SNR BETWEEN p5 AND p95)", "j"))
def percell_percentile(spark, sf):
    return _masked(fl.PerCellPercentile(5, 95).apply(cell_passes(spark, sf), "SNR"), "percentile")


@query("percell_chain_combined", CELL_SNR_SQL + CSTAT + _masked_sql(f"{IQR_KEEP} AND {Z_KEEP}", "j"))
def percell_combined(spark, sf):
    p = fl.PerCellFilterPipeline("SNR").add(fl.PerCellIQR(0.5)).add(fl.PerCellZScore(1.5))
    return _masked(p.apply(cell_passes(spark, sf), "combined", "both"), "both")


@query(
    "percell_chain_sequential",
    CELL_SNR_SQL + CSTAT + f""", k1 AS (SELECT receiver, sid, epoch, cell_id, CASE WHEN {IQR_KEEP} THEN SNR END AS x FROM j),
s2 AS (SELECT cell_id, count(x) AS n2, avg(x) AS m2, stddev_pop(x) AS sd2 FROM k1 GROUP BY 1),
j2 AS (SELECT *, (x IS NULL OR n2 < 5 OR sd2 = 0 OR abs(x-m2)/sd2 <= 1.5) AS ok FROM k1 LEFT JOIN s2 USING (cell_id))
SELECT receiver, sid, count(*) AS n_total, count(*) FILTER (WHERE ok) AS n_kept, round(sum(x) FILTER (WHERE ok),6) AS kept_sum FROM j2 GROUP BY 1, 2""",
)
def percell_sequential(spark, sf):
    p = fl.PerCellFilterPipeline("SNR").add(fl.PerCellIQR(0.5)).add(fl.PerCellZScore(1.5))
    return _masked(p.apply(cell_passes(spark, sf)), "zscore_1")


@query(
    "compare_filtering",
    CELL_SNR_SQL + CSTAT + f""" SELECT 'iqr' AS method, count(*) AS n_kept, round(avg(SNR),6) AS mean, round(stddev_samp(SNR),6) AS std FROM j WHERE {IQR_KEEP}
UNION ALL SELECT 'zscore', count(*), round(avg(SNR),6), round(stddev_samp(SNR),6) FROM j WHERE {Z_KEEP}""",
)
def compare_filtering(spark, sf):
    return rounded(
        fl.compare_filtering(
            cell_passes(spark, sf), {"iqr": fl.PerCellIQR(0.5), "zscore": fl.PerCellZScore(1.5)}, "SNR"
        )
    )


# -- Hampel family ------------------------------------------------------------

COARSE_SQL = "WITH " + PASSES_SQL + "," + grid_sql(30.0) + "," + nearest_sql("passes", "cells")
COARSE_OBS_SQL = "WITH " + OBS_SQL + "," + grid_sql(30.0) + "," + nearest_sql("obs", "cells")
GROUPED = """, g AS (SELECT cell_id, sid, count(*) AS n, median(SNR) AS med, mad(SNR) AS dev FROM cells GROUP BY 1, 2), j AS (SELECT * FROM cells JOIN g USING (cell_id, sid))"""


def coarse_passes(spark, sf):
    return assign_cells(passes(spark, sf), cached_grid("equal_area", 30.0), out="cell_id")


def _hampel_summary(df, var="SNR"):
    return rounded(
        df.groupBy("cell_id", "sid").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("hampel_outlier_mask").cast("bigint")).alias("n_outliers"),
            F.sum(F.col("hampel_processing_mask").cast("bigint")).alias("n_processed"),
            F.sum(f"{var}_filtered").alias("kept_sum"),
        )
    )


def _hampel_sql(bad: str, processed: str, source: str = "j") -> str:
    return (
        f" SELECT cell_id, sid, count(*) AS n, count(*) FILTER (WHERE {bad}) AS n_outliers,"
        f" count(*) FILTER (WHERE {processed}) AS n_processed, round(sum(SNR) FILTER (WHERE NOT ({bad})),6) AS kept_sum FROM {source} GROUP BY 1, 2"
    )


@query(
    "hampel_cell_sid",
    COARSE_SQL + GROUPED + _hampel_sql("n >= 20 AND dev > 0 AND abs(SNR-med) > 2.0*dev", "n >= 20"),
)
def hampel_cell_sid(spark, sf):
    return _hampel_summary(hp.hampel(coarse_passes(spark, sf), 2.0, 20, "SNR"))


@query(
    "hampel_preagg",
    COARSE_SQL + """, b AS (SELECT cell_id, sid, to_timestamp((epoch_us(epoch)//1000000)//604800*604800)::TIMESTAMP AS epoch, avg(SNR) AS SNR FROM cells GROUP BY 1, 2, 3),
g AS (SELECT cell_id, sid, count(*) AS n, median(SNR) AS med, mad(SNR) AS dev FROM b GROUP BY 1, 2), j AS (SELECT * FROM b JOIN g USING (cell_id, sid))"""
    + _hampel_sql("n >= 10 AND dev > 0 AND abs(SNR-med) > 2.0*dev", "n >= 10"),
)
def hampel_preagg(spark, sf):
    return _hampel_summary(
        hp.hampel_preaggregated(coarse_passes(spark, sf), "7D", var="SNR", threshold=2.0, min_obs=10)
    )


@query(
    "sigma_clip",
    COARSE_SQL + GROUPED + _hampel_sql("n >= 5 AND abs(SNR-med) > 1.5*1.482602218505602::DOUBLE*dev", "n >= 5"),
)
def sigma_clip(spark, sf):
    return _hampel_summary(hp.sigma_clip(coarse_passes(spark, sf), 1.5, 5, "SNR"))


SLIDING_FRAME = "OVER (PARTITION BY cell_id ORDER BY epoch RANGE BETWEEN INTERVAL 12 HOUR PRECEDING AND INTERVAL 12 HOUR FOLLOWING)"


@query(
    "hampel_sliding",
    COARSE_OBS_SQL + f""", w AS (SELECT receiver, epoch, sid, cell_id, SNR, count(*) {SLIDING_FRAME} AS n, median(SNR) {SLIDING_FRAME} AS med, mad(SNR) {SLIDING_FRAME} AS dev FROM cells)
SELECT receiver, epoch, sid, cell_id, n AS window_n, round(med,6) AS window_median, round(dev,6) AS window_mad, (n >= 5 AND dev > 0 AND abs(SNR-med) > 2.0*1.4826::DOUBLE*dev) AS hampel_outlier_mask FROM w""",
)
def hampel_sliding(spark, sf):
    rows = assign_cells(obs(spark, sf), cached_grid("equal_area", 30.0), out="cell_id")
    out = hp.sliding_hampel(rows, 12.0, 2.0, 5, "SNR", keys=("cell_id",), block_hours=72.0, keep_window_stats=True)
    return rounded(
        out.select(
            "receiver", "epoch", "sid", "cell_id", F.col("window_n").cast("bigint").alias("window_n"),
            "window_median", "window_mad", "hampel_outlier_mask",
        )
    )


@query(
    "hampel_sliding_by_sid",
    "WITH " + OBS_SQL + """, w AS (SELECT sid, SNR, count(*) OVER f AS n, count(*) OVER (PARTITION BY sid) AS total, median(SNR) OVER f AS med, mad(SNR) OVER f AS dev FROM obs
  WINDOW f AS (PARTITION BY sid ORDER BY epoch RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND INTERVAL 48 HOUR FOLLOWING))
SELECT sid, count(*) AS n, count(*) FILTER (WHERE n >= 5 AND total >= 5 AND dev > 0 AND abs(SNR-med) > 2.0*1.4826::DOUBLE*dev) AS n_outliers, round(sum(med),4) AS sum_median FROM w GROUP BY sid""",
)
def hampel_sliding_by_sid(spark, sf):
    out = hp.sliding_hampel(obs(spark, sf), 48.0, 2.0, 5, "SNR", keys=("sid",), keep_window_stats=True)
    return rounded(
        out.groupBy("sid").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("hampel_outlier_mask").cast("bigint")).alias("n_outliers"),
            F.round(F.sum("window_median"), 4).alias("sum_median"),
        )
    )


# -- masks and weights: grid cells applied to every observation ---------------


def grid_df(spark):
    return cached_grid("equal_area", 10.0).with_solid_angles(spark)


def _mask_counts(spark, sf, mask):
    kept = mk.apply_mask(cell_passes(spark, sf), mask)
    return rounded(kept.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"), F.avg("SNR").alias("mean_snr")))


def _mask_sql(cond: str) -> str:
    return (
        CELL_SNR_SQL + " SELECT cell_id, count(*) AS n, round(avg(SNR),6) AS mean_snr FROM cells WHERE cell_id IN"
        f" (SELECT cell_id FROM grid WHERE {cond}) GROUP BY 1"
    )


PHI, THETA = "degrees(phi)", "degrees(theta)"


@query("mask_phi_wrap", _mask_sql(f"{PHI} >= 301 OR {PHI} <= 61"))
def mask_phi_wrap(spark, sf):
    return _mask_counts(spark, sf, mk.SpatialMask().phi_range(301, 61).compute(grid_df(spark)))


@query("mask_elevation", _mask_sql(f"90-{THETA} BETWEEN 33 AND 88"))
def mask_elevation(spark, sf):
    return _mask_counts(spark, sf, mk.elevation_mask(grid_df(spark), 33, 88))


@query("mask_hemisphere_north", _mask_sql(f"{PHI} >= 315 OR {PHI} <= 45"))
def mask_north(spark, sf):
    return _mask_counts(spark, sf, mk.hemisphere_mask(grid_df(spark), "north"))


@query("mask_sector_and", _mask_sql(f"({PHI} >= 341 OR {PHI} <= 41) AND {THETA} BETWEEN 11 AND 61 AND cell_id NOT IN (5, 6, 7)"))
def mask_sector_and(spark, sf):
    m = mk.SpatialMask().radial_sector(11, 60, 11, 61).exclude_cell_ids([5, 6, 7])
    return _mask_counts(spark, sf, m.compute(grid_df(spark)))


@query("mask_sector_or", _mask_sql(f"({PHI} >= 341 OR {PHI} <= 41) OR {THETA} BETWEEN 1 AND 21 OR cell_id IN (200, 201)"))
def mask_sector_or(spark, sf):
    m = mk.SpatialMask().radial_sector(11, 60, 1, 21).cell_ids([200, 201])
    return _mask_counts(spark, sf, m.compute(grid_df(spark), "OR"))


@query(
    "mask_quality",
    CELL_SNR_SQL + ", q AS (SELECT cell_id, avg(SNR) AS mean_snr, count(*) AS n FROM cells GROUP BY 1) SELECT cell_id, n, round(mean_snr,6) AS mean_snr FROM q WHERE mean_snr >= 33.5",
)
def mask_quality(spark, sf):
    rows = cell_passes(spark, sf)
    cells = grid_df(spark).join(rows.groupBy("cell_id").agg(F.avg("SNR").alias("quality")), "cell_id", "left")
    mask = mk.SpatialMask().quality_threshold("quality", 33.5).compute(cells)
    kept = mk.apply_mask(rows, mask)
    return rounded(kept.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"), F.avg("SNR").alias("mean_snr")))


@query(
    "mask_summary",
    CELL_SNR_SQL + f""", seen AS (SELECT * FROM grid WHERE cell_id IN (SELECT cell_id FROM cells)),
m AS (SELECT phi BETWEEN radians(10) AND radians(100) AS a, theta BETWEEN 0 AND radians(45) AS b FROM seen)
SELECT '0_phi_range' AS mask, count(*) FILTER (WHERE a) AS n_cells, round(count(*) FILTER (WHERE a)/count(*),6) AS fraction FROM m
UNION ALL SELECT '1_theta_range', count(*) FILTER (WHERE b), round(count(*) FILTER (WHERE b)/count(*),6) FROM m
UNION ALL SELECT 'AND', count(*) FILTER (WHERE a AND b), round(count(*) FILTER (WHERE a AND b)/count(*),6) FROM m
UNION ALL SELECT 'OR', count(*) FILTER (WHERE a OR b), round(count(*) FILTER (WHERE a OR b)/count(*),6) FROM m""",
)
def mask_summary(spark, sf):
    seen = grid_df(spark).join(cell_passes(spark, sf).select("cell_id").distinct(), "cell_id", "left_semi")
    return rounded(mk.SpatialMask().phi_range(10, 100).theta_range(0, 45).summary(seen))


@query(
    "weights_invvar",
    CELL_SNR_SQL + " SELECT g.cell_id, round(coalesce(CASE WHEN n >= 2 AND v > 0 THEN 1/(v+0.5) END, 0),6) AS weight FROM grid g LEFT JOIN (SELECT cell_id, var_samp(SNR) AS v, count(*) AS n FROM cells GROUP BY 1) s USING (cell_id)",
)
def weights_invvar(spark, sf):
    return rounded(wt.inverse_variance(grid_df(spark), cell_passes(spark, sf), "SNR", regularization=0.5))


@query(
    "weights_obs_count",
    CELL_SNR_SQL + " SELECT g.cell_id, CASE WHEN coalesce(n,0) >= 100 THEN n ELSE 0 END::DOUBLE AS weight FROM grid g LEFT JOIN (SELECT cell_id, count(*) AS n FROM cells GROUP BY 1) s USING (cell_id)",
)
def weights_obs_count(spark, sf):
    return rounded(wt.observation_count(grid_df(spark), cell_passes(spark, sf), "SNR", min_count=100))


for _how, _expr in (("mean", "avg(SNR)"), ("median", "median(SNR)"), ("max", "max(SNR)")):

    @query(
        f"weights_snr_{_how}",
        CELL_SNR_SQL + f" SELECT g.cell_id, round(coalesce(w,0),6) AS weight FROM grid g LEFT JOIN (SELECT cell_id, {_expr} AS w FROM cells GROUP BY 1) s USING (cell_id)",
    )
    def _weights_snr(spark, sf, how=_how):
        return rounded(wt.snr(grid_df(spark), cell_passes(spark, sf), how=how))


@query(
    "weights_combined",
    CELL_SNR_SQL + """, a AS (SELECT g.cell_id, (phi_max-phi_min)*(cos(theta_min)-cos(theta_max)) AS sa, greatest(cos(theta),0) AS se, coalesce(n,0) AS n FROM grid g LEFT JOIN (SELECT cell_id, count(*) AS n FROM cells GROUP BY 1) s USING (cell_id)),
b AS (SELECT cell_id, sa/sum(sa) OVER () * (se/sum(se) OVER ()) * (n/sum(n) OVER ()) AS p FROM a)
SELECT cell_id, round(p/sum(p) OVER (),9) AS weight FROM b""",
)
def weights_combined(spark, sf):
    cells = grid_df(spark)
    parts = [
        wt.solid_angle(cells), wt.sin_elevation(cells), wt.observation_count(cells, cell_passes(spark, sf), "SNR"),
    ]
    return rounded(wt.combine(parts), 9)


@query(
    "weights_combined_add",
    CELL_SNR_SQL + """, a AS (SELECT g.cell_id, greatest(cos(theta),0) AS se, coalesce(n,0) AS n FROM grid g LEFT JOIN (SELECT cell_id, count(*) AS n FROM cells GROUP BY 1) s USING (cell_id)),
b AS (SELECT cell_id, se/sum(se) OVER () + n/sum(n) OVER () + 1.0::DOUBLE/count(*) OVER () AS p FROM a)
SELECT cell_id, round(p/sum(p) OVER (),9) AS weight FROM b""",
)
def weights_combined_add(spark, sf):
    cells = grid_df(spark)
    parts = [
        wt.sin_elevation(cells), wt.observation_count(cells, cell_passes(spark, sf), "SNR"), wt.uniform(cells),
    ]
    return rounded(wt.combine(parts, "add"), 9)


# -- grids: each generated grid, met with the cells the data falls in ----------

RECT_GRIDS = {
    "equal_angle": """grid AS (SELECT 0 AS cell_id, 0.0::DOUBLE AS phi, 0.0::DOUBLE AS theta, 2*pi()*(1-cos(radians(5))) AS solid_angle
  UNION ALL SELECT CAST(1 + (b-1)*36 + k AS INT), (k+0.5::DOUBLE)*2*pi()/36, b*radians(10.0::DOUBLE), 2*pi()/36*(cos((b-0.5::DOUBLE)*radians(10.0::DOUBLE))-cos((b+0.5::DOUBLE)*radians(10.0::DOUBLE))) FROM range(1, 9) x(b), range(0, 36) y(k))""",
    "equirectangular": """grid AS (SELECT CAST(b*36 + k AS INT) AS cell_id, (k+0.5::DOUBLE)*radians(10.0::DOUBLE) AS phi, (b+0.5::DOUBLE)*radians(10.0::DOUBLE) AS theta,
    radians(10.0::DOUBLE)*(cos(b*radians(10.0::DOUBLE))-cos((b+1)*radians(10.0::DOUBLE))) AS solid_angle FROM range(0, 9) x(b), range(0, 36) y(k))""",
}

# Golden-spiral centres over the whole sphere, the upper half kept.
_FIB = 2 * max(10, int(2 * math.pi / math.radians(10.0) ** 2))
RECT_GRIDS["fibonacci"] = f"""
  grid AS (SELECT CAST(i AS INT) AS cell_id, acos(1.0::DOUBLE - 2*(i + 0.5::DOUBLE)/{_FIB}) AS theta, fmod(2*pi()*(i + 0.5::DOUBLE)/((1 + sqrt(5.0::DOUBLE))/2), 2*pi()) AS phi,
    4*pi()/{_FIB} AS solid_angle FROM range({_FIB}) t(i) WHERE acos(1.0::DOUBLE - 2*(i + 0.5::DOUBLE)/{_FIB}) <= pi()/2)"""

for _kind, _res in (("equal_angle", 10.0), ("equirectangular", 10.0), ("htm", 10.0), ("geodesic", 10.0),
                    ("healpix", 10.0), ("fibonacci", 10.0)):
    _sql = None
    if _kind in RECT_GRIDS:
        _sql = (
            WITH_PASSES + "," + RECT_GRIDS[_kind] + "," + nearest_sql("passes", "cells")
            + " SELECT g.cell_id, round(phi,6) AS phi, round(theta,6) AS theta, round(solid_angle,6) AS solid_angle, n"
            " FROM grid g LEFT JOIN (SELECT cell_id, count(*) AS n FROM cells GROUP BY 1) h USING (cell_id)"
        )

    @query(f"grid_{_kind}_coverage", _sql)
    def _coverage(spark, sf, kind=_kind, res=_res):
        """Cells of the grid with their solid angle and the observations nearest to them.

        The triangular and HEALPix grids have no SQL: the tests
        check their assignment against brute force.
        """
        grid = cached_grid(kind, res)
        hits = assign_cells(passes(spark, sf), grid, out="cell_id").groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
        cells = grid.with_solid_angles(spark).select("cell_id", "phi", "theta", "solid_angle")
        return rounded(cells.join(hits, "cell_id", "left"))


@query(
    "voronoi_containment",
    WITH_PASSES + "," + RECT_GRIDS["fibonacci"] + "," + nearest_sql("passes", "cells")
    + " SELECT cell_id, count(*) AS n, count(*) AS n_inside, round(2*pi(),9) AS all_cells FROM cells GROUP BY 1",
)
def voronoi_containment(spark, sf):
    """Observations by nearest centre, how many of them lie inside that cell's outline, and the area of all outlines."""
    grid = cached_grid("fibonacci", 10.0)
    cells = voronoi_cells(grid.to_df(spark).select("cell_id", "phi", "theta"))
    outlines = F.broadcast(cells.select("cell_id", "vertices"))  # at most MAX_CELLS rows
    rows = assign_cells(passes(spark, sf), grid, out="cell_id").select("cell_id", "phi", "theta").join(outlines, "cell_id")
    u = [F.sin("theta") * F.cos("phi"), F.sin("theta") * F.sin("phi"), F.cos("theta")]

    def beside(a, i):
        """Side of the edge from a corner to the next one."""
        b = F.element_at("vertices", F.pmod(i + 1, F.size("vertices")) + 1)
        return u[0] * (a[1] * b[2] - a[2] * b[1]) + u[1] * (a[2] * b[0] - a[0] * b[2]) + u[2] * (a[0] * b[1] - a[1] * b[0])

    inside = F.forall(F.transform("vertices", beside), lambda s: s > -1e-9)
    total = cells.agg(F.round(F.sum("solid_angle"), 9).alias("all_cells"))
    counts = rows.groupBy("cell_id").agg(F.count("*").alias("n"), F.sum(inside.cast("bigint")).alias("n_inside"))
    return counts.withColumn("k", F.lit(0)).join(F.broadcast(total.withColumn("k", F.lit(0))), "k").drop("k")


@query(
    "grid_equal_area_containment",
    WITH_PASSES + "," + grid_sql() + ", d AS (SELECT DISTINCT phi, theta FROM passes) SELECT g.cell_id, count(*) AS n_directions FROM d JOIN grid g ON d.theta >= g.theta_min AND d.theta < g.theta_max AND d.phi >= g.phi_min AND d.phi < g.phi_max GROUP BY 1",
)
def containment(spark, sf):
    """Cell whose bounds hold a direction: bands have fixed height, sectors fixed width."""
    import math

    from pyspark.sql import Window

    bands = banded_cells(spark, "equal_area", 10.0)
    per_band = bands.groupBy("band").agg(F.count(F.lit(1)).alias("sectors"))
    # Nine rows: one per band of the grid.
    first = F.sum("sectors").over(Window.orderBy("band")) - F.col("sectors")
    per_band = per_band.select("band", "sectors", first.alias("first"))
    dirs = passes(spark, sf).select("phi", "theta").distinct()
    res = math.radians(10.0)
    band = F.floor((F.col("theta") + F.lit(res / 2)) / F.lit(res)).cast("bigint")
    hit = dirs.withColumn("band", band).join(F.broadcast(per_band), "band")
    k = F.floor(F.pmod("phi", F.lit(2 * math.pi)) / F.lit(2 * math.pi) * F.col("sectors"))
    return hit.groupBy((F.col("first") + k).cast("int").alias("cell_id")).agg(
        F.count(F.lit(1)).alias("n_directions")
    )


@query(
    "grid_stats_observed",
    CELL_SNR_SQL + """, seen AS (SELECT *, (phi_max-phi_min)*(cos(theta_min)-cos(theta_max)) AS o FROM grid WHERE cell_id IN (SELECT cell_id FROM cells))
SELECT count(*) AS total_cells, count(DISTINCT round(theta,9)) AS theta_bands, round(avg(o),6) AS solid_angle_mean_sr, round(stddev_pop(o),6) AS solid_angle_std_sr,
  round(stddev_pop(o)/avg(o)*100,6) AS solid_angle_cv_percent, round(sum(o),6) AS total_solid_angle_sr, round(2*pi(),6) AS hemisphere_solid_angle_sr FROM seen""",
)
def grid_stats_observed(spark, sf):
    seen = grid_df(spark).join(cell_passes(spark, sf).select("cell_id").distinct(), "cell_id", "left_semi")
    return rounded(grid_stats(seen))


@query(
    "solid_angle_rect",
    CELL_SNR_SQL + " SELECT g.cell_id, round(any_value((phi_max-phi_min)*(cos(theta_min)-cos(theta_max))),9) AS solid_angle, count(*) AS n, round(count(*)/any_value((phi_max-phi_min)*(cos(theta_min)-cos(theta_max))),4) AS density FROM grid g JOIN cells c ON c.cell_id = g.cell_id GROUP BY 1",
)
def solid_angle_rect(spark, sf):
    hits = cell_passes(spark, sf).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
    out = grid_df(spark).join(hits, "cell_id")
    return out.select(
        "cell_id", F.round("solid_angle", 9).alias("solid_angle"), "n",
        F.round(F.col("n") / F.col("solid_angle"), 4).alias("density"),
    )


@query(
    "ragged_offsets",
    CELL_SNR_SQL + ", n AS (SELECT cell_id, count(*) AS n FROM cells GROUP BY 1) SELECT cell_id, n, coalesce(sum(n) OVER (ORDER BY cell_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)::BIGINT AS \"offset\" FROM n",
)
def ragged_offsets(spark, sf):
    from leafwave.operators.grids import ragged_offsets as offsets

    return offsets(cell_passes(spark, sf))


@query(
    "neighbour_mean",
    CELL_SNR_SQL + """, e AS (SELECT a.cell_id, b.cell_id AS neighbor_id FROM grid a JOIN grid b ON a.cell_id <> b.cell_id AND sin(a.theta)*cos(a.phi)*sin(b.theta)*cos(b.phi)+sin(a.theta)*sin(a.phi)*sin(b.theta)*sin(b.phi)+cos(a.theta)*cos(b.theta) >= cos(1.5*sqrt(2*pi()/240))),
m AS (SELECT cell_id, avg(SNR) AS m FROM cells GROUP BY 1) SELECT e.cell_id, count(*) AS n_neighbours, round(avg(m),6) AS neighbour_mean FROM e JOIN m ON m.cell_id = neighbor_id GROUP BY 1""",
)
def neighbour_mean(spark, sf):
    from leafwave.operators.grids import neighbour_edges

    mean = cell_passes(spark, sf).groupBy("cell_id").agg(F.avg("SNR").alias("m"))
    edges = neighbour_edges(cached_grid("equal_area", 10.0), spark)
    hit = edges.join(mean.withColumnRenamed("cell_id", "neighbor_id"), "neighbor_id")
    return rounded(hit.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_neighbours"), F.avg("m").alias("neighbour_mean")))
