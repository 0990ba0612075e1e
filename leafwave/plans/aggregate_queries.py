"""Per-cell, global, diurnal, radial and weighted aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwave.operators import aggregate as agg
from leafwave.operators import timeseries as ts
from leafwave.operators.assign import cached_grid
from leafwave.operators.grids import select_cells
from leafwave.plans.base import query, rounded
from leafwave.plans.retrieval_queries import CELL_OBS_SQL, CELL_PASS_SQL, CELL_VOD_SQL, cell_obs, cell_vod
from leafwave.plans.base import passes

LAT, LON = 48.2, 16.37


def grid_df(spark):
    return cached_grid("equal_area", 10.0).to_df(spark)


PERCELL_SQL = CELL_VOD_SQL + """,
percell AS (SELECT c.cell_id AS cell, date_trunc('day', c.epoch)::TIMESTAMP AS time, avg(VOD) AS v, count(*) AS n,
    any_value(degrees(g.theta)) AS cell_theta, any_value(degrees(g.phi)) AS cell_phi
  FROM cells c JOIN grid g USING (cell_id) GROUP BY 1, 2)"""
# Hourly per-cell series of raw SNR: denser than VOD, for the diurnal reports.
HOURLY_CELL_SQL = CELL_OBS_SQL + """,
percell AS (SELECT c.cell_id AS cell, time_bucket(INTERVAL 15 MINUTE, c.epoch) AS time, avg(SNR) AS v, count(*) AS n,
    any_value(degrees(g.theta)) AS cell_theta
  FROM cells c JOIN grid g USING (cell_id) GROUP BY 1, 2)"""
PASS_CELL_SQL = CELL_PASS_SQL + """,
percell AS (SELECT c.cell_id AS cell, time_bucket(INTERVAL 1 DAY, c.epoch) AS time, avg(VOD) AS v, count(*) AS n,
    any_value(degrees(g.theta)) AS cell_theta
  FROM cells c JOIN grid g USING (cell_id) GROUP BY 1, 2)"""


def percell(spark, sf):
    return agg.percell_timeseries(cell_vod(spark, sf), "1D", cells=grid_df(spark))


def percell_snr(spark, sf):
    return agg.percell_timeseries(cell_obs(spark, sf), "15min", "SNR", cells=grid_df(spark))


def percell_passes(spark, sf):
    return agg.percell_timeseries(cell_vod(spark, sf, passes), "1D", cells=grid_df(spark))


for _stat, _sql in (("mean", "avg(VOD)"), ("median", "median(VOD)"), ("std", "stddev_samp(VOD)")):

    @query(
        f"agg_to_grid_{_stat}",
        CELL_PASS_SQL + f" SELECT g.cell_id, round(a.s, 6) AS vod_stat FROM grid g LEFT JOIN (SELECT cell_id, {_sql} AS s FROM cells GROUP BY 1) a USING (cell_id)",
    )
    def _to_grid(spark, sf, stat=_stat):
        return rounded(agg.aggregate_to_grid(cell_vod(spark, sf, passes), grid_df(spark), stat=stat))


@query("cell_count", CELL_OBS_SQL + " SELECT cell_id, count(SNR) AS n FROM cells GROUP BY 1")
def cell_count(spark, sf):
    return agg.aggregate_by_cell(cell_obs(spark, sf), "SNR", "count", out="n")


@query(
    "percell_timeseries",
    PERCELL_SQL + " SELECT cell, time, round(v,6) AS cell_timeseries, n AS cell_counts, n::DOUBLE AS cell_weights, round(cell_theta,6) AS cell_theta, round(cell_phi,6) AS cell_phi FROM percell",
)
def percell_timeseries(spark, sf):
    return rounded(percell(spark, sf))


@query(
    "percell_min_obs",
    CELL_OBS_SQL + " SELECT cell_id AS cell, date_trunc('day', epoch)::TIMESTAMP AS time, round(avg(SNR),6) AS cell_timeseries, count(*) AS cell_counts, count(*)::DOUBLE AS cell_weights FROM cells GROUP BY 1, 2 HAVING count(*) >= 3",
)
def percell_min_obs(spark, sf):
    return rounded(agg.percell_timeseries(cell_obs(spark, sf), "1D", "SNR", min_obs=3))


@query(
    "zenith_percell",
    CELL_PASS_SQL + """ SELECT c.cell_id AS cell, epoch AS time, round(avg(VOD),6) AS cell_timeseries, count(*) AS cell_counts
  FROM cells c JOIN grid g ON g.cell_id = c.cell_id AND degrees(g.theta) BETWEEN 0 AND 30 GROUP BY 1, 2""",
)
def zenith(spark, sf):
    out = agg.zenith_percell(cell_vod(spark, sf, passes), grid_df(spark))
    return rounded(out.select("cell", "time", "cell_timeseries", "cell_counts"))


@query(
    "hemisphere_percell",
    PASS_CELL_SQL + " SELECT cell, time, round(v,6) AS cell_timeseries, n AS cell_counts FROM percell",
)
def hemisphere(spark, sf):
    out = agg.hemisphere_percell(cell_vod(spark, sf, passes), grid_df(spark))
    return rounded(out.select("cell", "time", "cell_timeseries", "cell_counts"))


@query(
    "global_average",
    PERCELL_SQL + " SELECT time, round(sum(v*n)/sum(n),6) AS global_timeseries, round(stddev_pop(v),6) AS spatial_std, sum(n)::DOUBLE AS total_weights, count(v) AS active_cells FROM percell GROUP BY time",
)
def global_average(spark, sf):
    return rounded(agg.global_average(percell(spark, sf)))


@query(
    "regional_average",
    PERCELL_SQL + " SELECT time, round(sum(v*n)/sum(n),6) AS regional_timeseries FROM percell JOIN grid g ON g.cell_id = cell WHERE degrees(g.theta) BETWEEN 20 AND 60 AND (degrees(g.phi) >= 270 OR degrees(g.phi) <= 90) GROUP BY time",
)
def regional_average(spark, sf):
    region = select_cells(grid_df(spark), (20, 60), (270, 90))
    return rounded(agg.regional_average(percell(spark, sf), region))


@query(
    "diurnal_hour_per_cell",
    HOURLY_CELL_SQL + " SELECT cell, hour(time)::INT AS hour, round(avg(v),6) AS cell_timeseries, round(avg(n),6) AS cell_weights FROM percell GROUP BY 1, 2",
)
def diurnal_hour(spark, sf):
    return rounded(agg.diurnal_pattern(percell_snr(spark, sf)))


@query(
    "spatial_pattern",
    PERCELL_SQL + " SELECT cell, round(avg(v),6) AS cell_timeseries, round(avg(n),6) AS cell_weights FROM percell GROUP BY 1",
)
def spatial_pattern(spark, sf):
    return rounded(agg.spatial_pattern(percell(spark, sf)))


@query(
    "spatial_statistics",
    CELL_PASS_SQL + """ SELECT g.cell_id, round(a.m,6) AS mean, round(a.s,6) AS std, coalesce(a.n,0) AS count, round(a.med,6) AS median
  FROM grid g LEFT JOIN (SELECT cell_id, avg(VOD) AS m, stddev_samp(VOD) AS s, count(*) AS n, median(VOD) AS med FROM cells GROUP BY 1) a USING (cell_id)""",
)
def spatial_statistics(spark, sf):
    return rounded(agg.spatial_statistics(cell_vod(spark, sf, passes), grid_df(spark)))


@query(
    "spatial_coverage",
    CELL_VOD_SQL + " SELECT round(count(DISTINCT cell_id)*100.0/(SELECT count(*) FROM grid),6) AS coverage_percent FROM cells",
)
def spatial_coverage(spark, sf):
    return rounded(agg.coverage_percent(agg.spatial_statistics(cell_vod(spark, sf), grid_df(spark))))


DYN_SQL = HOURLY_CELL_SQL + ", per_time AS (SELECT time, sum(v*n)/sum(n) AS v FROM percell GROUP BY time)"


@query(
    "diurnal_hour",
    DYN_SQL + " SELECT hour(time)::INT AS hour, round(avg(v),6) AS mean, round(stddev_pop(v),6) AS std, count(v) AS count FROM per_time GROUP BY 1",
)
def diurnal_dynamics(spark, sf):
    return rounded(agg.diurnal_dynamics(percell_snr(spark, sf)))


@query(
    "diurnal_30min",
    DYN_SQL + " SELECT (hour(time)*2 + CASE WHEN minute(time)>=30 THEN 1 ELSE 0 END)::INT AS half_hour, any_value(printf('%02d:%02d', hour(time), CASE WHEN minute(time)>=30 THEN 30 ELSE 0 END)) AS label, round(avg(v),6) AS mean, round(stddev_pop(v),6) AS std, count(v) AS count FROM per_time GROUP BY 1",
)
def diurnal_30min(spark, sf):
    return rounded(agg.diurnal_dynamics_30min(percell_snr(spark, sf)))


@query(
    "diurnal_averaged_datasets",
    CELL_OBS_SQL + """,
pc AS (SELECT receiver, cell_id, time_bucket(INTERVAL 15 MINUTE, epoch) AS time, avg(SNR) AS v, count(*) AS n FROM cells GROUP BY 1, 2, 3),
pt AS (SELECT receiver, time, sum(v*n)/sum(n) AS v FROM pc GROUP BY 1, 2),
dyn AS (SELECT receiver, hour(time)::INT AS hour, avg(v) AS m, stddev_pop(v) AS s, count(v) AS n FROM pt GROUP BY 1, 2)
SELECT hour, round(avg(m),6) AS mean, round(sqrt(sum(s*s))/count(*),6) AS std, sum(n)::BIGINT AS count FROM dyn GROUP BY hour HAVING count(*) = (SELECT count(DISTINCT receiver) FROM dyn)""",
)
def diurnal_averaged(spark, sf):
    rows = cell_obs(spark, sf)
    dyn = None
    for name in ("canopy", "reference"):
        side = rows.where(F.col("receiver") == name)
        one = agg.diurnal_dynamics(agg.percell_timeseries(side, "15min", "SNR")).withColumn("dataset", F.lit(name))
        dyn = one if dyn is None else dyn.unionByName(one)
    return rounded(agg.averaged_diurnal(dyn))


@query(
    "diurnal_value_distribution",
    HOURLY_CELL_SQL + " SELECT hour(time)::INT AS hour, cell, round(v,6) AS value FROM percell",
)
def hourly_values(spark, sf):
    return rounded(agg.hourly_values(percell_snr(spark, sf)))


POLAR = "CASE WHEN 90-cell_theta >= 0 AND 90-cell_theta < 90 THEN floor((90-cell_theta)/5.0)::INT END"


@query(
    "radial_distribution",
    PASS_CELL_SQL + f""",
pc AS (SELECT cell, avg(v) AS value, any_value(cell_theta) AS cell_theta FROM percell GROUP BY cell),
b AS (SELECT {POLAR} AS polar_bin, value FROM pc)
SELECT polar_bin, (polar_bin+0.5)*5.0::DOUBLE AS bin_centre, round(avg(value),6) AS mean, round(stddev_pop(value),6) AS std, count(*) AS n_cells FROM b WHERE polar_bin IS NOT NULL GROUP BY 1, 2""",
)
def radial(spark, sf):
    return rounded(agg.radial_distribution(percell_passes(spark, sf)))


@query(
    "radial_values",
    PERCELL_SQL + f""",
pc AS (SELECT cell, avg(v) AS value, any_value(cell_theta) AS cell_theta FROM percell GROUP BY cell)
SELECT {POLAR} AS polar_bin, ({POLAR}+0.5)*5.0::DOUBLE AS bin_centre, cell, round(value,6) AS value FROM pc WHERE {POLAR} IS NOT NULL""",
)
def radial_values(spark, sf):
    return rounded(agg.radial_values(percell(spark, sf)))


@query(
    "radial_averaged_datasets",
    CELL_OBS_SQL + f""",
pc AS (SELECT receiver, c.cell_id AS cell, time_bucket(INTERVAL 15 MINUTE, c.epoch) AS time, avg(SNR) AS v, any_value(degrees(g.theta)) AS cell_theta FROM cells c JOIN grid g USING (cell_id)
  WHERE NOT (receiver = 'canopy' AND degrees(g.theta) > 62) GROUP BY 1, 2, 3),
v AS (SELECT receiver, cell, avg(v) AS value, any_value(cell_theta) AS cell_theta FROM pc GROUP BY 1, 2),
b AS (SELECT receiver, {POLAR} AS polar_bin, value FROM v)
SELECT polar_bin, (polar_bin+0.5)*5.0::DOUBLE AS bin_centre, round(avg(value),6) AS mean, round(stddev_pop(value),6) AS std, count(*) AS n_cells
FROM b WHERE polar_bin IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT receiver) = (SELECT count(DISTINCT receiver) FROM pc)""",
)
def radial_averaged(spark, sf):
    """Both receivers' cells together; under the canopy low cells are hidden, so their bins are not common."""
    rows, grid = cell_obs(spark, sf), grid_df(spark)
    sets = None
    for name in ("canopy", "reference"):
        one = agg.percell_timeseries(rows.where(F.col("receiver") == name), "15min", "SNR", cells=grid).withColumn("dataset", F.lit(name))
        one = one.where(~((F.col("dataset") == "canopy") & (F.col("cell_theta") > 62)))
        sets = one if sets is None else sets.unionByName(one)
    return rounded(agg.averaged_radial(sets))


for _group, _expr in (
    ("diurnal", "hour(time)::INT"),
    ("daily", "strftime(time, '%Y-%m-%d')"),
    ("weekly", "weekofyear(time)::INT"),
    ("monthly", "month(time)::INT"),
):
    _src = HOURLY_CELL_SQL if _group == "diurnal" else PASS_CELL_SQL

    @query(
        f"theta_time_heatmap_{_group}",
        _src + f" SELECT {POLAR} AS polar_bin, {_expr} AS time_group, round(avg(v),6) AS mean FROM percell WHERE {POLAR} IS NOT NULL GROUP BY 1, 2",
    )
    def _heatmap(spark, sf, group=_group):
        series = percell_snr if group == "diurnal" else percell_passes
        return rounded(agg.theta_time_heatmap(series(spark, sf), group))


@query(
    "theta_timestamp_heatmap",
    PERCELL_SQL + f" SELECT {POLAR} AS polar_bin, time, round(avg(v),6) AS mean FROM percell WHERE {POLAR} IS NOT NULL GROUP BY 1, 2",
)
def heatmap_timestamps(spark, sf):
    return rounded(agg.theta_timestamp_heatmap(percell(spark, sf)))


@query(
    "theta_time_heatmap_averaged",
    CELL_OBS_SQL + f""",
pc AS (SELECT receiver, c.cell_id, time_bucket(INTERVAL 15 MINUTE, epoch) AS time, avg(SNR) AS v, any_value(degrees(g.theta)) AS cell_theta
  FROM cells c JOIN grid g USING (cell_id) GROUP BY 1, 2, 3),
h AS (SELECT receiver, {POLAR} AS polar_bin, month(time)::INT AS time_group, avg(v) AS m FROM pc WHERE {POLAR} IS NOT NULL GROUP BY 1, 2, 3)
SELECT polar_bin, time_group, round(avg(m),6) AS mean FROM h GROUP BY 1, 2""",
)
def heatmap_averaged(spark, sf):
    rows, cells, maps = cell_obs(spark, sf), grid_df(spark), None
    for name in ("canopy", "reference"):
        pc = agg.percell_timeseries(rows.where(F.col("receiver") == name), "15min", "SNR", cells=cells)
        one = agg.theta_time_heatmap(pc, "monthly")
        maps = one if maps is None else maps.unionByName(one)
    return rounded(agg.averaged_heatmap(maps))


@query(
    "percell_stats",
    PASS_CELL_SQL + " SELECT cell, round(avg(v),6) AS mean, round(stddev_pop(v),6) AS std, sum(n)::BIGINT AS counts FROM percell GROUP BY cell",
)
def percell_stats(spark, sf):
    return rounded(agg.percell_stats(percell_passes(spark, sf)))


@query("percell_median", PASS_CELL_SQL + " SELECT cell, round(median(v),6) AS median FROM percell GROUP BY cell")
def percell_median(spark, sf):
    return rounded(agg.percell_median(percell_passes(spark, sf)))


@query(
    "trend_cv_range",
    PASS_CELL_SQL + """, axis AS (SELECT time, (row_number() OVER (ORDER BY time) - 1)::DOUBLE AS idx FROM (SELECT DISTINCT time FROM percell))
SELECT cell, round(max(v)-min(v),6) AS range, round(CASE WHEN count(v)>3 THEN regr_slope(v, idx) END,6) AS trend, round(stddev_pop(v)/nullif(avg(v),0),6) AS cv FROM percell JOIN axis USING (time) GROUP BY cell""",
)
def trend(spark, sf):
    return rounded(agg.percell_temporal_stats(percell_passes(spark, sf)))


@query(
    "coverage_pct",
    PASS_CELL_SQL + " SELECT cell, round(count(v)*100.0/(SELECT count(DISTINCT time) FROM percell),6) AS coverage_percent FROM percell GROUP BY cell",
)
def coverage(spark, sf):
    return rounded(agg.percell_coverage(percell_passes(spark, sf)))


WEIGHTED = """count(DISTINCT cell_id) AS n_cells, count(*) AS n_observations, round(sum(w),6) AS sum_weights"""
AREA_SQL = "wt AS (SELECT cell_id, s/sum(s) OVER () AS w FROM (SELECT cell_id, (phi_max-phi_min)*(cos(theta_min)-cos(theta_max)) AS s FROM grid))"


def area_weights(spark):
    from leafwave.operators.weights import area_weights as area

    return area(cached_grid("equal_area", 10.0).with_solid_angles(spark))


@query(
    "weighted_timeseries",
    CELL_OBS_SQL + f""", {AREA_SQL},
b AS (SELECT time_bucket(INTERVAL 6 HOUR, epoch) AS epoch, cell_id, SNR AS v, w FROM cells JOIN wt USING (cell_id)),
m AS (SELECT epoch, sum(w*v)/sum(w) AS mean FROM b GROUP BY 1)
SELECT epoch, round(any_value(mean),6) AS mean, round(sqrt(sum(w*(v-mean)*(v-mean))/sum(w)),6) AS std, {WEIGHTED} FROM b JOIN m USING (epoch) GROUP BY 1 HAVING count(DISTINCT cell_id) >= 5""",
)
def weighted_timeseries(spark, sf):
    out = ts.weighted_timeseries(cell_obs(spark, sf), area_weights(spark), "6h", "SNR", min_cells=5)
    return rounded(out)


@query(
    "diurnal_clock_weighted",
    CELL_OBS_SQL + f""", {AREA_SQL},
b AS (SELECT greatest(ceil((hour(epoch)+minute(epoch)/60.0::DOUBLE)*24/24.0::DOUBLE),1)-1 AS bin, SNR AS v, w FROM cells JOIN wt USING (cell_id)),
m AS (SELECT bin, sum(w*v)/sum(w) AS mean FROM b GROUP BY 1),
s AS (SELECT bin, any_value(mean) AS mean, sqrt(sum(w*(v-mean)*(v-mean))/sum(w)) AS std, count(*) AS n FROM b JOIN m USING (bin) GROUP BY 1)
SELECT r.i+0.5::DOUBLE AS hour, round(CASE WHEN n>=10 THEN mean END,6) AS mean, round(CASE WHEN n>=10 THEN std END,6) AS std, CASE WHEN n>=10 THEN n ELSE 0 END AS n_observations FROM range(0,24) r(i) LEFT JOIN s ON s.bin = r.i""",
)
def diurnal_clock(spark, sf):
    return rounded(ts.diurnal_cycle(cell_obs(spark, sf), area_weights(spark), "SNR"))


JD = "(date_diff('day', DATE '1970-01-01', CAST(epoch AS DATE)) + 2440588 + (hour(epoch)-12)/24.0::DOUBLE + minute(epoch)/1440.0::DOUBLE + floor(second(epoch))/86400.0::DOUBLE)"
SUN_SQL = f""",
jc AS (SELECT *, ({JD} - 2451545.0::DOUBLE)/36525.0::DOUBLE AS jc FROM cells),
s1 AS (SELECT *, (280.46646::DOUBLE + jc*(36000.76983::DOUBLE + jc*0.0003032::DOUBLE)) - 360*floor((280.46646::DOUBLE + jc*(36000.76983::DOUBLE + jc*0.0003032::DOUBLE))/360) AS gl,
  357.52911::DOUBLE + jc*(35999.05029::DOUBLE - 0.0001537::DOUBLE*jc) AS ga, 0.016708634::DOUBLE - jc*(0.000042037::DOUBLE + 0.0000001267::DOUBLE*jc) AS ec,
  radians(125.04::DOUBLE - 1934.136::DOUBLE*jc) AS om, 23 + (26 + (21.448::DOUBLE - jc*(46.815::DOUBLE + jc*(0.00059::DOUBLE - jc*0.001813::DOUBLE)))/60)/60 AS ob FROM jc),
s2 AS (SELECT *, gl + sin(radians(ga))*(1.914602::DOUBLE - jc*(0.004817::DOUBLE + 0.000014::DOUBLE*jc)) + sin(radians(2*ga))*(0.019993::DOUBLE - 0.000101::DOUBLE*jc) + sin(radians(3*ga))*0.000289::DOUBLE
  - 0.00569::DOUBLE - 0.00478::DOUBLE*sin(om) AS al, radians(ob + 0.00256::DOUBLE*cos(om)) AS oc FROM s1),
s3 AS (SELECT *, asin(sin(oc)*sin(radians(al))) AS de, pow(tan(oc/2),2) AS y FROM s2),
s4 AS (SELECT *, 4*degrees(y*sin(2*radians(gl)) - 2*ec*sin(radians(ga)) + 4*ec*y*sin(radians(ga))*cos(2*radians(gl)) - 0.5::DOUBLE*y*y*sin(4*radians(gl)) - 1.25::DOUBLE*ec*ec*sin(2*radians(ga))) + 4*{LON}::DOUBLE
  + (hour(epoch)+minute(epoch)/60.0::DOUBLE+floor(second(epoch))/3600.0::DOUBLE)*60 AS tst0 FROM s3),
s5 AS (SELECT *, (tst0 - 1440*floor(tst0/1440))/4 - 180 AS ha0 FROM s4),
s6 AS (SELECT *, radians(CASE WHEN ha0 < 0 THEN ha0+360 ELSE ha0 END) AS ha FROM s5),
sun AS (SELECT *, 90 - degrees(acos(sin(radians({LAT}::DOUBLE))*sin(de) + cos(radians({LAT}::DOUBLE))*cos(de)*cos(ha))) AS elev FROM s6)"""


@query(
    "solar_elevation",
    CELL_OBS_SQL + SUN_SQL + " SELECT receiver, epoch, sid, round(elev,6) AS solar_elevation, elev > -6 AS is_daytime FROM sun",
)
def solar_elevation(spark, sf):
    out = ts.with_solar_metadata(cell_obs(spark, sf), LAT, LON)
    return rounded(out.select("receiver", "epoch", "sid", "solar_elevation", "is_daytime"))


@query(
    "diurnal_solar",
    CELL_OBS_SQL + SUN_SQL + f""", {AREA_SQL},
b AS (SELECT greatest(least(floor((elev+20)/(110.0::DOUBLE/12)),11),0) AS bin, SNR AS v, w FROM sun JOIN wt USING (cell_id)),
m AS (SELECT bin, sum(w*v)/sum(w) AS mean FROM b GROUP BY 1),
s AS (SELECT bin, any_value(mean) AS mean, sqrt(sum(w*(v-mean)*(v-mean))/sum(w)) AS std, count(*) AS n FROM b JOIN m USING (bin) GROUP BY 1)
SELECT round(-20 + (110.0::DOUBLE/12)*(r.i+0.5),6) AS solar_elevation, round(CASE WHEN n>=10 THEN mean END,6) AS mean, round(CASE WHEN n>=10 THEN std END,6) AS std, CASE WHEN n>=10 THEN n ELSE 0 END AS n_observations FROM range(0,12) r(i) LEFT JOIN s ON s.bin = r.i""",
)
def diurnal_solar(spark, sf):
    return rounded(ts.diurnal_cycle_solar(cell_obs(spark, sf), area_weights(spark), LAT, LON, "SNR"))


@query(
    "solar_corrected_timeseries",
    CELL_OBS_SQL + SUN_SQL + f""", {AREA_SQL},
b AS (SELECT date_trunc('day', epoch)::TIMESTAMP AS epoch, cell_id, w,
   SNR*least(greatest(cos(radians(45.0::DOUBLE))/cos(radians(90-elev)),0.5),2.0) AS v FROM sun JOIN wt USING (cell_id) WHERE elev > -6),
m AS (SELECT epoch, sum(w*v)/sum(w) AS mean FROM b GROUP BY 1)
SELECT epoch, round(any_value(mean),6) AS mean, round(sqrt(sum(w*(v-mean)*(v-mean))/sum(w)),6) AS std, {WEIGHTED} FROM b JOIN m USING (epoch) GROUP BY 1""",
)
def solar_corrected(spark, sf):
    return rounded(
        ts.weighted_timeseries_solar(cell_obs(spark, sf), area_weights(spark), LAT, LON, "1D", "SNR", daytime=True)
    )


@query(
    "daytime_filter",
    CELL_OBS_SQL + SUN_SQL + " SELECT receiver, count(*) AS n, round(avg(SNR),6) AS mean_snr FROM sun WHERE elev > -6 GROUP BY 1",
)
def daytime(spark, sf):
    from leafwave.functions.solar import daytime_only

    rows = daytime_only(cell_obs(spark, sf), LAT, LON)
    return rounded(rows.groupBy("receiver").agg(F.count(F.lit(1)).alias("n"), F.avg("SNR").alias("mean_snr")))


@query(
    "sunrise_sunset",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
cells AS (SELECT day, CAST(day AS TIMESTAMP) + to_minutes(i) AS epoch FROM d, range(0,1440) r(i))"""
    + SUN_SQL + " SELECT day AS date, min(CASE WHEN elev>0 THEN epoch END) AS sunrise, max(CASE WHEN elev>0 THEN epoch END) AS sunset FROM sun GROUP BY 1",
)
def sunrise(spark, sf):
    from leafwave.functions.solar import sunrise_sunset
    from leafwave.plans.base import table

    return sunrise_sunset(table(spark, sf, "events").select(F.to_date("ts").alias("date")), LAT, LON)


@query("solar_residual_correction")
def residual(spark, sf):
    """No SQL: a fourth-degree fit; the tests compare it with a direct least-squares fit."""
    from leafwave.functions.solar import residual_correction

    out = residual_correction(cell_obs(spark, sf), "SNR")
    return rounded(out.select("receiver", "epoch", "sid", "SNR", "SNR_corrected"))
