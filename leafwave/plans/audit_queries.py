"""Dataset comparison, quality checks and small reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwave.functions import timeutil as tu
from leafwave.operators import audit as au
from leafwave.operators import quality as ql
from leafwave.plans.base import OBS_SQL, PASSES_SQL, obs, passes, query, rounded, table
from leafwave.plans.retrieval_queries import DAILY_SQL, PASS_VOD_SQL, sides, vod_table

STAT_SQL = """st AS (SELECT variable, count(*) AS n_total, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS n_compared,
  count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS n_a_only, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS n_b_only,
  count(*) FILTER (WHERE a IS NULL AND b IS NULL) AS n_neither, count(*) FILTER (WHERE abs(a-b) > 0) AS n_nonzero_diff,
  max(abs(a-b)) AS max_abs_diff, sqrt(avg((a-b)*(a-b))) AS rmse, avg(abs(a-b)) AS mae, avg(a-b) AS bias, corr(a,b) AS correlation,
  avg(CASE WHEN (a IS NULL) = (b IS NULL) THEN 1.0 ELSE 0.0 END)::DOUBLE AS nan_agreement,
  quantile_cont(abs(a-b),0.5) AS p50, quantile_cont(abs(a-b),0.9) AS p90, quantile_cont(abs(a-b),0.99) AS p99 FROM pairs GROUP BY variable)"""
PAIRS_SQL = DAILY_SQL + """, ca AS (SELECT * FROM daily WHERE receiver='canopy'), re AS (SELECT * FROM daily WHERE receiver='reference'),
pairs AS (""" + " UNION ALL ".join(
    f"SELECT '{v}' AS variable, ca.{v} AS a, re.{v} AS b FROM ca FULL JOIN re ON ca.epoch = re.epoch AND ca.sid = re.sid"
    for v in ("SNR", "phi", "theta")
) + ")"
ROUNDED = "variable, n_total, n_compared, n_a_only, n_b_only, n_neither, n_nonzero_diff, " + ", ".join(
    f"round({c},6) AS {c}" for c in (
        "max_abs_diff", "rmse", "mae", "bias", "correlation", "nan_agreement", "p50", "p90", "p99")
)


def stats(spark, sf):
    return au.variable_stats(*sides(spark, sf), ["SNR", "phi", "theta"])


@query("audit_diff_stats", f"WITH {PAIRS_SQL}, {STAT_SQL} SELECT {ROUNDED} FROM st")
def diff_stats(spark, sf):
    return rounded(stats(spark, sf))


@query(
    "audit_verdicts",
    f"""WITH {PAIRS_SQL}, {STAT_SQL}, v AS (SELECT variable, CASE variable WHEN 'SNR' THEN 0.25 ELSE 0.05 END AS atol, CASE variable WHEN 'SNR' THEN 0.01 ELSE 0.0 END AS rate,
  max_abs_diff, abs((n_b_only+n_neither)/n_total - (n_a_only+n_neither)/n_total) AS d FROM st)
SELECT variable, CASE WHEN max_abs_diff > atol THEN 'max difference' WHEN d > rate THEN 'missing rate' ELSE '' END AS reason, NOT (max_abs_diff > atol OR d > rate) AS passed FROM v""",
)
def audit_verdicts(spark, sf):
    return au.verdicts(stats(spark, sf), "scientific").select("variable", "reason", "passed")


@query(
    "audit_diff_budget",
    f"""WITH {PAIRS_SQL}, {STAT_SQL} SELECT variable, n_compared AS n_both, n_a_only, n_b_only, round(max_abs_diff,6) AS max_abs_diff, round(mae,6) AS mean_abs, round(bias,6) AS bias, round(rmse,6) AS rmse, round(p50,6) AS p50, round(p99,6) AS p99,
  CASE variable WHEN 'SNR' THEN 40.0::DOUBLE WHEN 'phi' THEN 0.5::DOUBLE END AS budget, coalesce(max_abs_diff > CASE variable WHEN 'SNR' THEN 40.0 WHEN 'phi' THEN 0.5 END, false) AS exceeds_budget FROM st""",
)
def diff_budget(spark, sf):
    a, b = sides(spark, sf)
    return rounded(au.diff_report(a, b, ["SNR", "phi", "theta"], {"SNR": 40.0, "phi": 0.5}))


@query(
    "audit_alignment",
    f"""WITH {OBS_SQL}, ca AS (SELECT * FROM obs WHERE receiver='canopy'), re AS (SELECT * FROM obs WHERE receiver='reference'),
n AS (SELECT 'epoch' AS axis, (SELECT count(*) FROM (SELECT epoch FROM ca INTERSECT SELECT epoch FROM re)) AS shared, (SELECT count(DISTINCT epoch) FROM ca) AS na, (SELECT count(DISTINCT epoch) FROM re) AS nb
 UNION ALL SELECT 'sid', (SELECT count(*) FROM (SELECT sid FROM ca INTERSECT SELECT sid FROM re)), (SELECT count(DISTINCT sid) FROM ca), (SELECT count(DISTINCT sid) FROM re))
SELECT axis, shared, na-shared AS dropped_a, nb-shared AS dropped_b, round((na+nb-2*shared)/(na+nb-shared),6) AS dropped_share, (na+nb-2*shared)/(na+nb-shared) > 0.05 AS warn FROM n""",
)
def alignment(spark, sf):
    o = obs(spark, sf)
    return rounded(au.alignment_report(o.where("receiver = 'canopy'"), o.where("receiver = 'reference'")))


@query(
    "audit_aligned_rows",
    "WITH " + DAILY_SQL + """, ca AS (SELECT * FROM daily WHERE receiver='canopy'), re AS (SELECT * FROM daily WHERE receiver='reference')
SELECT sid, count(*) AS n FROM ca WHERE epoch IN (SELECT epoch FROM re) AND sid IN (SELECT sid FROM re) GROUP BY 1""",
)
def aligned_rows(spark, sf):
    a, _ = au.align(*sides(spark, sf))
    return a.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))


DEC_SQL = PASS_VOD_SQL + """, r AS (SELECT VOD AS vod_a, 90-degrees(theta) AS ea, (90-degrees(theta))*0.995::DOUBLE AS eb FROM vod),
r2 AS (SELECT *, cos(radians(90-ea)) AS ca, cos(radians(90-eb)) AS cb FROM r), r3 AS (SELECT *, vod_a/ca*cb + delta AS vod_b FROM (SELECT *, 0.001::DOUBLE*sin(ea) AS delta FROM r2)),
k AS (SELECT *, vod_a-vod_b AS d, vod_a/ca*(ca-cb) AS p FROM r3 WHERE ea > 5 AND eb > 5), k2 AS (SELECT *, d-p AS e FROM k)"""


@query(
    "audit_vod_decomposition",
    f"WITH {DEC_SQL} SELECT count(*) AS n_valid, (SELECT count(*) FROM r3) - count(*) AS n_excluded_horizon, round(sqrt(avg(d*d)),6) AS actual_rmse, round(max(abs(d)),6) AS actual_max, round(sqrt(avg(p*p)),6) AS predicted_rmse, round(max(abs(p)),6) AS predicted_max, round(sqrt(avg(e*e)),6) AS residual_rmse, round(max(abs(e)),6) AS residual_max, round(1-var_pop(e)/var_pop(d),6) AS explained_fraction, max(abs(e)) > 9.210340371976183e-06 AS residual_exceeds_noise FROM k2",
)
def decomposition(spark, sf):
    v = vod_table(spark, sf, passes)
    ea = F.lit(90.0) - F.degrees("theta")
    r = v.select(F.col("VOD").alias("vod_a"), ea.alias("elevation_a"), (ea * F.lit(0.995)).alias("elevation_b"))
    cos = lambda c: F.cos(F.radians(F.lit(90.0) - F.col(c)))
    r = r.withColumn(
        "vod_b",
        F.col("vod_a") / cos("elevation_a") * cos("elevation_b") + F.lit(0.001) * F.sin("elevation_a"),
    )
    return rounded(au.decompose_vod_difference(r))


CODES_SQL = """codes AS (SELECT l_shipdate AS epoch, 'G' || lpad(CAST(l_suppkey % 32 + 1 AS VARCHAR),2,'0') || '|L' || CAST(l_linenumber % 2 + 1 AS VARCHAR) || '|' || CASE l_returnflag WHEN 'A' THEN 'W' WHEN 'N' THEN 'C' ELSE 'X' END AS sid,
  avg(CASE WHEN l_tax > 0.02 THEN 20.0::DOUBLE + l_quantity*0.5::DOUBLE END) AS SNR, avg(CASE WHEN l_discount > 0.03 THEN l_discount*10 END) AS theta FROM lineitem GROUP BY 1, 2)"""


def codes(spark, sf):
    li = table(spark, sf, "lineitem")
    code = F.when(F.col("l_returnflag") == "A", "W").when(F.col("l_returnflag") == "N", "C").otherwise("X")
    sid = F.concat(
        F.lit("G"), F.lpad((F.pmod("l_suppkey", F.lit(32)) + 1).cast("string"), 2, "0"), F.lit("|L"),
        (F.pmod("l_linenumber", F.lit(2)) + 1).cast("string"), F.lit("|"), code,
    )
    return li.groupBy(F.col("l_shipdate").alias("epoch"), sid.alias("sid")).agg(
        F.avg(F.when(F.col("l_tax") > 0.02, F.lit(20.0) + F.col("l_quantity") * F.lit(0.5))).alias("SNR"),
        F.avg(F.when(F.col("l_discount") > 0.03, F.col("l_discount") * 10)).alias("theta"),
    )


@query(
    "merge_codes_first",
    f"WITH {CODES_SQL} SELECT epoch, split_part(sid,'|',1) AS sid, round(arg_min(SNR, sid) FILTER (WHERE SNR IS NOT NULL),6) AS SNR, round(arg_min(theta, sid) FILTER (WHERE theta IS NOT NULL),6) AS theta FROM codes WHERE sid LIKE '%|L1|%' GROUP BY epoch, split_part(sid,'|',1)",
)
def merge_codes(spark, sf):
    return rounded(au.merge_codes(codes(spark, sf), "1", ["SNR", "theta"]))


@query(
    "detect_bands",
    f"""WITH {CODES_SQL}, b AS (SELECT DISTINCT substr(split_part(sid,'|',2),2,1) AS band_number, split_part(sid,'|',3) AS code FROM codes)
SELECT band_number, CASE WHEN band_number='1' AND bool_or(code='W') THEN 'W' WHEN band_number='1' AND bool_or(code='C') THEN 'C' WHEN band_number='2' AND bool_or(code='L') THEN 'L' ELSE min(code) END AS code,
  CASE WHEN band_number='1' AND NOT bool_or(code='W') AND bool_or(code='C') THEN 'S1C' WHEN band_number='1' THEN 'S1W' ELSE 'S2L' END AS snr_column FROM b GROUP BY 1""",
)
def detect_bands(spark, sf):
    return au.detect_bands(codes(spark, sf), ["Azimuth", "S1W", "S1C", "S2L", "VOD1"])


@query(
    "pick_codes",
    f"WITH {CODES_SQL} SELECT split_part(sid,'|',2) AS band, CASE WHEN bool_or(sid LIKE '%|P') THEN 'P' WHEN bool_or(sid LIKE '%|X') THEN 'X' WHEN bool_or(sid LIKE '%|C') THEN 'C' ELSE min(split_part(sid,'|',3)) END AS code FROM codes GROUP BY 1",
)
def pick_codes(spark, sf):
    return au.pick_codes(codes(spark, sf), ["P", "X", "C"])


@query(
    "external_frame",
    "WITH " + DAILY_SQL + " SELECT epoch, substr(sid,1,3) AS sid, round(SNR,6) AS S1C, round(degrees(phi),6) AS Azimuth, round(90-degrees(theta),6) AS Elevation FROM daily WHERE receiver='canopy' AND sid LIKE '%|L1|C'",
)
def external_frame(spark, sf):
    return rounded(au.external_frame(sides(spark, sf)[0], "L1", "C", "S1C"))


@query(
    "external_long_pivot",
    "SELECT date_trunc('hour', ts)::TIMESTAMP AS epoch, 'G' || CAST(user_id AS VARCHAR) AS sid, round(avg(value),6) AS S1C FROM events GROUP BY 1, 2",
)
def external_long(spark, sf):
    e = table(spark, sf, "events").select(
        tu.floor_epoch("ts", "1h").alias("Epoch"), F.concat(F.lit("G"), F.col("user_id").cast("string")).alias("SV"),
        F.col("value").alias("S1C"),
    )
    return rounded(au.external_long(e, ["S1C"]))


WRAP_SQL = DAILY_SQL + """, f AS (SELECT receiver, epoch, substr(sid,1,3) AS sid, SNR AS S1C, degrees(phi) AS az, 90-degrees(theta) AS el FROM daily WHERE sid LIKE '%|L1|C'),
j AS (SELECT a.S1C AS sa, b.S1C AS sb, CASE WHEN a.az-b.az > 180 THEN a.az-360 WHEN a.az-b.az < -180 THEN a.az+360 ELSE a.az END AS aa, b.az AS ab, a.el AS ea, b.el AS eb
  FROM (SELECT * FROM f WHERE receiver='canopy') a JOIN (SELECT * FROM f WHERE receiver='reference') b USING (epoch, sid)),
pairs AS (SELECT 'S1C' AS variable, sa AS a, sb AS b FROM j UNION ALL SELECT 'Azimuth', aa, ab FROM j UNION ALL SELECT 'Elevation', ea, eb FROM j)"""


@query("azimuth_wrap_diff", f"WITH {WRAP_SQL}, {STAT_SQL} SELECT {ROUNDED} FROM st")
def azimuth_wrap(spark, sf):
    a, b = (au.external_frame(s, "L1", "C", "S1C") for s in sides(spark, sf))
    return rounded(au.compare_band(a, b, "S1C"))


# -- quality ------------------------------------------------------------------


@query(
    "sampling_interval_mode",
    f"""WITH {PASSES_SQL}, e AS (SELECT DISTINCT sid, epoch FROM passes), g AS (SELECT sid, CAST(floor((epoch_us(epoch)-lag(epoch_us(epoch)) OVER (PARTITION BY sid ORDER BY epoch))/1e6) AS BIGINT) AS d FROM e),
c AS (SELECT sid, d, count(*) AS n FROM g WHERE d > 0 GROUP BY 1, 2) SELECT sid, arg_max(d, (n, -d)) AS interval_s FROM c GROUP BY 1""",
)
def sampling_interval(spark, sf):
    return ql.sampling_interval(passes(spark, sf), ["sid"])


GAP_SQL = f"WITH {OBS_SQL}, e AS (SELECT DISTINCT receiver, epoch FROM obs), g AS (SELECT receiver, epoch, lag(epoch) OVER (PARTITION BY receiver ORDER BY epoch) AS prev_epoch FROM e)"


@query(
    "epoch_gaps",
    GAP_SQL + " SELECT receiver, epoch, prev_epoch, round((epoch_us(epoch)-epoch_us(prev_epoch))/1e6,6) AS gap_s FROM g WHERE prev_epoch IS NOT NULL",
)
def epoch_gaps(spark, sf):
    return rounded(ql.epoch_gaps(obs(spark, sf), ["receiver"]))


@query(
    "large_gaps_first",
    f"""WITH {OBS_SQL}, e AS (SELECT DISTINCT epoch FROM obs), g AS (SELECT epoch, lag(epoch) OVER (ORDER BY epoch) AS prev_epoch FROM e),
h AS (SELECT *, (epoch_us(epoch)-epoch_us(prev_epoch))/1e6 AS gap_s FROM g WHERE prev_epoch IS NOT NULL)
SELECT epoch, prev_epoch, round(gap_s,6) AS gap_s FROM h WHERE gap_s > 3*(SELECT median(gap_s) FROM h) ORDER BY epoch LIMIT 10""",
)
def large_gaps(spark, sf):
    return rounded(ql.large_gaps(obs(spark, sf)))


@query(
    "missing_ratio",
    f"WITH {CODES_SQL} SELECT 'SNR' AS variable, round(avg(CASE WHEN SNR IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE,6) AS missing_ratio FROM codes UNION ALL SELECT 'theta', round(avg(CASE WHEN theta IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE,6) FROM codes",
)
def missing_ratio(spark, sf):
    return rounded(ql.missing_ratio(codes(spark, sf), ["SNR", "theta"]))


@query(
    "ingest_qc",
    f"""WITH {PASSES_SQL}, q AS (SELECT receiver, count(*) AS n_rows, count(DISTINCT epoch) AS n_epochs, count(*) FILTER (WHERE SNR < 0 OR SNR > 70) AS bad_snr,
  count(*) FILTER (WHERE theta < -0.01 OR theta > pi()/2+0.01) AS bad_theta, count(*) FILTER (WHERE phi < -0.01 OR phi > 2*pi()+0.01) AS bad_phi FROM passes GROUP BY 1)
SELECT *, CASE WHEN bad_snr+bad_theta+bad_phi > 0 THEN 'out_of_range' ELSE 'ok' END AS verdict FROM q""",
)
def ingest_qc(spark, sf):
    return ql.ingest_check(passes(spark, sf))


@query(
    "day_completeness",
    f"WITH {OBS_SQL} SELECT receiver, CAST(epoch AS DATE) AS day, count(DISTINCT epoch) AS n_epochs, count(DISTINCT epoch) >= 171 AS complete FROM obs GROUP BY 1, 2",
)
def day_completeness(spark, sf):
    return ql.day_completeness(obs(spark, sf), expected=180)


@query(
    "epoch_completeness",
    f"WITH {PASSES_SQL} SELECT sid, count(DISTINCT epoch) AS n_epochs, count(DISTINCT epoch)*86400 = 2499*86400 AS complete FROM passes GROUP BY 1",
)
def epoch_completeness(spark, sf):
    return ql.completeness(passes(spark, sf), ["sid"], 86400.0, 2499 * 86400.0)


@query(
    "ephemeris_check",
    "SELECT count(*) AS n_rows, round(avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END)::DOUBLE*100,6) AS missing_percent, CASE WHEN avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END) > 0.5 THEN 'error' WHEN avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END) > 0.1 THEN 'warning' ELSE 'ok' END AS verdict FROM orders",
)
def ephemeris_check(spark, sf):
    x = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return rounded(ql.ephemeris_check(table(spark, sf, "orders").select(x.alias("X"), x.alias("Y"), x.alias("Z"))))


@query(
    "clock_check",
    "WITH k AS (SELECT o_orderdate AS epoch, o_custkey AS sv, count(*) AS n, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS v FROM orders GROUP BY 1, 2) SELECT count(DISTINCT epoch) AS n_epochs, count(DISTINCT sv) AS n_satellites, round(sum(v)*100.0::DOUBLE/sum(n),6) AS valid_percent, max(n) = 1 AS epochs_monotonic, sum(v)*100.0/sum(n) >= 80 AND max(n) = 1 AS usable FROM k",
)
def clock_check(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("epoch"), F.col("o_custkey").cast("string").alias("sv"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("clock_offset"),
    )
    return rounded(ql.clock_check(o))


@query("approx_quantiles")
def approx_quantiles(spark, sf):
    """Sketch output depends on partitioning within its error bound, so there is no SQL."""
    return ql.distribution_summary(obs(spark, sf), "SNR", ["receiver"]).select("receiver", "n", "quantiles")


@query(
    "bottlenecks_topn",
    """WITH t AS (SELECT event_type || '_' || CAST(user_id AS VARCHAR) AS operation, sum(value) AS s, avg(value) AS m, count(value) AS n FROM events GROUP BY 1 ORDER BY s DESC, operation LIMIT 10)
SELECT operation, round(s,3) AS total_s, round(m,3) AS mean_s, n AS count, round(s/sum(s) OVER ()*100,1) AS pct FROM t""",
)
def bottlenecks(spark, sf):
    t = table(spark, sf, "events").select(
        F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("operation"),
        F.col("value").alias("duration_s"),
    )
    return rounded(au.bottlenecks(t))


@query(
    "metrics_latest",
    "SELECT ts, event_type AS operation, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND event_type LIKE 'c%' ORDER BY ts DESC LIMIT 50",
)
def metrics_latest(spark, sf):
    m = table(spark, sf, "events").select("ts", F.col("event_type").alias("operation"), "user_id", "value")
    from datetime import datetime

    return au.query_metrics(m, datetime(2024, 1, 10), "c%", limit=50)


# -- dates ----------------------------------------------------------------------


@query(
    "gps_week",
    "SELECT DISTINCT CAST(ts AS DATE) AS day, (date_diff('day', DATE '1980-01-06', CAST(ts AS DATE)) // 7)::INT AS gps_week, (date_diff('day', DATE '1980-01-06', CAST(ts AS DATE)) % 7)::INT AS gps_dow FROM events",
)
def gps_week(spark, sf):
    days = table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct()
    return days.select("day", tu.gps_week("day").alias("gps_week"), tu.gps_day_of_week("day").alias("gps_dow"))


@query(
    "yyyydoy",
    "SELECT DISTINCT o_orderdate AS epoch, strftime(o_orderdate, '%Y%j') AS yyyydoy, CAST(o_orderdate AS DATE) AS back FROM orders",
)
def yyyydoy(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").alias("epoch")).distinct()
    keyed = days.withColumn("yyyydoy", tu.yyyydoy("epoch"))
    return keyed.withColumn("back", tu.date_of_yyyydoy("yyyydoy"))


@query(
    "date_key_filter",
    "SELECT strftime(o_orderdate, '%Y%j') AS yyyydoy, count(*) AS n FROM orders WHERE strftime(o_orderdate, '%Y%j') BETWEEN '1996032' AND '1998200' GROUP BY 1",
)
def date_key_filter(spark, sf):
    o = table(spark, sf, "orders").withColumn("yyyydoy", tu.yyyydoy("o_orderdate"))
    return o.where(F.col("yyyydoy").between("1996032", "1998200")).groupBy("yyyydoy").agg(F.count(F.lit(1)).alias("n"))


@query(
    "time_range_filter",
    f"WITH {PASSES_SQL} SELECT receiver, count(*) AS n, min(epoch) AS first, max(epoch) AS last FROM passes WHERE epoch BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1999-02-28' GROUP BY 1",
)
def time_range(spark, sf):
    from datetime import datetime

    rows = passes(spark, sf).where(tu.between("epoch", datetime(1996, 3, 1), datetime(1999, 2, 28)))
    return rows.groupBy("receiver").agg(
        F.count(F.lit(1)).alias("n"), F.min("epoch").alias("first"), F.max("epoch").alias("last")
    )


@query(
    "gps_time_to_utc",
    "SELECT event_id, TIMESTAMP '1980-01-06' + to_days(CAST((2295 + user_id % 5)*7 AS INT)) + to_milliseconds(CAST(floor(value*1000000) AS BIGINT)) - INTERVAL 18 SECOND AS utc FROM events",
)
def gps_to_utc(spark, sf):
    e = table(spark, sf, "events")
    utc = tu.gps_time_to_utc(F.floor(F.col("value") * 1000000), F.pmod("user_id", F.lit(5)) + 2295, F.lit(18))
    return e.select("event_id", utc.alias("utc"))


@query(
    "compare_datasets",
    "WITH " + DAILY_SQL + """, ca AS (SELECT * FROM daily WHERE receiver='canopy'), re AS (SELECT * FROM daily WHERE receiver='reference'),
a AS (SELECT * FROM ca WHERE epoch IN (SELECT epoch FROM re) AND sid IN (SELECT sid FROM re)), b AS (SELECT * FROM re WHERE epoch IN (SELECT epoch FROM ca) AND sid IN (SELECT sid FROM ca)),
p AS (SELECT a.SNR AS x, b.SNR AS y FROM a FULL JOIN b ON a.epoch = b.epoch AND a.sid = b.sid)
SELECT 'SNR' AS variable, count(*) AS n_total, count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) AS n_compared, round(max(abs(x-y)),6) AS max_abs_diff, max(abs(x-y)) <= 0 AND abs(avg(CASE WHEN x IS NULL THEN 1 ELSE 0 END) - avg(CASE WHEN y IS NULL THEN 1 ELSE 0 END)) <= 0 AS passed FROM p""",
)
def compare_datasets(spark, sf):
    a, b = sides(spark, sf)
    out = au.compare_datasets(a, b, ["SNR"], "exact")
    return rounded(out.select("variable", "n_total", "n_compared", "max_abs_diff", "passed"))


@query(
    "match_auxiliary",
    f"""WITH {PASSES_SQL}, w AS (SELECT DISTINCT epoch, sid FROM passes), aux AS (SELECT sid, CAST(date_trunc('month', epoch) AS TIMESTAMP) AS epoch, avg(SNR) AS v FROM passes GROUP BY 1, 2),
b AS (SELECT w.sid, w.epoch, x.epoch AS eb, x.v AS vb FROM w ASOF LEFT JOIN aux x ON w.sid = x.sid AND w.epoch >= x.epoch),
a AS (SELECT w.sid, w.epoch, x.epoch AS ea, x.v AS va FROM w ASOF LEFT JOIN aux x ON w.sid = x.sid AND w.epoch <= x.epoch),
n AS (SELECT *, (eb IS NULL OR (ea IS NOT NULL AND epoch_us(ea)-epoch_us(epoch) <= epoch_us(epoch)-epoch_us(eb))) AS later FROM b JOIN a USING (sid, epoch))
SELECT epoch, sid, round(CASE WHEN later THEN va ELSE vb END,6) AS v, abs(epoch_us(epoch) - epoch_us(CASE WHEN later THEN ea ELSE eb END))/1e6 AS m_temporal_distance FROM n""",
)
def match_auxiliary(spark, sf):
    from leafwave.operators.matching import match

    p = passes(spark, sf)
    month = F.date_trunc("month", "epoch").cast("timestamp_ntz")
    aux = p.groupBy("sid", month.alias("epoch")).agg(F.avg("SNR").alias("v"))
    return rounded(match(p, aux, "sid", ["v"], "m"))


@query(
    "sql_functions",
    f"WITH {OBS_SQL} SELECT split_part(sid,'|',2) AS band, round(sum(-ln(pow(10.0, (SNR-30)/10.0))*cos(theta)),4) AS total, min(strftime(epoch,'%Y%j')) AS first_day FROM obs GROUP BY 1",
)
def sql_functions(spark, sf):
    from leafwave.functions.sql import register_functions

    register_functions(spark)
    obs(spark, sf).createOrReplaceTempView("leafwave_obs")
    return spark.sql(
        "SELECT sid_band(sid) AS band, round(sum(vod(SNR, 30.0D, theta)), 4) AS total, min(yyyydoy(epoch)) AS first_day"
        " FROM leafwave_obs GROUP BY 1"
    )
