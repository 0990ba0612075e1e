"""As-of and interpolation joins, intervals, deduplication and the satellite catalogue.

``orders`` serves as products and file registries: an order is an ephemeris
node, a clock sample, a file's time range or a catalogue period.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwave.functions.sids import sid_part
from leafwave.operators import asof, dedup, intervals, satellites
from leafwave.operators import interpolation as ip
from leafwave.operators.ordered import with_neighbours
from leafwave.plans.base import OBS_SQL, PASSES_SQL, obs, passes, query, rounded, table

# -- products -----------------------------------------------------------------

SV = "substr('GREC', CAST(o_custkey % 4 + 1 AS INT), 1) || lpad(CAST((o_custkey // 4) % 24 + 1 AS VARCHAR), 2, '0')"
EPHEM_SQL = f"""ephem AS (SELECT {SV} AS sv, o_orderdate AS epoch, sqrt(avg(o_totalprice))*30000 AS X, sqrt(avg(o_totalprice))*20000 - 5e6 AS Y, 2e7 - sqrt(avg(o_totalprice))*9000 AS Z,
  sqrt(avg(o_totalprice))/1e3 AS clock_offset FROM orders GROUP BY 1, 2)"""
TARGET_SQL = PASSES_SQL + ", targets AS (SELECT DISTINCT split_part(sid,'|',1) AS sv, epoch FROM passes)"


def ephem(spark, sf):
    o = table(spark, sf, "orders")
    k, price = F.col("o_custkey"), F.sqrt(F.avg("o_totalprice"))
    sv = F.concat(
        F.substring(F.lit("GREC"), (F.pmod(k, F.lit(4)) + 1).cast("int"), F.lit(1)),
        F.lpad((F.pmod(F.floor(k / 4), F.lit(24)) + 1).cast("string"), 2, "0"),
    )
    return o.groupBy(sv.alias("sv"), F.col("o_orderdate").alias("epoch")).agg(
        (price * 30000).alias("X"), (price * 20000 - F.lit(5e6)).alias("Y"), (F.lit(2e7) - price * 9000).alias("Z"),
        (price / F.lit(1e3)).alias("clock_offset"),
    )


def metres(df, digits=3):
    """Positions to the millimetre, everything else to six digits."""
    out = df.withColumns({p: F.round(p, digits) for p in "XYZ" if p in df.columns})
    return rounded(out)


def positions(spark, sf):
    return ephem(spark, sf).drop("clock_offset")


def clock(spark, sf):
    return ephem(spark, sf).select("sv", "epoch", "clock_offset")


def targets(spark, sf):
    return passes(spark, sf).select(sid_part("sid", 0).alias("sv"), "epoch").distinct()


NEAR_SQL = f"""WITH {TARGET_SQL}, {EPHEM_SQL},
b AS (SELECT t.sv, t.epoch, e.epoch AS eb, e.X AS xb FROM targets t ASOF LEFT JOIN ephem e ON t.sv = e.sv AND t.epoch >= e.epoch),
a AS (SELECT t.sv, t.epoch, e.epoch AS ea, e.X AS xa FROM targets t ASOF LEFT JOIN ephem e ON t.sv = e.sv AND t.epoch <= e.epoch),
n AS (SELECT *, (eb IS NULL OR (ea IS NOT NULL AND epoch_us(ea)-epoch_us(epoch) <= epoch_us(epoch)-epoch_us(eb))) AS later FROM b JOIN a USING (sv, epoch))"""


@query(
    "asof_nearest",
    NEAR_SQL + " SELECT sv, epoch, CASE WHEN later THEN ea ELSE eb END AS epoch_matched, round(CASE WHEN later THEN xa ELSE xb END,3) AS X FROM n WHERE ea IS NOT NULL OR eb IS NOT NULL",
)
def asof_nearest(spark, sf):
    out = asof.nearest_asof(targets(spark, sf), positions(spark, sf), ["sv"], ["X"], block_seconds=30 * 86400.0)
    return metres(out)


@query(
    "asof_regular_grid",
    f"WITH {TARGET_SQL}, {EPHEM_SQL} SELECT t.sv, t.epoch, round(X,3) AS X, round(Y,3) AS Y, round(Z,3) AS Z FROM targets t JOIN ephem e ON t.sv = e.sv AND (epoch_us(t.epoch)+43200000000)//86400000000 = (epoch_us(e.epoch)+43200000000)//86400000000",
)
def asof_regular(spark, sf):
    out = asof.nearest_on_regular_grid(targets(spark, sf), positions(spark, sf), 86400.0, ["sv"])
    return metres(out.drop("epoch_matched"))


@query(
    "aux_time_slice",
    f"WITH {EPHEM_SQL} SELECT sv, count(*) AS n FROM ephem WHERE epoch BETWEEN TIMESTAMP '1996-01-01 00:05:00' - INTERVAL 5 MINUTE AND TIMESTAMP '1998-06-30 23:55:00' + INTERVAL 5 MINUTE GROUP BY 1",
)
def aux_slice(spark, sf):
    rows = asof.within_buffer(positions(spark, sf), "1996-01-01 00:05:00", "1998-06-30 23:55:00")
    return rows.groupBy("sv").agg(F.count(F.lit(1)).alias("n"))


VEL_SQL = f"""{EPHEM_SQL}, sp AS (SELECT floor(median(g)) AS dt FROM (SELECT (epoch_us(epoch)-lag(epoch_us(epoch)) OVER (ORDER BY epoch))/1e6 AS g FROM (SELECT DISTINCT epoch FROM ephem))),
vel AS (SELECT sv, epoch, X, Y, Z, """ + ", ".join(
    f"CASE WHEN lag({p}) OVER w IS NULL THEN (lead({p}) OVER w - {p})/dt WHEN lead({p}) OVER w IS NULL THEN ({p} - lag({p}) OVER w)/dt ELSE (lead({p}) OVER w - lag({p}) OVER w)/(2*dt) END AS V{p.lower()}"
    for p in "XYZ"
) + " FROM ephem, sp WINDOW w AS (PARTITION BY sv ORDER BY epoch))"


@query(
    "central_velocity",
    f"WITH {VEL_SQL} SELECT sv, epoch, round(X,3) AS X, round(Y,3) AS Y, round(Z,3) AS Z, round(Vx,6) AS Vx, round(Vy,6) AS Vy, round(Vz,6) AS Vz FROM vel",
)
def central_velocity(spark, sf):
    return metres(ip.central_velocity(positions(spark, sf), block_seconds=90 * 86400.0))


def _hermite_sql() -> str:
    value = "(2*u*u*u-3*u*u+1)*{p}0 + (u*u*u-2*u*u+u)*h*V{p}0 + (3*u*u-2*u*u*u)*{p}1 + (u*u*u-u*u)*h*V{p}1"
    slope = "(6*u*u-6*u)/h*{p}0 + (3*u*u-4*u+1)*V{p}0 + (6*u-6*u*u)/h*{p}1 + (3*u*u-2*u)*V{p}1"
    cols = ", ".join(
        f"round(({value.format(p=p)})/1e6,3) AS {p}, round(({slope.format(p=p)})/1e3,6) AS V{p.lower()}" for p in "XYZ"
    )
    nodes = ", ".join(f"{p} AS {p}0, V{p} AS V{p}0, lead({p}) OVER w AS {p}1, lead(V{p}) OVER w AS V{p}1" for p in "XYZ")
    pick = ", ".join(
        f"coalesce(s.{c}, f.{c}) AS {c}" for p in "XYZ" for c in (f"{p}0", f"{p}1", f"V{p}0", f"V{p}1")
    )
    return f"""WITH {TARGET_SQL}, {VEL_SQL},
seg0 AS (SELECT sv, epoch AS t0, lead(epoch) OVER w AS t1, {nodes} FROM vel WINDOW w AS (PARTITION BY sv ORDER BY epoch)),
seg AS (SELECT * FROM seg0 WHERE t1 IS NOT NULL),
f0 AS (SELECT *, row_number() OVER (PARTITION BY sv ORDER BY t0) AS rn FROM seg), f1 AS (SELECT * FROM f0 WHERE rn = 1),
m AS (SELECT t.sv, t.epoch, coalesce(s.t0, f.t0) AS t0, coalesce(s.t1, f.t1) AS t1, {pick}
  FROM targets t ASOF LEFT JOIN seg s ON t.sv = s.sv AND t.epoch >= s.t0 LEFT JOIN f1 f ON f.sv = t.sv),
q AS (SELECT *, (epoch_us(t1)-epoch_us(t0))/1e6 AS h, (epoch_us(epoch)-epoch_us(t0))/(epoch_us(t1)-epoch_us(t0)) AS u FROM m)
SELECT sv, epoch, {cols} FROM q"""


@query("hermite_interp", _hermite_sql())
def hermite(spark, sf):
    nodes = ip.central_velocity(positions(spark, sf), block_seconds=90 * 86400.0)
    out = ip.hermite_interpolate(nodes, targets(spark, sf), block_seconds=90 * 86400.0)
    # Mm and km/s: extension past the data makes the numbers huge.
    scaled = {p: F.round(F.col(p) / F.lit(1e6), 3) for p in "XYZ"}
    scaled |= {f"V{p}": F.col(f"V{p}") / F.lit(1e3) for p in "xyz"}
    return rounded(out.withColumns(scaled))


@query(
    "linear_interp",
    f"""WITH {TARGET_SQL}, {EPHEM_SQL},
b AS (SELECT t.sv, t.epoch, e.epoch AS eb, e.X AS xb, e.Z AS zb FROM targets t ASOF LEFT JOIN ephem e ON t.sv = e.sv AND t.epoch >= e.epoch),
a AS (SELECT t.sv, t.epoch, e.epoch AS ea, e.X AS xa, e.Z AS za FROM targets t ASOF LEFT JOIN ephem e ON t.sv = e.sv AND t.epoch <= e.epoch),
n AS (SELECT *, CASE WHEN ea = eb THEN 0 ELSE (epoch_us(epoch)-epoch_us(eb))/(epoch_us(ea)-epoch_us(eb)) END AS u FROM b JOIN a USING (sv, epoch))
SELECT sv, epoch, round(xb+(xa-xb)*u,3) AS X, round(zb+(za-zb)*u,3) AS Z FROM n""",
)
def linear(spark, sf):
    out = ip.linear_interpolate(positions(spark, sf), targets(spark, sf), ["X", "Z"], block_seconds=90 * 86400.0)
    return metres(out)


SEG_SQL = f"""{EPHEM_SQL}, j AS (SELECT sv, epoch, clock_offset, coalesce((abs(clock_offset - lag(clock_offset) OVER w) > 0.1)::INT, 0) AS jump FROM ephem WINDOW w AS (PARTITION BY sv ORDER BY epoch)),
seg AS (SELECT sv, epoch, clock_offset, sum(jump) OVER (PARTITION BY sv ORDER BY epoch)::BIGINT AS segment FROM j)"""


@query("clock_segments", f"WITH {SEG_SQL} SELECT sv, epoch, round(clock_offset,9) AS clock_offset, segment FROM seg")
def clock_segments(spark, sf):
    return rounded(ip.clock_segments(clock(spark, sf), threshold=0.1, block_seconds=90 * 86400.0), 9)


@query(
    "clock_interp",
    f"""WITH {TARGET_SQL}, {SEG_SQL}, big AS (SELECT sv, segment FROM seg GROUP BY 1, 2 HAVING count(*) >= 2), s2 AS (SELECT * FROM seg SEMI JOIN big USING (sv, segment)),
b AS (SELECT t.sv, t.epoch, e.epoch AS eb, e.clock_offset AS cb, e.segment AS sb FROM targets t ASOF LEFT JOIN s2 e ON t.sv = e.sv AND t.epoch >= e.epoch),
a AS (SELECT t.sv, t.epoch, e.epoch AS ea, e.clock_offset AS ca, e.segment AS sa FROM targets t ASOF LEFT JOIN s2 e ON t.sv = e.sv AND t.epoch <= e.epoch)
SELECT sv, epoch, round(CASE WHEN sa = sb THEN cb + (ca-cb)*CASE WHEN ea = eb THEN 0 ELSE (epoch_us(epoch)-epoch_us(eb))/(epoch_us(ea)-epoch_us(eb)) END END,9) AS clock_offset FROM b JOIN a USING (sv, epoch)""",
)
def clock_interp(spark, sf):
    out = ip.clock_interpolate(clock(spark, sf), targets(spark, sf), threshold=0.1, block_seconds=90 * 86400.0)
    return rounded(out, 9)


@query(
    "neighbours_null_key",
    f"""WITH {OBS_SQL}, n AS (SELECT CASE WHEN sid NOT LIKE 'R%' THEN sid END AS sid, epoch, max(SNR) AS SNR FROM obs GROUP BY 1, 2)
SELECT sid, epoch, round(SNR,6) AS SNR, round(lag(SNR) OVER w,6) AS prev_SNR, round(lead(SNR) OVER w,6) AS next_SNR FROM n WINDOW w AS (PARTITION BY sid ORDER BY epoch)""",
)
def neighbours_null_key(spark, sf):
    """Rows of an unknown signal are a series of their own."""
    sid = F.when(~F.col("sid").startswith("R"), F.col("sid"))
    rows = obs(spark, sf).groupBy(sid.alias("sid"), "epoch").agg(F.max("SNR").alias("SNR"))
    return rounded(with_neighbours(rows, ["sid"], "epoch", ["SNR"]))


GEO_SQL = OBS_SQL + ", geo AS (SELECT epoch, sid, avg(theta) AS btheta, avg(phi) AS bphi FROM obs WHERE receiver='reference' GROUP BY 1, 2)"


@query(
    "broadcast_geometry_join",
    f"WITH {GEO_SQL} SELECT receiver, o.epoch, o.sid, round(btheta,6) AS btheta, round(bphi,6) AS bphi FROM obs o LEFT JOIN geo g ON o.epoch = g.epoch AND o.sid = g.sid",
)
def broadcast_geometry(spark, sf):
    o = obs(spark, sf)
    geo = o.where("receiver = 'reference'").groupBy("epoch", "sid").agg(
        F.avg("theta").alias("btheta"), F.avg("phi").alias("bphi")
    )
    out = asof.join_broadcast_geometry(o.select("receiver", "epoch", "sid"), geo)
    return rounded(out.select("receiver", "epoch", "sid", "btheta", "bphi"))


@query(
    "sid_intersection_report",
    f"WITH {OBS_SQL}, {PASSES_SQL} SELECT DISTINCT sid FROM obs WHERE sid NOT IN (SELECT sid FROM passes)",
)
def sid_report(spark, sf):
    return asof.unmatched_sids(obs(spark, sf), passes(spark, sf))


@query(
    "merge_products",
    f"""WITH {EPHEM_SQL}, p AS (SELECT sv, epoch, CASE WHEN X >= 5e6 THEN X END AS X FROM ephem), c AS (SELECT sv, epoch, CASE WHEN clock_offset < 0.4 THEN clock_offset END AS clock_offset FROM ephem),
m AS (SELECT coalesce(p.epoch,c.epoch) AS epoch, coalesce(p.sv,c.sv) AS sv, X, clock_offset FROM p FULL JOIN c ON p.sv = c.sv AND p.epoch = c.epoch)
SELECT epoch, sv, round(X,3) AS X, round(clock_offset,9) AS clock_offset FROM m WHERE epoch IN (SELECT epoch FROM m WHERE X IS NOT NULL OR clock_offset IS NOT NULL)""",
)
def merge_products(spark, sf):
    p = positions(spark, sf).select("sv", "epoch", F.when(F.col("X") >= 5e6, F.col("X")).alias("X"))
    c = clock(spark, sf).withColumn("clock_offset", F.when(F.col("clock_offset") < 0.4, F.col("clock_offset")))
    out = asof.merge_products(p, c)
    return out.select("epoch", "sv", F.round("X", 3).alias("X"), F.round("clock_offset", 9).alias("clock_offset"))


@query(
    "satellite_direction",
    None,
)
def direction(spark, sf):
    """Direction of every ephemeris node from a receiver. No SQL: the WGS84
    conversion is iterative; the tests check it against an independent formula."""
    from leafwave.functions.geometry import with_spherical_coords

    out = with_spherical_coords(positions(spark, sf), (4075539.8, 931735.3, 4801629.6))
    return rounded(out)


# -- files, registries, intervals ----------------------------------------------

FILES_SQL = """files AS (SELECT 'R' || CAST(o_custkey // 15 AS VARCHAR) AS receiver, o_orderstatus AS status, o_orderkey AS file_id,
  'h' || CAST(o_custkey // 15 AS VARCHAR) || '_' || CAST(CAST(floor(o_totalprice/500) AS BIGINT) AS VARCHAR) AS rinex_hash,
  o_orderdate AS "start", o_orderdate + to_days(CAST(o_orderkey % 4 AS INT)) AS "end", o_orderdate + to_seconds(o_orderkey) AS written_at FROM orders),
stored AS (SELECT * FROM files WHERE status = 'F'), incoming AS (SELECT * FROM files WHERE status <> 'F')"""


def files(spark, sf):
    o = table(spark, sf, "orders")
    days = F.make_dt_interval(F.pmod("o_orderkey", F.lit(4)).cast("int"))
    group = F.floor(F.col("o_custkey") / 15).cast("string")
    return o.select(
        F.concat(F.lit("R"), group).alias("receiver"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("file_id"),
        F.concat(F.lit("h"), group, F.lit("_"), F.floor(F.col("o_totalprice") / 500).cast("string")).alias("rinex_hash"),
        F.col("o_orderdate").alias("start"),
        (F.col("o_orderdate") + days).alias("end"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey").cast("decimal(18,6)"))).alias("written_at"),
    )


def stored_and_incoming(spark, sf):
    f = files(spark, sf)
    return f.where("status = 'F'"), f.where("status <> 'F'")


KEY = ["receiver"]
BLOCK = 365 * 86400.0


@query(
    "dedup_hash_anti",
    f"WITH {FILES_SQL} SELECT receiver, file_id, rinex_hash FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.receiver = i.receiver AND s.rinex_hash = i.rinex_hash)",
)
def dedup_hash(spark, sf):
    stored, incoming = stored_and_incoming(spark, sf)
    return dedup.new_hashes(incoming, stored, KEY).select("receiver", "file_id", "rinex_hash")


@query(
    "dedup_interval_overlap",
    f"""WITH {FILES_SQL} SELECT receiver, file_id FROM incoming i WHERE EXISTS (SELECT 1 FROM stored s WHERE s.receiver = i.receiver AND s."start" <= i."end" AND s."end" >= i."start")""",
)
def dedup_overlap(spark, sf):
    stored, incoming = stored_and_incoming(spark, sf)
    return intervals.overlapping(incoming, stored, KEY, block_seconds=BLOCK).select("receiver", "file_id")


@query(
    "dedup_intra_batch",
    f"""WITH {FILES_SQL} SELECT receiver, file_id FROM files i WHERE EXISTS (SELECT 1 FROM files j WHERE j.receiver = i.receiver AND j.file_id <> i.file_id AND i."start" <= j."start" AND i."end" >= j."end")""",
)
def dedup_intra(spark, sf):
    return intervals.containers(files(spark, sf), KEY, block_seconds=BLOCK).select("receiver", "file_id")


REASON_SQL = f"""WITH {FILES_SQL}, r AS (SELECT receiver, file_id, rinex_hash,
  EXISTS (SELECT 1 FROM stored s WHERE s.receiver = i.receiver AND s.rinex_hash = i.rinex_hash) AS same,
  EXISTS (SELECT 1 FROM stored s WHERE s.receiver = i.receiver AND s."start" <= i."end" AND s."end" >= i."start") AS meets FROM incoming i)"""


@query(
    "skip_reason",
    REASON_SQL + " SELECT receiver, file_id, CASE WHEN same THEN 'hash_match' WHEN meets THEN 'temporal_overlap' ELSE '' END AS reason FROM r",
)
def skip_reason(spark, sf):
    stored, incoming = stored_and_incoming(spark, sf)
    return dedup.skip_reasons(incoming, stored, KEY).select("receiver", "file_id", "reason")


@query(
    "batch_write_actions",
    f"""WITH {FILES_SQL}, h AS (SELECT *, EXISTS (SELECT 1 FROM stored s WHERE s.receiver = i.receiver AND s.rinex_hash = i.rinex_hash) AS l1 FROM incoming i),
o0 AS (SELECT DISTINCT receiver, rinex_hash FROM h i WHERE NOT l1 AND EXISTS (SELECT 1 FROM stored s WHERE s.receiver = i.receiver AND s."start" <= i."end" AND s."end" >= i."start")),
h2 AS (SELECT h.*, o0.receiver IS NOT NULL AS l2 FROM h LEFT JOIN o0 USING (receiver, rinex_hash)),
c0 AS (SELECT DISTINCT receiver, rinex_hash FROM h2 i WHERE NOT l1 AND NOT l2 AND EXISTS (SELECT 1 FROM h2 j WHERE NOT j.l1 AND NOT j.l2 AND j.receiver = i.receiver AND j.file_id <> i.file_id AND i."start" <= j."start" AND i."end" >= j."end"))
SELECT receiver, file_id, CASE WHEN l1 THEN 'hash' WHEN l2 THEN 'store_overlap' WHEN c0.receiver IS NOT NULL THEN 'batch_container' END AS exists_layer,
  CASE WHEN l1 OR l2 OR c0.receiver IS NOT NULL THEN 'skipped' ELSE 'written' END AS action FROM h2 LEFT JOIN c0 USING (receiver, rinex_hash)""",
)
def batch_actions(spark, sf):
    stored, incoming = stored_and_incoming(spark, sf)
    marked = dedup.mark_existing(incoming, stored, KEY)
    return dedup.batch_actions(marked, "skip", True).select("receiver", "file_id", "exists_layer", "action")


@query(
    "dedup_keep_last",
    f"""WITH {FILES_SQL} SELECT receiver, "start", "end", max(written_at) AS written_at, arg_max(file_id, written_at) AS file_id FROM files GROUP BY 1, 2, 3""",
)
def keep_last(spark, sf):
    rows = files(spark, sf).select("receiver", "start", "end", "written_at", "file_id")
    return dedup.keep_last(rows, ["receiver", "start", "end"])


@query(
    "dedup_keep_first_epoch",
    "SELECT ts, user_id, event_id FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS ts, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2)",
)
def keep_first(spark, sf):
    from leafwave.functions.timeutil import floor_epoch

    e = table(spark, sf, "events").select(floor_epoch("ts", "1h").alias("ts"), "user_id", "event_id")
    return dedup.keep_first(e, ["ts", "user_id"], "event_id")


POINTS_SQL = "points AS (SELECT 'R' || CAST(l_suppkey AS VARCHAR) AS receiver, l_shipdate AS epoch, l_orderkey, l_linenumber FROM lineitem)"


def points(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string")).alias("receiver"),
        F.col("l_shipdate").alias("epoch"), "l_orderkey", "l_linenumber",
    )


@query(
    "dedup_read",
    f"""WITH {FILES_SQL}, {POINTS_SQL} SELECT receiver, count(*) AS n FROM points p WHERE EXISTS (SELECT 1 FROM files f WHERE f.receiver = p.receiver AND f."start" <= p.epoch AND f."end" >= p.epoch) GROUP BY 1""",
)
def dedup_read(spark, sf):
    kept = dedup.dedup_read(points(spark, sf), files(spark, sf), KEY)
    return kept.groupBy("receiver").agg(F.count(F.lit(1)).alias("n"))


@query(
    "overwrite_prepare",
    f"""WITH {FILES_SQL}, {POINTS_SQL} SELECT receiver, count(*) AS n FROM points p WHERE NOT EXISTS (SELECT 1 FROM incoming f WHERE f.receiver = p.receiver AND f."start" <= p.epoch AND f."end" >= p.epoch) GROUP BY 1""",
)
def overwrite_prepare(spark, sf):
    _, incoming = stored_and_incoming(spark, sf)
    kept = dedup.prepare_overwrite(points(spark, sf), incoming, KEY)
    return kept.groupBy("receiver").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filename_overlap_pairs",
    """WITH f AS (SELECT event_id, user_id, strftime(ts, '%Y%j') AS yyyydoy, date_trunc('minute', ts)::TIMESTAMP AS s, date_trunc('minute', ts)::TIMESTAMP + to_minutes(CAST(floor(value) AS BIGINT)) AS e FROM events)
SELECT a.user_id, a.yyyydoy, a.event_id AS id_a, b.event_id AS id_b FROM f a JOIN f b ON a.user_id = b.user_id AND a.yyyydoy = b.yyyydoy AND a.event_id < b.event_id AND a.s < b.e AND b.s < a.e""",
)
def overlap_pairs(spark, sf):
    from leafwave.functions.timeutil import floor_epoch, yyyydoy

    e = table(spark, sf, "events")
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))
    minute = floor_epoch("ts", "1min")
    rows = e.select(
        "event_id", "user_id", yyyydoy("ts").alias("yyyydoy"), minute.alias("start"), (minute + length).alias("end")
    )
    return intervals.overlap_pairs(rows, "event_id", ["user_id", "yyyydoy"])


# -- satellite catalogue --------------------------------------------------------

CATALOG_SQL = """cat0 AS (SELECT 'R' || CAST(o_custkey // 15 AS VARCHAR) AS prn, CAST(o_orderdate AS DATE) AS "start", max(substr(o_orderpriority,1,1) || o_orderstatus) AS svn FROM orders GROUP BY 1, 2),
catalog AS (SELECT prn, svn, "start", lead("start") OVER (PARTITION BY prn ORDER BY "start") - 1 AS "end" FROM cat0)"""


def catalog(spark, sf):
    from pyspark.sql import Window

    o = table(spark, sf, "orders")
    base = o.groupBy(
        F.concat(F.lit("R"), F.floor(F.col("o_custkey") / 15).cast("string")).alias("prn"),
        F.to_date("o_orderdate").alias("start"),
    ).agg(F.max(F.concat(F.substring("o_orderpriority", 1, 1), "o_orderstatus")).alias("svn"))
    w = Window.partitionBy("prn").orderBy("start")
    return base.select("prn", "svn", "start", F.date_sub(F.lead("start").over(w), 1).alias("end"))


@query(
    "scd2_lookup",
    f"""WITH {CATALOG_SQL}, q AS (SELECT DISTINCT 'R' || CAST(l_suppkey AS VARCHAR) AS prn, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT q.prn, q.day, c.svn FROM q LEFT JOIN catalog c ON c.prn = q.prn AND c."start" <= q.day AND (c."end" IS NULL OR q.day <= c."end")""",
)
def scd2(spark, sf):
    q = table(spark, sf, "lineitem").select(
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string")).alias("prn"), F.to_date("l_shipdate").alias("day")
    ).distinct()
    return satellites.prn_metadata(q, catalog(spark, sf)).select("prn", "day", "svn")


@query(
    "prn_reassignment",
    f"""WITH {CATALOG_SQL}, w AS (SELECT prn, svn, "start", lag(svn) OVER p AS old_svn, lag("end") OVER p AS old_end FROM catalog WINDOW p AS (PARTITION BY prn ORDER BY "start"))
SELECT prn, old_svn, svn AS new_svn, old_end, "start" AS new_start FROM w WHERE old_svn <> svn AND "start" <= DATE '1999-12-31' AND old_end >= DATE '1996-01-01'""",
)
def prn_reassignment(spark, sf):
    return satellites.reassignments(catalog(spark, sf), "1996-01-01", "1999-12-31")


@query(
    "active_prns",
    f"""WITH {CATALOG_SQL} SELECT DISTINCT prn FROM catalog WHERE prn LIKE 'R1%' AND "start" <= DATE '1997-06-15' AND ("end" IS NULL OR "end" >= DATE '1997-06-15')""",
)
def active(spark, sf):
    return satellites.active_prns(catalog(spark, sf), "R1", "1997-06-15")


@query(
    "catalog_snapshot",
    f"""WITH {CATALOG_SQL} SELECT prn, svn, "start", "end" FROM catalog WHERE "start" <= DATE '1997-06-15' AND ("end" IS NULL OR "end" >= DATE '1997-06-15')""",
)
def catalog_snapshot(spark, sf):
    return satellites.snapshot(catalog(spark, sf), "1997-06-15")


@query(
    "catalog_enrich",
    f"""WITH {CATALOG_SQL}, p AS (SELECT 'R' || CAST(l_suppkey AS VARCHAR) || '|L1|C' AS sid, l_shipdate AS epoch FROM lineitem), d AS (SELECT max(CAST(epoch AS DATE)) - 1000 AS day FROM p)
SELECT p.sid, c.svn, count(*) AS n FROM p CROSS JOIN d LEFT JOIN catalog c ON c.prn = split_part(p.sid,'|',1) AND c."start" <= d.day AND (c."end" IS NULL OR d.day <= c."end") GROUP BY 1, 2""",
)
def catalog_enrich(spark, sf):
    p = table(spark, sf, "lineitem").select(
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string"), F.lit("|L1|C")).alias("sid"),
        F.col("l_shipdate").alias("epoch"),
    )
    day = p.agg(F.date_sub(F.max(F.to_date("epoch")), 1000)).first()[0]
    out = satellites.enrich(p, catalog(spark, sf), str(day))
    return out.groupBy("sid", "svn").agg(F.count(F.lit(1)).alias("n"))
