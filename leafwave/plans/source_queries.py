"""File formats, checked by writing the given tables out as text or raw fields and reading them back.

Spark renders every row in the format; the parser must return what SQL
computes straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwave.functions import sbf as sc
from leafwave.functions.timeutil import yyyydoy
from leafwave.plans.base import OBS_SQL, PASSES_SQL, obs, passes, query, table
from leafwave.plans.join_queries import CATALOG_SQL, EPHEM_SQL, catalog, ephem
from leafwave.sources import filenames as fn
from leafwave.sources import nmea, products, rinex2, rinex3, sbf, sinex


def _label(text: str, label: str) -> str:
    return f"{text:<60}{label}\n"


# -- observation files ----------------------------------------------------------

SAT_SQL = PASSES_SQL + """, sat AS (SELECT receiver, epoch, split_part(sid,'|',1) AS sv, avg(SNR) AS SNR, avg(theta) AS theta, avg(phi) AS phi FROM passes GROUP BY 1, 2, 3),
v AS (SELECT *, substr(sv,1,1) AS sys, 2e7 + theta*1e6 AS code, phi*1e5 AS ph, (phi-3)*1000 AS dop FROM sat)"""


def satellites(spark, sf):
    sat = passes(spark, sf).groupBy("receiver", "epoch", F.substring("sid", 1, 3).alias("sv")).agg(
        F.avg("SNR").alias("SNR"), F.avg("theta").alias("theta"), F.avg("phi").alias("phi")
    )
    return sat.withColumns(
        {
            "code": F.lit(2e7) + F.col("theta") * 1e6,
            "ph": F.col("phi") * 1e5,
            "dop": (F.col("phi") - 3) * 1000,
        }
    )


def _fixed(c: str, tail: str = "  "):
    return F.format_string(f"%14.3f{tail}", c)


HEADER3 = (
    _label(f"{'3.04':>9}{'':11}OBSERVATION DATA    M", "RINEX VERSION / TYPE")
    + _label("LEAF", "MARKER NAME")
    + "".join(_label(f"{s}    4 C1C L1C D1C S1C", "SYS / # / OBS TYPES") for s in "GREC")
    + _label("", "END OF HEADER")
)


def rinex3_records(spark, sf):
    sat = satellites(spark, sf)
    line = F.concat("sv", _fixed("code"), _fixed("ph", "7 "), _fixed("dop"), _fixed("SNR", " 5"))
    blocks = sat.groupBy(F.col("receiver").alias("path"), "epoch").agg(
        F.concat_ws("\n", F.sort_array(F.collect_list(line))).alias("body"), F.count(F.lit(1)).alias("n")
    )
    head = F.concat(
        F.date_format("epoch", " yyyy MM dd HH mm "), F.lit(" 0.0000000  0"), F.lpad(F.col("n").cast("string"), 3, " ")
    )
    blocks = blocks.select("path", F.concat_ws("\n", head, "body").alias("record"))
    headers = sat.select(F.col("receiver").alias("path")).distinct().withColumn("record", F.lit(HEADER3))
    return headers, blocks


@query(
    "rinex3_parse",
    f"""WITH {SAT_SQL} SELECT receiver AS path, epoch, sv || '|' || CASE sys WHEN 'G' THEN 'L1' WHEN 'R' THEN 'G1' WHEN 'E' THEN 'E1' ELSE 'B1C' END || '|C' AS sid,
  round(CAST(CAST(round(SNR,3) AS FLOAT) AS DOUBLE),3) AS SNR, round(code,3) AS Pseudorange, round(ph,3) AS Phase, round(CAST(CAST(round(dop,3) AS FLOAT) AS DOUBLE),3) AS Doppler, 7 AS LLI, 5 AS SSI FROM v""",
)
def rinex3_parse(spark, sf):
    headers, blocks = rinex3_records(spark, sf)
    out = rinex3.parse_epochs(blocks, rinex3.parse_header(headers))
    return out.select(
        "path", "epoch", "sid",
        *[F.round(F.col(c).cast("double"), d).alias(c) for c, d in (("SNR", 3), ("Pseudorange", 3), ("Phase", 3), ("Doppler", 3))],
        F.col("LLI").cast("int").alias("LLI"), F.col("SSI").cast("int").alias("SSI"),
    )


HEADER2 = _label("     6    C1    L1    S1    P2    S2    D1", "# / TYPES OF OBSERV")


@query(
    "rinex2_parse",
    f"""WITH {SAT_SQL}, b AS (SELECT *, CASE sys WHEN 'G' THEN 'L1' WHEN 'R' THEN 'G1' WHEN 'E' THEN 'E1' ELSE 'B1C' END AS b1, CASE sys WHEN 'G' THEN 'L2' WHEN 'R' THEN 'G2' WHEN 'C' THEN 'B1I' END AS b2 FROM v)
SELECT receiver AS path, epoch, sv || '|' || b1 || '|C' AS sid, NULL::DOUBLE AS SNR, round(code,3) AS Pseudorange, NULL::DOUBLE AS Phase, NULL::DOUBLE AS Doppler FROM b
UNION ALL SELECT receiver, epoch, sv || '|' || b1 || '|X', round(CAST(CAST(round(SNR,3) AS FLOAT) AS DOUBLE),3), NULL, round(ph,3), round(CAST(CAST(round(dop,3) AS FLOAT) AS DOUBLE),3) FROM b
UNION ALL SELECT receiver, epoch, sv || '|' || b2 || '|P', NULL, round(code+10,3), NULL, NULL FROM b WHERE b2 IS NOT NULL
UNION ALL SELECT receiver, epoch, sv || '|' || b2 || '|X', round(CAST(CAST(round(SNR-5,3) AS FLOAT) AS DOUBLE),3), NULL, NULL, NULL FROM b WHERE b2 IS NOT NULL""",
)
def rinex2_parse(spark, sf):
    sat = satellites(spark, sf).withColumn("code2", F.col("code") + 10).withColumn("SNR2", F.col("SNR") - 5)
    rows = F.array(
        F.concat(_fixed("code"), _fixed("ph"), _fixed("SNR"), _fixed("code2"), _fixed("SNR2")), _fixed("dop")
    )
    epochs = sat.groupBy(F.col("receiver").alias("path"), "epoch").agg(
        F.sort_array(F.collect_list(F.struct("sv", rows.alias("rows")))).alias("s")
    )
    n = F.size("s")
    sat_lines = F.transform(
        F.sequence(F.lit(0), F.ceil(n / F.lit(12)).cast("int") - 1),
        lambda i: F.array_join(F.transform(F.slice("s", i * 12 + 1, F.lit(12)), lambda x: x["sv"]), ""),
    )
    head = F.concat(
        F.date_format("epoch", " yy "), F.lpad(F.month("epoch").cast("string"), 2, " "), F.lit(" "),
        F.lpad(F.dayofmonth("epoch").cast("string"), 2, " "), F.lit("  0  0  0.0000000  0"),
        F.lpad(n.cast("string"), 3, " "),
    )
    first = F.transform(
        sat_lines, lambda t, i: F.when(i == 0, F.concat(head, t)).otherwise(F.concat(F.lit(" " * 32), t))
    )
    lines = epochs.select("path", "epoch", F.posexplode(F.concat(first, F.flatten(F.transform("s", lambda x: x["rows"])))).alias("p", "line"))
    lines = lines.select(
        "path", F.year("epoch").cast("bigint").alias("block"),
        (F.dayofyear("epoch") * 10000 + F.col("p")).cast("bigint").alias("pos"), "line",
    )
    headers = sat.select(F.col("receiver").alias("path")).distinct().select(
        "path", F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("pos"), F.lit(HEADER2.strip("\n")).alias("line")
    )
    out = rinex2.parse_lines(lines, rinex2.parse_headers(headers))
    return out.select(
        "path", "epoch", "sid",
        *[F.round(F.col(c).cast("double"), d).alias(c) for c, d in (("SNR", 3), ("Pseudorange", 3), ("Phase", 3), ("Doppler", 3))],
    )


#: Events of a split of the log; splits follow the order of its lines.
NMEA_SPLIT = 50_000


@query(
    "nmea_parse",
    """WITH l AS (SELECT *, CASE WHEN event_type <> 'signup' THEN ts END AS own FROM events),
e AS (SELECT *, last_value(own IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch FROM l)
SELECT epoch, CASE user_id % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'R' WHEN 2 THEN 'E' ELSE 'C' END || lpad(CAST(user_id % 24 + 1 AS VARCHAR),2,'0') || CASE user_id % 4 WHEN 0 THEN '|L5|Q' WHEN 1 THEN '|G1|C' WHEN 2 THEN '|E1|C' ELSE '|B1I|I' END AS sid,
  max(floor(20+value/15)) AS SNR FROM e WHERE event_type <> 'error' AND epoch IS NOT NULL GROUP BY 1, 2""",
)
def nmea_parse(spark, sf):
    e = table(spark, sf, "events")
    u = F.col("user_id")
    kind = F.pmod(u, F.lit(4))
    talker = F.when(kind == 0, "GP").when(kind == 1, "GL").when(kind == 2, "GA").otherwise("GB")
    prn = F.lpad((F.pmod(u, F.lit(24)) + 1).cast("string"), 2, "0")
    snr = F.floor(F.lit(20) + F.col("value") / 15).cast("string")
    rmc = F.concat(
        F.lit("$GPRMC,"), F.date_format("ts", "HHmmss.SSSSSS"), F.lit(",A,4807.038,N,01131.000,E,0.0,0.0,"),
        F.date_format("ts", "ddMMyy"), F.lit(",,"),
    )
    signal_id = F.when(kind == 0, ",8").otherwise("")
    gsv = F.concat(F.lit("$"), talker, F.lit("GSV,1,1,01,"), prn, F.lit(",40,083,"), snr, signal_id)
    sealed = lambda s: F.concat(s, F.lit("*"), nmea.checksum(F.concat(s, F.lit("*00"))))
    broken = F.concat(gsv, F.lit("*ZZ"))
    both = F.array(
        F.when(F.col("event_type") != "signup", sealed(rmc)),
        F.when(F.col("event_type") == "error", broken).otherwise(sealed(gsv)),
    )
    lines = e.select(
        F.lit("log").alias("path"), F.floor(F.col("event_id") / F.lit(NMEA_SPLIT)).alias("block"), "event_id",
        F.posexplode(both).alias("p", "line"),
    )
    lines = lines.where(F.col("line").isNotNull()).select(
        "path", "block", (F.col("event_id") * 2 + F.col("p")).alias("pos"), "line"
    )
    return nmea.parse_sentences(lines).select("epoch", "sid", F.col("SNR").cast("double").alias("SNR"))


# -- products ---------------------------------------------------------------------


@query(
    "sp3_parse",
    f"WITH {EPHEM_SQL} SELECT epoch, sv, round(CASE WHEN X >= 1.2e7 THEN X END,3) AS X, round(Y,3) AS Y, round(Z,3) AS Z FROM ephem",
)
def sp3_parse(spark, sf):
    e = ephem(spark, sf)
    km = lambda c: F.format_string("%14.6f", F.col(c) / 1000)
    line = F.concat(
        F.lit("P"), "sv", F.when(F.col("X") >= 1.2e7, km("X")).otherwise(F.lit(" 999999.999999")), km("Y"), km("Z"),
        F.lit(" 999999.999999"),
    )
    blocks = e.groupBy("epoch").agg(F.concat_ws("\n", F.collect_list(line)).alias("body"))
    head = F.date_format("epoch", "  yyyy MM dd HH mm  0.00000000")
    records = blocks.select(F.lit("f").alias("path"), F.concat_ws("\n", head, "body").alias("record"))
    out = products.parse_sp3(records)
    return out.select("epoch", "sv", *[F.round(c, 3).alias(c) for c in "XYZ"])


@query("clk_parse", f"WITH {EPHEM_SQL} SELECT epoch, sv, round(clock_offset,8) AS clock_offset FROM ephem")
def clk_parse(spark, sf):
    line = F.concat(
        F.lit("AS "), "sv", F.date_format("epoch", "  yyyy MM dd HH mm"), F.lit("  0.000000  2   "),
        F.format_string("%.12f", "clock_offset"), F.lit("  0.0"),
    )
    lines = ephem(spark, sf).select(F.lit("f").alias("path"), line.alias("line"))
    return products.parse_clk(lines).select("epoch", "sv", F.round("clock_offset", 8).alias("clock_offset"))


@query(
    "sinex_prn_parse",
    f"""WITH {CATALOG_SQL} SELECT svn, prn, "start", "end" FROM (SELECT 'G' || lpad(svn,3,'0') AS svn, substr(prn || '  ',1,3) AS p3, trim(substr(prn || '  ',1,3)) AS prn, "start", "end" FROM catalog)""",
)
def sinex_parse(spark, sf):
    c = catalog(spark, sf)
    stamp = lambda d: F.concat(F.date_format(d, "yyyy:DDD"), F.lit(":00000"))
    line = F.concat(
        F.lit(" G"), F.lpad("svn", 3, "0"), F.lit(" "), stamp("start"), F.lit(" "),
        F.coalesce(stamp("end"), F.lit("0000:000:00000")), F.lit(" "), F.rpad("prn", 3, " "),
    )
    # Markers sit on either side of the data in file order.
    body = c.select(F.datediff("start", F.lit("1990-01-01").cast("date")).cast("bigint").alias("pos"), line.alias("line"))
    ends = spark.createDataFrame([(0, "+SATELLITE/PRN"), (10**9, "-SATELLITE/PRN")], "pos bigint, line string")
    lines = ends.unionByName(body).select(F.lit("f").alias("path"), F.floor(F.col("pos") / 365).alias("block"), "pos", "line")
    return sinex.parse_periods(lines, "prn").select("svn", "prn", "start", "end")


# -- binary measurements ------------------------------------------------------------

RAW_SQL = """raw AS (SELECT event_id, ts AS epoch, CAST(user_id % 60 + 1 AS INT) AS svid, CAST(user_id % 3 AS INT) AS sig, CAST(floor(value) AS BIGINT) AS v, CAST(event_id AS BIGINT) AS e FROM events),
r2 AS (SELECT *, CASE WHEN v % 7 = 0 THEN 255 ELSE v % 200 END AS c, (5*4294967296 + e*1000 + v)*1e-3 AS pr, (v*1000 - 200000)*1e-4 AS dop,
  CASE sig WHEN 2 THEN 1227.60::DOUBLE ELSE 1575.42::DOUBLE END AS f, CASE WHEN svid <= 37 THEN 'G' || lpad(CAST(svid AS VARCHAR),2,'0') ELSE 'R' || lpad(CAST(svid-37 AS VARCHAR),2,'0') END AS sv FROM raw)"""


def raw_measurements(spark, sf):
    """Masters on signals 0-2 for every event, and a slave on signal 3 for each."""
    e = table(spark, sf, "events")
    v, i = F.floor("value").cast("bigint"), F.col("event_id")
    none = F.lit(None).cast("int")
    master = e.select(
        F.lit("f").alias("path"), F.lit("obs").alias("kind"), F.col("ts").alias("epoch"), "event_id",
        (F.pmod("user_id", F.lit(60)) + 1).cast("int").alias("svid"), none.alias("freq_nr"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("type"), F.lit(0).alias("obs_info"), F.lit(5).alias("misc"),
        (i * 1000 + v).alias("code_lsb"), (v * 1000 - 200000).alias("doppler"),
        F.pmod(i, F.lit(100)).cast("int").alias("carrier_msb"), F.pmod(v, F.lit(65536)).cast("int").alias("carrier_lsb"),
        F.when(F.pmod(v, F.lit(7)) == 0, 255).otherwise(F.pmod(v, F.lit(200))).cast("int").alias("cn0"),
        none.alias("type2"), none.alias("obs_info2"), none.alias("offset_msb"), none.alias("code_offset_lsb"),
        none.alias("doppler_offset_lsb"),
    )
    slave = master.withColumns(
        {
            "type2": F.lit(3), "obs_info2": F.lit(0), "offset_msb": F.lit(0b11110_111),
            "code_offset_lsb": F.pmod(F.col("code_lsb"), F.lit(60000)).cast("int"),
            "doppler_offset_lsb": F.lit(100), "cn0": F.lit(120),
        }
    )
    return master, slave


@query(
    "sbf_master_observations",
    f"""WITH {RAW_SQL} SELECT epoch, sv || CASE sig WHEN 0 THEN '|L1|C' WHEN 1 THEN '|L1|W' ELSE '|L2|W' END AS sid, round(CASE WHEN c <> 255 THEN c*0.25 + CASE WHEN sig IN (1,2) THEN 0 ELSE 10 END END::DOUBLE,6) AS SNR,
  round(pr::DOUBLE,3) AS Pseudorange, round((pr*f*1e6/299792458.0::DOUBLE + ((e % 100)*65536 + v % 65536)*1e-3)::DOUBLE,2) AS Phase, round(dop::DOUBLE,4) AS Doppler FROM r2""",
)
def sbf_master(spark, sf):
    master, _ = raw_measurements(spark, sf)
    out = sbf.observations(master)
    return out.select(
        "epoch", "sid", F.round(F.col("SNR").cast("double"), 6).alias("SNR"), F.round("Pseudorange", 3).alias("Pseudorange"),
        F.round("Phase", 2).alias("Phase"), F.round(F.col("Doppler").cast("double"), 4).alias("Doppler"),
    )


@query(
    "sbf_slave_observations",
    f"""WITH {RAW_SQL} SELECT epoch, sv || '|L2|L' AS sid, 40.0::DOUBLE AS SNR, round((pr + (-1*65536 + (e*1000+v) % 60000)*1e-3)::DOUBLE,3) AS Pseudorange,
  round((dop*1227.60::DOUBLE/f + (-2*65536 + 100)*1e-4)::DOUBLE,2) AS Doppler FROM r2""",
)
def sbf_slave(spark, sf):
    _, slave = raw_measurements(spark, sf)
    out = sbf.observations(slave)
    return out.select(
        "epoch", "sid", F.round(F.col("SNR").cast("double"), 6).alias("SNR"), F.round("Pseudorange", 3).alias("Pseudorange"),
        F.round(F.col("Doppler").cast("double"), 2).alias("Doppler"),
    )


@query(
    "sbf_svid_decode",
    """SELECT DISTINCT user_id AS svid, CASE WHEN user_id BETWEEN 1 AND 37 THEN 'G' WHEN user_id BETWEEN 38 AND 68 THEN 'R' WHEN user_id BETWEEN 71 AND 106 THEN 'E' WHEN user_id BETWEEN 107 AND 119 THEN 'L' WHEN user_id BETWEEN 120 AND 140 THEN 'S' WHEN user_id BETWEEN 141 AND 180 THEN 'C'
  WHEN user_id BETWEEN 181 AND 187 THEN 'J' WHEN user_id BETWEEN 191 AND 197 THEN 'I' WHEN user_id BETWEEN 198 AND 215 THEN 'S' WHEN user_id BETWEEN 216 AND 222 THEN 'I' WHEN user_id BETWEEN 223 AND 245 THEN 'C' ELSE '?' END AS system,
  CASE WHEN user_id BETWEEN 38 AND 61 THEN user_id-37 WHEN user_id = 62 THEN 0 WHEN user_id BETWEEN 63 AND 68 THEN user_id-38 WHEN user_id BETWEEN 71 AND 106 THEN user_id-70 WHEN user_id BETWEEN 141 AND 180 THEN user_id-140
  WHEN user_id BETWEEN 181 AND 187 THEN user_id-180 WHEN user_id BETWEEN 191 AND 197 THEN user_id-190 WHEN user_id BETWEEN 198 AND 215 THEN user_id-57 WHEN user_id BETWEEN 216 AND 222 THEN user_id-208 WHEN user_id BETWEEN 223 AND 245 THEN user_id-182 ELSE user_id END AS prn FROM events""",
)
def svid_decode(spark, sf):
    ids = table(spark, sf, "events").select(F.col("user_id").alias("svid")).distinct()
    return ids.select("svid", sc.decode_svid(F.col("svid")).alias("s")).select("svid", "s.system", "s.prn")


# -- names ---------------------------------------------------------------------------

NAMES_SQL = """n AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'R' ELSE 'A' END AS rt, CAST(o_custkey % 99 + 1 AS INT) AS num, year(o_orderdate)::INT AS year, dayofyear(o_orderdate)::INT AS doy, CAST(o_orderkey % 24 AS INT) AS hour, CAST(o_custkey % 60 AS INT) AS minute,
  CASE o_orderstatus WHEN 'F' THEN '01D' WHEN 'O' THEN '15M' ELSE '01H' END AS period FROM orders)"""


def names(spark, sf):
    o = table(spark, sf, "orders")
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    status = F.col("o_orderstatus")
    return o.select(
        "o_orderkey", F.lit("LEA").alias("site"), F.when(status == "F", "R").otherwise("A").alias("receiver_type"),
        (F.pmod(c, F.lit(99)) + 1).cast("int").alias("receiver_number"), F.lit("TUW").alias("agency"),
        F.year(d).alias("year"), F.dayofyear(d).alias("doy"), F.pmod(k, F.lit(24)).cast("int").alias("hour"),
        F.pmod(c, F.lit(60)).cast("int").alias("minute"),
        F.when(status == "F", "01D").when(status == "O", "15M").otherwise("01H").alias("period"),
        F.lit("05S").alias("sampling"), F.lit("AA").alias("content"), F.lit("rnx").alias("file_type"),
        F.lit(None).cast("string").alias("compression"),
    )


@query(
    "canonical_filename",
    f"""WITH {NAMES_SQL} SELECT o_orderkey, 'LEA' || rt || lpad(CAST(num AS VARCHAR),2,'0') || 'TUW_R_' || CAST(year AS VARCHAR) || lpad(CAST(doy AS VARCHAR),3,'0') || lpad(CAST(hour AS VARCHAR),2,'0') || lpad(CAST(minute AS VARCHAR),2,'0') || '_' || period || '_05S_AA.rnx' AS name,
  rt AS receiver_type, num AS receiver_number, year, doy, hour, minute, CASE period WHEN '01D' THEN 86400 WHEN '15M' THEN 900 ELSE 3600 END AS batch_s, 5.0::DOUBLE AS sampling_s FROM n""",
)
def canonical(spark, sf):
    made = names(spark, sf).select("o_orderkey", F.concat(F.lit("/data/x/"), fn.canonical_name()).alias("path"))
    p = fn.parse_canonical(made)
    return p.select(
        "o_orderkey", fn.base_name(F.col("path")).alias("name"), "receiver_type", "receiver_number", "year", "doy", "hour",
        "minute", fn.duration_seconds(F.col("period")).alias("batch_s"), fn.sampling_interval(F.col("path")).alias("sampling_s"),
    )


@query(
    "filename_families",
    f"""WITH {NAMES_SQL} SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'canonical' WHEN 1 THEN 'septentrio_rinex_v2' WHEN 2 THEN 'septentrio_sbf' ELSE 'rinex_v2_short' END AS family, year, doy, hour,
  CASE o_orderkey % 4 WHEN 3 THEN 0 ELSE minute END::INT AS minute FROM n""",
)
def families(spark, sf):
    n = names(spark, sf)
    letter = F.char(F.col("hour") + 97)
    short = F.concat(F.lit("leaf"), F.lpad(F.col("doy").cast("string"), 3, "0"), letter)
    yy = F.substring(F.col("year").cast("string"), 3, 2)
    mm = F.lpad(F.col("minute").cast("string"), 2, "0")
    kind = F.pmod("o_orderkey", F.lit(4))
    name = (
        F.when(kind == 0, fn.canonical_name())
        .when(kind == 1, F.concat(short, mm, F.lit("."), yy, F.lit("o")))
        .when(kind == 2, F.concat(short, mm, F.lit("."), yy, F.lit("_")))
        .otherwise(F.concat(short, F.lit("."), yy, F.lit("o")))
    )
    out = fn.match_families(n.select("o_orderkey", name.alias("path")))
    return out.select("o_orderkey", "family", "year", "doy", "hour", "minute")


@query(
    "naming_recipe",
    f"WITH {NAMES_SQL} SELECT o_orderkey, lpad(CAST(num AS VARCHAR),2,'0') AS receiver, CAST(year AS VARCHAR) AS year, lpad(CAST(doy AS VARCHAR),3,'0') AS doy FROM n",
)
def recipe(spark, sf):
    name = F.format_string("rx%02d_%04d%03d.bin", "receiver_number", "year", "doy")
    df = names(spark, sf).select("o_orderkey", name.alias("path"))
    fields = [("", 2), ("receiver", 2), ("", 1), ("year", 4), ("doy", 3), ("", 4)]
    return fn.parse_recipe(df, fields).select("o_orderkey", "receiver", "year", "doy")


LISTING_SQL = "l AS (SELECT DISTINCT 'S' || CAST(s.s_nationkey AS VARCHAR) AS receiver, strftime(l_shipdate,'%Y%j') AS date FROM lineitem JOIN supplier s ON s_suppkey = l_suppkey)"


def listing(spark, sf):
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    rows = li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("receiver"), yyyydoy("l_shipdate").alias("date")
    ).distinct()


@query(
    "common_dates",
    f"WITH {LISTING_SQL} SELECT date FROM l WHERE receiver = 'S1' INTERSECT SELECT date FROM l WHERE receiver = 'S7'",
)
def common_dates(spark, sf):
    return fn.common_dates(listing(spark, sf), ["S1", "S7"])


@query(
    "matched_pairs",
    f"""WITH {LISTING_SQL}, p AS (SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS canopy, 'S' || CAST(n_regionkey + 5 AS VARCHAR) AS reference FROM nation)
SELECT canopy, reference, c.date FROM p JOIN l c ON c.receiver = canopy JOIN l r ON r.receiver = reference AND r.date = c.date""",
)
def matched_pairs(spark, sf):
    n = table(spark, sf, "nation")
    pairs = n.select(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("canopy"),
        F.concat(F.lit("S"), (F.col("n_regionkey") + 5).cast("string")).alias("reference"),
    )
    return fn.matched_pairs(listing(spark, sf), pairs).select("canopy", "reference", "date")


@query(
    "receiver_pairing",
    """WITH p AS (SELECT r_name AS reference, n_name AS canopy FROM region JOIN nation ON n_regionkey = r_regionkey)
SELECT reference || '_' || canopy AS store_group, count(*) AS n FROM p JOIN (SELECT r_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) o ON o.r_name = p.reference GROUP BY 1""",
)
def receiver_pairing(spark, sf):
    from leafwave.operators.retrieval import explode_pairs, replicate_reference

    n, r, c = (table(spark, sf, t) for t in ("nation", "region", "customer"))
    conf = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("receiver")).agg(
        F.collect_set("n_name").alias("scs_from")
    )
    seen = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    obs_rows = seen.select(F.col("r_name").alias("receiver"), "c_custkey")
    out = replicate_reference(obs_rows, explode_pairs(conf))
    return out.groupBy("store_group").agg(F.count(F.lit(1)).alias("n"))


@query(
    "catalog_range_query",
    f"WITH {NAMES_SQL} SELECT o_orderkey, year, doy FROM n WHERE year*1000+doy BETWEEN 1996200 AND 1998010 AND rt = 'R'",
)
def catalog_range(spark, sf):
    rows = fn.date_range(names(spark, sf), (1996, 200), (1998, 10), "R")
    return rows.select("o_orderkey", "year", "doy")


@query(
    "catalog_upsert",
    "WITH old AS (SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1), new AS (SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) SELECT k AS physical_path, v FROM new UNION ALL SELECT k, v FROM old WHERE k NOT IN (SELECT k FROM new)",
)
def catalog_upsert(spark, sf):
    o = table(spark, sf, "orders")
    side = lambda part: o.where(part).groupBy(F.col("o_custkey").alias("physical_path")).agg(F.max("o_orderkey").alias("v"))
    return fn.upsert(side(F.col("o_orderstatus") != "O"), side(F.col("o_orderstatus") == "O"))


@query(
    "natural_sort_rank",
    "SELECT 'file' || CAST(p_partkey AS VARCHAR) || '.rnx' AS path, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)::INT AS rank FROM part",
)
def natural_sort(spark, sf):
    from pyspark.sql import Window

    p = table(spark, sf, "part")
    path = F.concat(F.lit("file"), F.col("p_partkey").cast("string"), F.lit(".rnx"))
    w = Window.partitionBy("p_brand").orderBy(fn.natural_key(F.col("path")))
    return p.select("p_brand", path.alias("path")).select("path", F.row_number().over(w).alias("rank"))


@query(
    "concat_files",
    f"WITH {OBS_SQL} SELECT sid, count(*) AS n, count(SNR) AS n_snr, count(phi) AS n_phi FROM obs GROUP BY 1",
)
def concat_files(spark, sf):
    o = obs(spark, sf)
    a = o.where("receiver = 'canopy'").select("epoch", "sid", "SNR", "phi")
    b = o.where("receiver = 'reference'").select("epoch", "sid", "phi", "SNR", "theta")
    out = a.unionByName(b, allowMissingColumns=True)
    return out.groupBy("sid").agg(
        F.count(F.lit(1)).alias("n"), F.count("SNR").alias("n_snr"), F.count("phi").alias("n_phi")
    )
