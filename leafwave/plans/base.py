"""Registry of queries and the observation views they read.

The given tables become observation tables by plain arithmetic that Spark and
DuckDB carry out alike, over every row:

* ``obs`` from ``events``: the event type says which receiver saw the row, the
  user is the satellite signal, ``value`` scales to SNR, and direction comes
  from user and time.
* ``passes`` from ``lineitem``: a larger daily log, one row per line item.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafwave.functions.timeutil import micros
from leafwave.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DEG = 0.017453292519943295
TWO_PI = 6.283185307179586


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where DuckDB can answer it, its SQL."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, and -0.0 turned into 0.0."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "double":
            c = F.round(c, digits) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


# -- observation views ------------------------------------------------------


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    s = F.floor(micros("ts") / F.lit(1_000_000))
    u = F.col("user_id")
    system = F.substring(F.lit("GREC"), (F.pmod(u, F.lit(4)) + 1).cast("int"), F.lit(1))
    slot = F.lpad((F.pmod(F.floor(u / 4), F.lit(30)) + 1).cast("string"), 2, "0")
    second = F.pmod(F.floor(u / 120), F.lit(2)) == 1
    band = (
        F.when(system == "G", F.when(second, "L2").otherwise("L1"))
        .when(system == "R", F.when(second, "G2").otherwise("G1"))
        .when(system == "E", F.when(second, "E5a").otherwise("E1"))
        .otherwise(F.when(second, "B3I").otherwise("B1I"))
    )
    canopy = F.col("event_type").isin("view", "click", "purchase")
    return e.select(
        F.when(canopy, "canopy").otherwise("reference").alias("receiver"),
        F.col("ts").alias("epoch"),
        F.concat_ws("|", F.concat(system, slot), band, F.lit("C")).alias("sid"),
        (F.lit(20.0) + F.col("value") / F.lit(15.0)).alias("SNR"),
        ((F.pmod(u * 37 + F.floor(s / 60), F.lit(3600)) / F.lit(10.0) + F.lit(0.037)) * F.lit(DEG)).alias("phi"),
        ((F.pmod(u * 53 + F.floor(s / 240), F.lit(899)) / F.lit(10.0) + F.lit(0.013)) * F.lit(DEG)).alias("theta"),
    )


OBS_SQL = f"""obs AS (
  SELECT CASE WHEN event_type IN ('view','click','purchase') THEN 'canopy' ELSE 'reference' END AS receiver,
    ts AS epoch,
    substr('GREC', CAST(user_id % 4 + 1 AS INT), 1) || lpad(CAST((user_id // 4) % 30 + 1 AS VARCHAR), 2, '0') || '|' ||
      CASE substr('GREC', CAST(user_id % 4 + 1 AS INT), 1)
        WHEN 'G' THEN CASE WHEN (user_id // 120) % 2 = 1 THEN 'L2' ELSE 'L1' END
        WHEN 'R' THEN CASE WHEN (user_id // 120) % 2 = 1 THEN 'G2' ELSE 'G1' END
        WHEN 'E' THEN CASE WHEN (user_id // 120) % 2 = 1 THEN 'E5a' ELSE 'E1' END
        ELSE CASE WHEN (user_id // 120) % 2 = 1 THEN 'B3I' ELSE 'B1I' END END || '|C' AS sid,
    20.0::DOUBLE + value / 15.0::DOUBLE AS SNR,
    (((user_id * 37 + (epoch_us(ts) // 1000000) // 60) % 3600) / 10.0::DOUBLE + 0.037::DOUBLE) * {DEG}::DOUBLE AS phi,
    (((user_id * 53 + (epoch_us(ts) // 1000000) // 240) % 899) / 10.0::DOUBLE + 0.013::DOUBLE) * {DEG}::DOUBLE AS theta
  FROM events)"""


def passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_suppkey")
    day = F.datediff("l_shipdate", F.lit("1995-01-01").cast("date")).cast("bigint")
    system = F.substring(F.lit("GREC"), (F.pmod(k, F.lit(4)) + 1).cast("int"), F.lit(1))
    slot = F.lpad((F.pmod(F.floor(k / 4), F.lit(24)) + 1).cast("string"), 2, "0")
    return li.select(
        F.when(F.col("l_returnflag") == "N", "reference").otherwise("canopy").alias("receiver"),
        F.col("l_shipdate").alias("epoch"),
        F.concat(system, slot, F.lit("|L1|C")).alias("sid"),
        (F.lit(20.0) + F.col("l_quantity") * F.lit(0.5) + F.col("l_discount") * F.lit(50.0)).alias("SNR"),
        ((F.pmod(k * 37 + day * 11, F.lit(3600)) / F.lit(10.0) + F.lit(0.037)) * F.lit(DEG)).alias("phi"),
        ((F.pmod(k * 53 + day * 7, F.lit(899)) / F.lit(10.0) + F.lit(0.013)) * F.lit(DEG)).alias("theta"),
    )


PASSES_SQL = f"""passes AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN 'reference' ELSE 'canopy' END AS receiver, l_shipdate AS epoch,
    substr('GREC', CAST(l_suppkey % 4 + 1 AS INT), 1) || lpad(CAST((l_suppkey // 4) % 24 + 1 AS VARCHAR), 2, '0') || '|L1|C' AS sid,
    20.0::DOUBLE + l_quantity * 0.5::DOUBLE + l_discount * 50.0::DOUBLE AS SNR,
    (((l_suppkey * 37 + date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 11) % 3600) / 10.0::DOUBLE + 0.037::DOUBLE) * {DEG}::DOUBLE AS phi,
    (((l_suppkey * 53 + date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 7) % 899) / 10.0::DOUBLE + 0.013::DOUBLE) * {DEG}::DOUBLE AS theta
  FROM lineitem)"""


def grid_sql(resolution: float = 10.0, name: str = "grid") -> str:
    """The equal-area grid (no cutoff) in SQL, from the same construction."""
    return f"""
  {name}_edges AS (SELECT CAST(i AS INT) AS band,
      radians({resolution}::DOUBLE)/2 + (i-1)*radians({resolution}::DOUBLE) AS lo, radians({resolution}::DOUBLE)/2 + i*radians({resolution}::DOUBLE) AS hi
    FROM range(0, CAST(ceil((pi()/2 - radians({resolution}::DOUBLE)/2)/radians({resolution}::DOUBLE)) AS BIGINT)) t(i)),
  {name}_bands AS (SELECT band, CASE WHEN band=0 THEN 0.0 ELSE lo END AS theta_min, hi AS theta_max,
      CASE WHEN band=0 THEN 1 ELSE greatest(1, CAST(round(2*pi()*(cos(lo)-cos(hi))/(2*pi()*(1-cos(radians({resolution}::DOUBLE)/2)))) AS INT)) END AS n
    FROM {name}_edges),
  {name} AS (SELECT CAST(row_number() OVER (ORDER BY band, k) - 1 AS INT) AS cell_id,
      CASE WHEN band=0 THEN 0.0 ELSE (k*(2*pi()/n) + CASE WHEN k+1=n THEN 2*pi() ELSE (k+1)*(2*pi()/n) END)/2 END AS phi,
      CASE WHEN band=0 THEN 0.0 ELSE (theta_min+theta_max)/2 END AS theta,
      k*(2*pi()/n) AS phi_min, CASE WHEN k+1=n THEN 2*pi() ELSE (k+1)*(2*pi()/n) END AS phi_max, theta_min, theta_max
    FROM {name}_bands, range(0, n) r(k))"""


def nearest_sql(source: str, out: str, grid: str = "grid") -> str:
    """Brute-force nearest cell of every row of ``source`` (needs phi, theta)."""
    return f"""
  {out}_dirs AS (SELECT DISTINCT phi, theta FROM {source}),
  {out}_near AS (SELECT d.phi, d.theta, arg_min(g.cell_id, (-round(sin(d.theta)*cos(d.phi)*sin(g.theta)*cos(g.phi)
        + sin(d.theta)*sin(d.phi)*sin(g.theta)*sin(g.phi) + cos(d.theta)*cos(g.theta), 12), g.cell_id)) AS cell_id
      FROM {out}_dirs d, {grid} g GROUP BY d.phi, d.theta),
  {out} AS (SELECT s.*, n.cell_id FROM {source} s JOIN {out}_near n ON s.phi = n.phi AND s.theta = n.theta)"""
