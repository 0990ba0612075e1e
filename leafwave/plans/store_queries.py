"""Writes to the store, read back: each strategy, and the same retrieval written twice."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leafwave.operators import dedup, fingerprint, sketches
from leafwave.operators.assign import cached_grid
from leafwave.operators.retrieval import calculate_vod
from leafwave.plans.base import ORACLES, OBS_SQL, PASSES_SQL, nearest_sql, obs, passes, query
from leafwave.plans.filter_queries import RECT_GRIDS
from leafwave.plans.join_queries import KEY, stored_and_incoming
from leafwave.session import checkpoint_dir
from leafwave.store import ObservationStore

_MATRIX = (("initial", "skip", False), ("append", "append", True), ("overwrite", "overwrite", True))
_SKIPPED = "THEN 'skipped' ELSE 'written' END AS action"
_INSTEAD = {
    "initial": "THEN 'skipped' ELSE 'initial' END AS action",
    "append": "THEN 'appended' ELSE 'written' END AS action",
    "overwrite": "THEN 'overwritten' ELSE 'written' END AS action",
}

for _name, _strategy, _exists in _MATRIX:

    @query(f"batch_write_actions_{_name}", ORACLES["batch_write_actions"].replace(_SKIPPED, _INSTEAD[_name]))
    def actions(spark, sf, strategy=_strategy, exists=_exists):
        stored, incoming = stored_and_incoming(spark, sf)
        marked = dedup.mark_existing(incoming, stored, KEY)
        return dedup.batch_actions(marked, strategy, exists).select("receiver", "file_id", "exists_layer", "action")


def _store(spark) -> ObservationStore:
    return ObservationStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/leafwave-store/{uuid.uuid4().hex}")


VOD_SQL = OBS_SQL + """, m AS (SELECT receiver, CAST(epoch AS DATE) AS day, sid, avg(SNR) AS SNR, avg(theta) AS theta FROM obs GROUP BY 1, 2, 3),
vod AS (SELECT c.sid, -ln(pow(10, (c.SNR - r.SNR)/10.0::DOUBLE)) * cos(c.theta) AS VOD
  FROM m c JOIN m r ON c.day = r.day AND c.sid = r.sid AND c.receiver = 'canopy' AND r.receiver = 'reference')"""


@query("vod_written_twice", f"WITH {VOD_SQL} SELECT sid, count(*) AS n, round(sum(VOD),6) AS sum_vod FROM vod GROUP BY sid")
def vod_written_twice(spark, sf):
    """Daily retrievals, stored, stored again and read: the second writing changes nothing."""
    days = obs(spark, sf).groupBy("receiver", F.date_trunc("day", "epoch").cast("timestamp_ntz").alias("epoch"), "sid").agg(
        F.avg("SNR").alias("SNR"), F.avg("phi").alias("phi"), F.avg("theta").alias("theta")
    )
    side = lambda name: days.where(F.col("receiver") == name).drop("receiver")
    vod = calculate_vod(side("canopy"), side("reference"))
    store = _store(spark)
    for _ in range(2):
        store.write_vod(vod, "canopy_sky", "files of the canopy", "files of the sky")
    return store.read("vod_canopy_sky").groupBy("sid").agg(F.count("*").alias("n"), F.round(F.sum("VOD"), 6).alias("sum_vod"))


for _kind in ("fibonacci", "equirectangular"):

    @query(
        f"stored_grid_{_kind}",
        f"WITH {PASSES_SQL}, {RECT_GRIDS[_kind]}, {nearest_sql('passes', 'cells')} SELECT receiver, cell_id, count(*) AS n, round(avg(SNR),6) AS mean_snr FROM cells GROUP BY 1, 2",
    )
    def stored_grid(spark, sf, kind=_kind):
        """Cells assigned by a grid that was written, and loaded without its builder."""
        store = _store(spark)
        store.store_grid(cached_grid(kind, 10.0), "sky")
        rows = store.load_grid("sky").assign(passes(spark, sf), out="cell_id")
        return rows.groupBy("receiver", "cell_id").agg(F.count("*").alias("n"), F.round(F.avg("SNR"), 6).alias("mean_snr"))


@query(
    "frozen_output_drift",
    f"""WITH {OBS_SQL}, d AS (SELECT *, CAST(epoch AS DATE) AS day, receiver = 'canopy' AND day(epoch) = 13 AS gone, sid LIKE 'G%' AND day(epoch) = 7 AS other FROM obs),
p AS (SELECT day, count(*) AS n_before, count(*) FILTER (NOT gone) AS n_after, bool_or(other) AS other FROM d GROUP BY day)
SELECT day, v.variable, n_before, n_after, n_before = n_after AND NOT (other AND v.variable = 'SNR') AS same FROM p, (VALUES ('SNR'), ('phi'), ('theta'), ('receiver')) v(variable)""",
)
def frozen_output_drift(spark, sf):
    """An output frozen, and a later one that lost a receiver on some days and has other values on others."""
    before = obs(spark, sf)
    path = fingerprint.freeze(before, f"{checkpoint_dir(spark).rstrip('/')}/leafwave-frozen/{uuid.uuid4().hex}", {"run": "first"})
    day = F.dayofmonth("epoch")
    after = before.where(~((F.col("receiver") == "canopy") & (day == 13)))
    after = after.withColumn("SNR", F.when(F.col("sid").startswith("G") & (day == 7), F.col("SNR") + 1).otherwise(F.col("SNR")))
    return fingerprint.compare_with_frozen(after, path)


@query(
    "daily_sketches_merged",
    f"WITH {OBS_SQL} SELECT receiver, p AS prob, count(SNR) AS n, round(min(SNR),6) AS least, round(max(SNR),6) AS most, true AS merged_within, true AS direct_within FROM obs, (VALUES "
    + ", ".join(f"({p}::DOUBLE)" for p in sketches.PROBS)
    + ") v(p) GROUP BY 1, 2",
)
def daily_sketches_merged(spark, sf):
    """Quantiles from sketches of single days, and from one sketch of all rows: both within twice their error of the wanted rank."""
    o = obs(spark, sf)
    kept = sketches.load(spark, sketches.save(sketches.day_sketches(o, ["SNR"], ["receiver"]), f"{checkpoint_dir(spark).rstrip('/')}/leafwave-sketches/{uuid.uuid4().hex}"))
    probs = F.array(*[F.lit(p) for p in sketches.PROBS])
    told = sketches.summary(sketches.merged(kept, ["receiver"]))
    size = sketches.sketch_size(sketches.EPSILON)
    direct = o.groupBy("receiver").agg(F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double("SNR", F.lit(size)), probs).alias("direct"))
    each = told.join(direct, "receiver").select("receiver", "n", "min", "max", F.inline(F.arrays_zip(probs.alias("prob"), "quantiles", "direct")))
    # A row per receiver and quantile.
    met = o.select("receiver", "SNR").join(F.broadcast(each), "receiver")
    place = lambda c, op: F.sum(op(F.col("SNR"), F.col(c)).cast("bigint")) / F.col("n")
    tolerance = F.lit(2 * sketches.EPSILON)

    def near(c):
        return (place(c, lambda x, q: x < q) - tolerance <= F.col("prob")) & (F.col("prob") <= place(c, lambda x, q: x <= q) + tolerance)

    return met.groupBy("receiver", "prob", "n", "min", "max").agg(near("quantiles").alias("merged_within"), near("direct").alias("direct_within")).select(
        "receiver", "prob", "n", F.round("min", 6).alias("least"), F.round("max", 6).alias("most"), "merged_within", "direct_within"
    )
