"""Septentrio binary files.

``sbf_source`` reads byte ranges of files as tagged rows of raw integers; what
gives them meaning (leap seconds, satellite ids, signals, scaling, time, which
epoch a block belongs to) is Column algebra and small joins on those rows.

A file's leap seconds and frequency numbers carry on from block to block, and a
status block belongs to the next measurement epoch. Ranges are read alone, so
each adds one summary row; one pass over these per file says what every range
starts with and which epoch follows it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from leafwave.functions import sbf as sc
from leafwave.functions.timeutil import gps_time_to_utc
from leafwave.session import broadcast_checked, cut_lineage
from leafwave.sources.sbf_source import DDL, KINDS, RANGE_BYTES, SbfSource, range_rows

DEFAULT_LEAP_SECONDS = 18
#: Rows of a state table (ranges, frequency changes) that are broadcast; larger ones are shuffled.
MAX_BROADCAST_STATE = 500_000
STATE = ("range", "channel")
ROWS = tuple(k for k in KINDS if k not in STATE)


# -- raw rows ---------------------------------------------------------------------


def read_blocks(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, kinds: Sequence[str] = KINDS) -> DataFrame:
    """Rows of the block reader; a task reads one byte range, or several small ones."""
    spark.dataSource.register(SbfSource)
    one = path if isinstance(path, str) else json.dumps(list(path))
    return spark.read.format("sbf").options(rangeBytes=range_bytes, kinds=",".join(kinds)).load(one)


def read_whole(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, kinds: Sequence[str] = KINDS) -> DataFrame:
    """The same rows through Spark's own file reader, for stores only it can open; a file, of 2 GB at most, is one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                data = data.as_py()
                for at in range(0, len(data), range_bytes):
                    yield from range_rows(name, lambda i, n, d=data: d[i : i + n], len(data), at, min(at + range_bytes, len(data)), tuple(kinds))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, DDL)


def range_states(blocks: DataFrame) -> DataFrame:
    """Per range: leap seconds before its first block, and the first epoch of the ranges after it."""
    ranges = blocks.where("kind = 'range'")
    order = Window.partitionBy("path").orderBy("part")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    told = ranges.withColumn("leap_in", F.coalesce(F.last("leap", True).over(before), F.lit(DEFAULT_LEAP_SECONDS)))
    first = F.when(
        F.col("epoch_at").isNotNull(),
        F.struct("epoch_at", "epoch_tow", "epoch_week", F.coalesce("epoch_leap", "leap_in").alias("epoch_leap")),
    )
    following = F.first(first, True).over(order.rowsBetween(1, Window.unboundedFollowing))
    return told.select("path", "part", "leap_in", following.alias("following"))


def frequency_spans(blocks: DataFrame) -> DataFrame:
    """Per (path, svid) the places from which to which a frequency number holds.

    Before the first one told, the last one of the file holds; a number that
    never changes is one span.
    """
    order = Window.partitionBy("path", "svid").orderBy("at")
    last = F.last("freq_nr").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    told = blocks.where("kind = 'channel'").select("path", "svid", "at", "freq_nr").withColumn("before", F.coalesce(F.lag("freq_nr").over(order), last))
    change = F.col("before") != F.col("freq_nr")
    spans = told.where(change).select("path", "svid", F.col("at").alias("lo"), F.lead("at").over(order).alias("hi"), "freq_nr")
    early = told.groupBy("path", "svid").agg(F.lit(-1).cast("long").alias("lo"), F.min(F.when(change, F.col("at"))).alias("hi"), F.max_by("freq_nr", "at").alias("freq_nr"))
    return spans.unionByName(early)


def with_state(blocks: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Rows of ``blocks`` with leap seconds, epoch and frequency number from other ranges, and the UTC epoch.

    ``state`` has the rows of kind ``range`` and ``channel``, read once.
    """
    state = blocks.where(F.col("kind").isin(*STATE)) if state is None else state
    rows = blocks.where(F.col("kind").isin(*ROWS))
    ranges = broadcast_checked(range_states(state), MAX_BROADCAST_STATE)
    rows = rows.join(ranges, ["path", "part"], "left")
    rows = rows.withColumn("leap", F.coalesce("leap", "leap_in")).withColumn("epoch_leap", F.coalesce("epoch_leap", F.when(F.col("epoch_at").isNotNull(), F.col("leap_in"))))
    rows = rows.withColumns({c: F.coalesce(c, f"following.{c}") for c in ("epoch_leap", "epoch_tow", "epoch_week", "epoch_at")}).drop("leap_in", "following")
    spans = broadcast_checked(frequency_spans(state), MAX_BROADCAST_STATE).select("path", "svid", "lo", "hi", F.col("freq_nr").alias("told"))
    r, f = rows.drop("freq_nr").alias("r"), spans.alias("f")
    match = (F.col("r.path") == F.col("f.path")) & (F.col("r.svid") == F.col("f.svid")) & (F.col("r.at") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("r.at") < F.col("hi")))
    return with_epoch(r.join(f, match, "left").select("r.*", F.col("told").alias("freq_nr")))


def read_raw(
    spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, whole_files: bool = False, kinds: Sequence[str] = ROWS,
) -> DataFrame:
    """Tagged raw rows of the wanted kinds, with the UTC epoch of the block (``epoch``) and of the measurement epoch it
    belongs to (``epoch_at``, its place in the file, and ``of_epoch``)."""
    read = read_whole if whole_files else read_blocks
    return with_state(read(spark, path, range_bytes, kinds), cut_lineage(read(spark, path, range_bytes, STATE)))


def with_epoch(raw: DataFrame) -> DataFrame:
    raw = raw.withColumn("epoch", gps_time_to_utc("tow", "week", "leap"))
    return raw.withColumn("of_epoch", gps_time_to_utc("epoch_tow", "epoch_week", "epoch_leap")) if "epoch_tow" in raw.columns else raw


# -- observations -------------------------------------------------------------------


def observations(raw: DataFrame, *keys: str | Column) -> DataFrame:
    """(path, epoch, sid, SNR, Pseudorange, Phase, Doppler) from raw rows, and ``keys`` of them."""
    c = F.col
    rows = raw.where(c("kind") == "obs")
    sig1 = sc.signal_number(c("type"), c("obs_info"))
    slave = c("type2").isNotNull()
    sig = F.when(slave, sc.signal_number(c("type2"), c("obs_info2"))).otherwise(sig1)
    code_msb, dop_msb = sc.offset_msbs(c("offset_msb"))
    rows = rows.withColumns(
        {
            "__sig": sig,
            "__f1": sc.carrier_frequency(sig1, c("freq_nr")),
            "__f": sc.carrier_frequency(sig, c("freq_nr")),
            "__pr1": sc.pseudorange(c("misc"), c("code_lsb")),
            "__d1": sc.doppler(c("doppler")),
            "__cm": code_msb,
            "__dm": dop_msb,
            "sid": sc.sid_of(c("svid"), sig),
            "__known": sc.sid_of(c("svid"), sig1).isNotNull(),
        }
    )
    # A slave is only usable with its master's range, Doppler and carrier.
    rows = rows.where(
        c("sid").isNotNull()
        & (~slave | (c("__known") & c("__pr1").isNotNull() & c("__d1").isNotNull() & c("__f1").isNotNull()))
    )
    pr = F.when(slave, sc.pseudorange2(c("__pr1"), c("__cm"), c("code_offset_lsb"))).otherwise(c("__pr1"))
    dop = F.when(
        slave, sc.doppler2(c("__d1"), c("__dm"), c("doppler_offset_lsb"), c("__f"), c("__f1"))
    ).otherwise(c("__d1"))
    rows = rows.withColumn("__pr", pr)
    return rows.select(
        "path",
        "epoch",
        *keys,
        "sid",
        sc.cn0(c("cn0"), c("__sig")).cast("float").alias("SNR"),
        c("__pr").alias("Pseudorange"),
        sc.phase(c("__pr"), c("carrier_msb"), c("carrier_lsb"), c("__f")).alias("Phase"),
        dop.cast("float").alias("Doppler"),
    )


def sky(raw: DataFrame) -> DataFrame:
    """Receiver-reported directions: (path, epoch, sv, broadcast_theta, broadcast_phi in degrees, rise_set)."""
    rows = raw.where(F.col("kind") == "sky")
    return rows.select(
        "path", "epoch", sc.sv_of(F.col("svid")).alias("sv"), F.col("a").alias("broadcast_theta"),
        F.col("b").alias("broadcast_phi"), F.col("c").cast("int").alias("rise_set"),
    )


def positions(raw: DataFrame) -> DataFrame:
    """Per epoch: solution mode, latitude and longitude (rad), height (m) and dilution of precision."""
    rows = raw.where(F.col("kind").isin("pvt", "dop"))
    pick = lambda kind, col: F.max(F.when(F.col("kind") == kind, F.col(col)))
    return rows.groupBy("path", "epoch").agg(
        pick("pvt", "type").alias("pvt_mode"), pick("pvt", "a").alias("latitude"),
        pick("pvt", "b").alias("longitude"), pick("pvt", "c").alias("height"),
        pick("dop", "a").alias("pdop"), pick("dop", "b").alias("hdop"), pick("dop", "c").alias("vdop"),
    )


def observations_and_geometry(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both outputs of one decode: observations, and per (epoch, sid) angles in radians."""
    from leafwave.functions.sids import sid_part

    obs = observations(raw)
    angles = sky(raw).select(
        "path", "epoch", "sv", F.radians("broadcast_theta").alias("theta"), F.radians("broadcast_phi").alias("phi")
    )
    keyed = obs.select("path", "epoch", "sid", sid_part("sid", 0).alias("sv"))
    return obs, keyed.join(angles, ["path", "epoch", "sv"]).drop("sv")


def epoch_quality(raw: DataFrame) -> DataFrame:
    """One row per measurement epoch with what the receiver told of itself since the epoch before: dilution of precision,
    satellites used, accuracies, solution mode, age of corrections, load, temperature and errors. What was not told is NULL."""
    c = F.col
    rows = raw.where(c("kind").isin("obs", "pvt", "dop", "status") & c("epoch_at").isNotNull())
    pick = lambda kind, value: F.max_by(value, F.when(c("kind") == kind, c("at")))  # noqa: E731  (of the last block)
    field = lambda i: F.get("fields", i)
    known = lambda value, missing: F.when(value != missing, value)
    told = rows.groupBy("path", "epoch_at").agg(
        F.count(F.when(c("kind") == "obs", 1)).alias("__n"), F.min(F.when(c("kind") == "obs", c("epoch"))).alias("epoch"),
        pick("dop", c("a")).alias("pdop"), pick("dop", c("b")).alias("hdop"), pick("dop", c("c")).alias("vdop"),
        pick("pvt", field(0)).cast("int").alias("n_sv"), pick("pvt", known(field(2), 65535) * 0.01).alias("h_accuracy_m"),
        pick("pvt", known(field(3), 65535) * 0.01).alias("v_accuracy_m"), pick("pvt", c("type")).alias("pvt_mode"),
        pick("pvt", field(1) * 0.01).alias("mean_corr_age_s"), pick("status", c("a")).cast("int").alias("cpu_load"),
        pick("status", known(c("b"), 0) - 100).alias("temperature_c"), pick("status", c("c")).cast("long").alias("rx_error"),
    )
    return told.where("__n > 0").drop("__n", "epoch_at")


def with_told(raw: DataFrame) -> DataFrame:
    """Measured signals with what the receiver last told of them: ``extra`` (corrections) and ``seen`` (direction).

    Corrections meet a signal by its channel and signal number; those of a
    slave signal lie under its master's channel. A later block replaces the
    earlier one whole, with the rows it no longer has. All rows of an epoch meet
    in one shuffle, so the files are decoded once.
    """
    c = F.col
    rows = raw.where((c("kind") == "obs") | (c("kind").isin("extra", "sky") & c("epoch_at").isNotNull())).repartition("epoch_at", "path")
    signal = F.when(c("type2").isNotNull(), sc.signal_number(c("type2"), c("obs_info2"))).otherwise(sc.signal_number(c("type"), c("obs_info")))
    rows = rows.withColumns({"signal": signal, "sv": sc.sv_of(c("svid")), "__newest": F.max("at").over(Window.partitionBy("epoch_at", "path", "kind"))})
    rows = rows.where("kind = 'obs' OR at = __newest").drop("__newest")
    extra = F.when(c("kind") == "extra", F.struct("fields", "misc"))
    rows = rows.withColumn("extra", F.max(extra).over(Window.partitionBy("epoch_at", "path", "channel", "signal"))).where("kind <> 'extra'")
    seen = F.when(c("kind") == "sky", F.struct("a", "b", "c"))
    return rows.withColumn("seen", F.max(seen).over(Window.partitionBy("epoch_at", "path", "sv"))).where("kind = 'obs'")


def corrections() -> dict[str, Column]:
    """Multipath, smoothing, noise, lock and resolution of a signal ``with_told``."""
    field = lambda i: F.get("extra.fields", i)
    known = lambda i: F.when(field(i) != 65535, field(i))
    return {
        "mp_correction_m": field(0) * 0.001, "smoothing_corr_m": field(1) * 0.001, "code_var": known(2) * 1e-4, "carrier_var": known(3), "lock_time_s": known(4),
        "cum_loss_cont": field(5), "car_mp_corr_cycles": field(6) / 512, "cn0_highres_correction": F.col("extra.misc").bitwiseAND(7) * 0.03125,
    }


def signal_quality(raw: DataFrame) -> DataFrame:
    """Per (epoch, sid): direction the receiver told, and multipath, smoothing, noise, lock and resolution of the signal.
    Angles are radians."""
    rows = with_told(raw).withColumn("sid", sc.sid_of(F.col("svid"), F.col("signal"))).where("sid IS NOT NULL")
    return rows.select(
        "path", "epoch_at", "epoch", "sid", *[v.alias(n) for n, v in corrections().items()],
        F.radians("seen.a").alias("broadcast_theta"), F.radians("seen.b").alias("broadcast_phi"), F.when(F.col("seen.c") != 255, F.col("seen.c")).cast("int").alias("rise_set"),
    )


def corrected_observations(raw: DataFrame) -> DataFrame:
    """Observations with the finer SNR where the receiver told it, and the observables without its corrections
    (``SNR_raw``, ``Pseudorange_unsmoothed``, ``Pseudorange_raw``, ``Phase_raw``; NULL where it told none)."""
    c = F.col
    told = corrections()
    rows = observations(with_told(raw), *[told[n].alias(n) for n in ("mp_correction_m", "smoothing_corr_m", "car_mp_corr_cycles", "cn0_highres_correction")])
    fine = (c("SNR") + F.coalesce("cn0_highres_correction", F.lit(0.0))).cast("float")
    return rows.select(
        "path", "epoch", "sid", fine.alias("SNR"), "Pseudorange", "Phase", "Doppler", c("SNR").alias("SNR_raw"),
        (c("Pseudorange") + c("smoothing_corr_m")).alias("Pseudorange_unsmoothed"),
        (c("Pseudorange") + c("smoothing_corr_m") + c("mp_correction_m")).alias("Pseudorange_raw"),
        (c("Phase") + c("car_mp_corr_cycles")).alias("Phase_raw"),
    )


def read_sbf(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    return observations(read_raw(spark, path, range_bytes, kinds=("obs",)))
