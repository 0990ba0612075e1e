"""NMEA 0183 logs: SNR per satellite from GSV, epochs from RMC and GGA."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from leafwave.sources.lines import read_lines, timestamp_of

SENTENCE = r"^\$(GPRMC|GNRMC|GPGGA|GNGGA|GPGSV|GLGSV|GAGSV|GBGSV|GNGSV)"
CHECKED = r"^\$(.+)\*([0-9A-Fa-f]{2})$"

# Talker, first and last PRN, system, PRN of slot 0.
PRN_RANGES = (
    ("GP", 1, 32, "G", 0),
    ("GP", 33, 64, "S", 32),
    ("GL", 1, 32, "R", 0),
    ("GL", 65, 96, "R", 64),
    ("GA", 1, 36, "E", 0),
    ("GB", 1, 63, "C", 0),
    ("GN", 1, 32, "G", 0),
    ("GN", 33, 64, "S", 32),
    ("GN", 65, 96, "R", 64),
    ("GN", 301, 336, "E", 300),
    ("GN", 401, 463, "C", 400),
)
# Band and code per system without a signal id.
DEFAULT_SIGNAL = {"G": "L1|C", "R": "G1|C", "E": "E1|C", "C": "B1I|I", "S": "L1|C"}
# Band and code per system + signal id.
SIGNAL_IDS = {
    "G1": "L1|C",
    "G5": "L2|M",
    "G6": "L2|L",
    "G7": "L5|I",
    "G8": "L5|Q",
    "S1": "L1|C",
    "E1": "E5a|X",
    "E2": "E5b|X",
    "E7": "E1|X",
    "R1": "G1|C",
    "R3": "G2|C",
    "C1": "B1I|I",
    "C3": "B1C|X",
    "C5": "B2a|X",
    "CB": "B2I|I",
}


def checksum(sentence: Column) -> Column:
    """XOR of the characters between '$' and '*', as two hex digits."""
    payload = F.regexp_extract(sentence, CHECKED, 1)
    codes = F.transform(F.split(payload, ""), F.ascii)
    total = F.aggregate(codes, F.lit(0), lambda a, b: a.bitwiseXOR(b))
    return F.lpad(F.hex(total), 2, "0")


def checksum_ok(sentence: Column) -> Column:
    stated = F.upper(F.regexp_extract(sentence, CHECKED, 2))
    return (stated != "") & (stated == checksum(sentence))


def prn_to_sv(talker: Column, prn: Column) -> Column:
    out = F.lit(None).cast("string")
    for t, lo, hi, system, base in reversed(PRN_RANGES):
        sv = F.concat(F.lit(system), F.lpad((prn - base).cast("string"), 2, "0"))
        out = F.when((talker == t) & prn.between(lo, hi), sv).otherwise(out)
    return out


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def signal_of(sv: Column, signal_id: Column) -> Column:
    """``band|code`` from the signal id, else the system's default."""
    system = F.substring(sv, 1, 1)
    return F.coalesce(
        F.try_element_at(_literal_map(SIGNAL_IDS), F.concat(system, F.upper(signal_id))),
        F.try_element_at(_literal_map(DEFAULT_SIGNAL), system),
        F.lit("L1|X"),
    )


def _clock(text: Column) -> tuple[Column, Column, Column]:
    return (
        F.substring(text, 1, 2).try_cast("int"),
        F.substring(text, 3, 2).try_cast("int"),
        F.substring(text, 5, 12).try_cast("decimal(16,6)"),
    )


def _kind() -> Column:
    return F.substring("line", 4, 3)


def _fields() -> Column:
    """Field 0 is the sentence name."""
    return F.split(F.regexp_extract("line", r"^(.*)\*[^*]*$", 1), ",")


def _marks(rows: DataFrame, told: Column) -> DataFrame:
    """``rows`` with the ``date`` an RMC sets and the ``mark`` of what sets an epoch: an RMC's own, or the clock of a GGA."""
    rows = rows.withColumn("f", F.when(told, _fields()))
    field = lambda i: F.get("f", F.lit(i))
    h, mi, s = _clock(field(1))
    date = field(9)
    yy = F.substring(date, 5, 2).try_cast("int")
    year = yy + F.when(yy < 80, 2000).otherwise(1900)
    own = timestamp_of(year, F.substring(date, 3, 2).try_cast("int"), F.substring(date, 1, 2).try_cast("int"), h, mi, s)
    rows = rows.withColumn("own", F.when(_kind() == "RMC", own))
    told_clock = (_kind() == "GGA") & timestamp_of(F.lit(1970), F.lit(1), F.lit(1), h, mi, s).isNotNull()
    mark = F.struct(F.col("own").alias("epoch"), h.alias("h"), mi.alias("mi"), s.alias("s"))
    return rows.withColumns({"date": F.to_date("own"), "mark": F.when(F.col("own").isNotNull() | told_clock, mark)})


def _epoch(mark: Column, date: Column) -> Column:
    return F.coalesce(mark["epoch"], timestamp_of(F.year(date), F.month(date), F.day(date), mark["h"], mark["mi"], mark["s"]))


def parse_sentences(lines: DataFrame) -> DataFrame:
    """(path, epoch, sid, SNR) from ordered lines (path, block, pos, line).

    Sentences with a wrong checksum are skipped. An RMC sets date and time, a
    GGA the time on the last date; satellites before the first epoch are
    dropped, and the largest SNR of a signal within an epoch counts.
    """
    rows = lines.select("path", "block", "pos", F.trim("line").alias("line")).where(F.col("line").rlike(SENTENCE))
    # One row per split of a file: the last date told in it, and what sets its last epoch.
    told = _marks(rows, (_kind() != "GSV") & checksum_ok(F.col("line")))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("pos"))).alias(c)
    ends = told.groupBy("path", "block").agg(last("date"), last("mark"))
    across = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("date_before", F.last("date", True).over(across))
    ends = ends.withColumn("end", _epoch(F.col("mark"), F.coalesce("date", "date_before")))
    ends = ends.select("path", "block", "date_before", F.last("end", True).over(across).alias("epoch_before"))

    inside = Window.partitionBy("path", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _marks(rows.where(checksum_ok(F.col("line"))), _kind() != "GSV")
    rows = rows.select("path", "block", "pos", F.when(_kind() == "GSV", F.col("line")).alias("line"), "date", "mark")
    rows = rows.withColumns({c: F.last(c, True).over(inside) for c in ("date", "mark")})
    rows = rows.where(F.col("line").isNotNull()).join(ends, ["path", "block"], "left")
    # An RMC after the GGA would have set the epoch itself, so the last date is still the one the GGA had.
    epoch = F.coalesce(_epoch(F.col("mark"), F.coalesce("date", "date_before")), "epoch_before")
    gsv = rows.select("path", epoch.alias("epoch"), "line", _fields().alias("f")).where(F.col("epoch").isNotNull())
    after_header = F.size("f") - 4
    last = F.trim(F.element_at("f", -1))
    has_id = (after_header > 0) & (F.pmod(after_header, F.lit(4)) == 1) & (F.length(last) == 1)
    gsv = gsv.withColumn("signal_id", F.when(has_id, last))
    end = F.size("f") - F.when(has_id, 1).otherwise(0)
    starts = F.when(end > 4, F.sequence(F.lit(4), end - 1, F.lit(4))).otherwise(F.array().cast("array<int>"))
    sats = F.transform(
        starts,
        lambda i: F.struct(
            F.get("f", i).alias("prn"), F.when(i + 3 < end, F.get("f", i + 3)).alias("snr")
        ),
    )
    out = gsv.select(
        "path", "epoch", F.substring("line", 2, 2).alias("talker"), "signal_id", F.explode(sats).alias("s")
    )
    out = out.withColumn("sv", prn_to_sv(F.col("talker"), F.trim("s.prn").try_cast("int")))
    out = out.where(F.col("sv").isNotNull())
    sid = F.concat_ws("|", "sv", signal_of(F.col("sv"), F.col("signal_id")))
    return out.groupBy("path", "epoch", sid.alias("sid")).agg(
        F.max(F.trim("s.snr").try_cast("double")).cast("float").alias("SNR")
    )


def read_nmea(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_sentences(read_lines(spark, path))
