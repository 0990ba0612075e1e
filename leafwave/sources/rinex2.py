"""RINEX 2.11 observation files.

Epochs have no marker character, so lines are read in order, each epoch line
is recognised by its fixed columns, and the lines that follow (at most a few
dozen) are gathered under it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafwave.functions.signals import BANDS
from leafwave.schema import OBSERVABLES
from leafwave.session import broadcast_checked, cut_lineage
from leafwave.sources.lines import fill_forward, number, read_lines, timestamp_of

EPOCH_LINE = r"^ [ \d]\d [ \d]\d [ \d]\d [ \d]\d [ \d]\d[ \d]{3}\.\d{7}  [0-6][ \d]{2}\d"
OBS_TYPES = "# / TYPES OF OBSERV"
SATS_PER_LINE, FIELDS_PER_LINE, FIELD = 12, 5, 16
MAX_BROADCAST_FILES = 20_000

# Codes with a stated tracking mode; all others are X.
TRACKING = {"C1": "C", "P1": "P", "C2": "C", "P2": "P"}


def _label(line: Column) -> Column:
    return F.rtrim(F.substring(line, 61, 20))


def parse_headers(lines: DataFrame) -> DataFrame:
    """(path, codes): the file's two-character observation codes in column order."""
    rows = lines.where(_label(F.col("line")) == OBS_TYPES)
    # A handful of header lines per file.
    per_file = rows.groupBy("path").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("block", "pos", "line"))), lambda r: r["line"]).alias("ls")
    )
    codes = F.flatten(
        F.transform(
            "ls",
            lambda x: F.transform(F.sequence(F.lit(0), F.lit(8)), lambda j: F.trim(F.substring(x, 11 + 6 * j, F.lit(2)))),
        )
    )
    return per_file.select("path", F.filter(codes, lambda c: c != "").alias("codes"))


def satellite_of(text: Column) -> Column:
    """Blank system letters mean GPS; the number gets two digits."""
    t = F.trim(text)
    letter = F.when(t.rlike(r"^\d"), F.lit("G")).otherwise(F.upper(F.substring(t, 1, 1)))
    digits = F.trim(F.regexp_replace(t, r"^[A-Za-z]", ""))
    return F.when(digits != "", F.concat(letter, F.lpad(digits, 2, "0")))


def _band_map() -> Column:
    pairs = [
        x for s, bands in BANDS.items() for b, spec in bands.items() for x in (F.lit(s + spec[0]), F.lit(b))
    ]
    return F.create_map(*pairs)


def parse_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Observation rows from ordered lines (path, block, pos, line).

    Event records (flags 2 to 6) carry no observations. Zero means missing.
    """
    is_epoch = F.col("line").rlike(EPOCH_LINE)
    rows = fill_forward(lines, F.when(is_epoch, F.struct("block", "pos")), "head")
    rows = rows.where(F.col("head").isNotNull())
    # One epoch's lines: bounded by the satellites in view.
    epochs = rows.groupBy("path", "head").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("block", "pos", "line"))), lambda r: F.rpad(r["line"], 80, " ")
        ).alias("ls")
    )
    first = F.element_at("ls", 1)
    part = lambda start, width: F.substring(first, start, width)
    yy = number(part(2, 2), "int")
    epoch = timestamp_of(
        yy + F.when(yy >= 80, 1900).otherwise(2000), *[number(part(p, 2), "int") for p in (5, 8, 11, 14)],
        number(part(16, 11), "decimal(16,6)"),
    )
    epochs = epochs.select(
        "path", "ls", epoch.alias("epoch"), number(part(29, 1), "int").alias("flag"),
        number(part(30, 3), "int").alias("n"),
    )
    epochs = epochs.where(F.col("epoch").isNotNull() & F.col("flag").isin(0, 1) & (F.col("n") > 0))
    epochs = epochs.join(headers, "path")
    sat_lines = F.ceil(F.col("n") / F.lit(SATS_PER_LINE)).cast("int")
    per_sat = F.ceil(F.size("codes") / F.lit(FIELDS_PER_LINE)).cast("int")
    sats = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.struct(
            satellite_of(
                F.substring(
                    F.get("ls", F.floor(i / F.lit(SATS_PER_LINE)).cast("int")),
                    33 + 3 * F.pmod(i, F.lit(SATS_PER_LINE)),
                    F.lit(3),
                )
            ).alias("sv"),
            F.array_join(F.slice("ls", sat_lines + i * per_sat + 1, per_sat), "").alias("text"),
        ),
    )
    obs = epochs.select("path", "epoch", "codes", F.explode(sats).alias("s")).where(F.col("s.sv").isNotNull())
    field = F.substring("s.text", 1 + FIELD * F.col("i"), F.lit(FIELD))
    long = obs.select("path", "epoch", "s", F.posexplode("codes").alias("i", "v2")).withColumn("field", field)
    kind = F.when(F.substring("v2", 1, 1) == "P", "C").otherwise(F.substring("v2", 1, 1))
    tracking = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in TRACKING.items() for x in kv]), F.col("v2")), F.lit("X")
    )
    band = F.try_element_at(_band_map(), F.concat(F.substring("s.sv", 1, 1), F.substring("v2", 2, 1)))
    value = number(F.substring("field", 1, 14))
    long = long.select(
        "path", "epoch", F.concat(F.col("s.sv"), F.lit("|"), band, F.lit("|"), tracking).alias("sid"), "i",
        kind.alias("kind"), F.when(value != 0, value).alias("value"),
        F.substring("field", 15, 1).try_cast("tinyint").alias("lli"),
        F.substring("field", 16, 1).try_cast("tinyint").alias("ssi"),
    )
    long = long.where(F.col("sid").isNotNull() & F.col("value").isNotNull())
    # The four kinds of one signal sit in different columns of the same record.
    last = lambda c: F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col("i")))
    pick = lambda k: F.max_by(F.col("value"), F.when(F.col("kind") == k, F.col("i")))
    return long.groupBy("path", "epoch", "sid").agg(
        pick("S").cast("float").alias("SNR"), pick("C").alias("Pseudorange"), pick("L").alias("Phase"),
        pick("D").cast("float").alias("Doppler"), last("lli").alias("LLI"), last("ssi").alias("SSI"),
    )


def read_rinex2(spark: SparkSession, path: str | list[str], columns: Sequence[str] = OBSERVABLES) -> DataFrame:
    lines = read_lines(spark, path)
    headers = broadcast_checked(cut_lineage(parse_headers(lines)), MAX_BROADCAST_FILES)
    return parse_lines(lines, headers).select("path", "epoch", "sid", *columns)
