"""Fingerprints: the same under any order, different for any change, and the days that changed."""

import datetime

import pytest
from pyspark.sql import functions as F

from leafwave.operators import fingerprint as fp


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(2000).select(
        F.timestamp_micros(F.col("id") * 600_000_000).cast("timestamp_ntz").alias("epoch"), F.concat(F.lit("G"), (F.col("id") % 7).cast("string")).alias("sid"),
        F.when(F.col("id") % 11 > 0, F.col("id") / 3).alias("SNR"), (F.col("id") % 5).cast("int").alias("SSI"), F.lit("x").alias("day"),
    )
    return df.unionByName(df.where("SSI = 3 AND sid = 'G4'"))  # some rows twice


def summary(df):
    return sorted(map(str, df.collect()))


def test_same_under_any_partitioning(table):
    want = summary(fp.fingerprints(table))
    for n in (1, 3, 17):
        assert summary(fp.fingerprints(table.repartition(n).orderBy(F.rand(n)))) == want
    assert fp.table_fingerprint(table).first() == fp.table_fingerprint(table.repartition(5)).first()


@pytest.mark.parametrize(
    "change",
    [
        lambda d: d.withColumn("SNR", F.when(F.col("SNR") == 100, 100.0000001).otherwise(F.col("SNR"))),
        lambda d: d.withColumn("SNR", F.coalesce("SNR", F.when(F.col("epoch") == F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), 0.0))),
        lambda d: d.unionByName(d.limit(1)),
        lambda d: d.where("epoch <> timestamp_ntz'1970-01-03 00:00:00'"),
    ],
)
def test_one_change_is_found(table, change):
    got = fp.compare(fp.fingerprints(table), fp.fingerprints(change(table)))
    assert {r["day"] for r in got.where("NOT same").collect()} and got.where("NOT same").select("day").distinct().count() == 1
    assert fp.table_fingerprint(table).first() != fp.table_fingerprint(change(table)).first()


def test_swapped_values_are_found(spark):
    """Two signals exchange their values: columns alone would sum to the same."""
    rows = [(datetime.datetime(2024, 1, 1), "a", 1.0), (datetime.datetime(2024, 1, 1), "b", 2.0)]
    schema = "epoch timestamp_ntz, sid string, SNR double"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame([(r[0], r[1], 3.0 - r[2]) for r in rows], schema)
    assert [r["same"] for r in fp.compare(fp.fingerprints(a), fp.fingerprints(b)).collect()] == [False]


def test_frozen_output(spark, table, tmp_path):
    path = fp.freeze(table, str(tmp_path / "f"), {"git": "abc", "day": 3})
    same = fp.compare_with_frozen(table.repartition(3), path)
    assert same.where("NOT same").isEmpty() and {r["variable"] for r in same.collect()} == {"SNR", "SSI", "day"}
    assert {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/metadata").collect()} == {"git": "abc", "day": "3"}
    day = datetime.date(1970, 1, 5)
    worse = table.where(F.to_date("epoch") != F.lit(day)).withColumn("SSI", F.when(F.to_date("epoch") == F.lit("1970-01-02").cast("date"), 9).otherwise(F.col("SSI")))
    found = fp.compare_with_frozen(worse, path).where("NOT same")
    assert {(str(r["day"]), r["variable"], r["n_after"] == 0) for r in found.collect()} == {("1970-01-02", "SSI", False), *(("1970-01-05", v, True) for v in ("SNR", "SSI", "day"))}
    rows = fp.frozen_days(spark, path, found)
    assert {str(r["d"]) for r in rows.select(F.to_date("epoch").alias("d")).distinct().collect()} == {"1970-01-02", "1970-01-05"} and rows.columns == table.columns
    assert fp.compare_with_frozen(worse, path, ["SNR"]).where("NOT same").count() == 1


def test_empty_and_null_times(spark):
    schema = "epoch timestamp_ntz, sid string, SNR double"
    none = spark.createDataFrame([], schema)
    assert fp.fingerprints(none).collect() == [] and fp.table_fingerprint(none).first()["n"] == 0
    odd = spark.createDataFrame([(None, None, None), (None, "a", 1.0)], schema)
    (r,) = fp.compare(fp.fingerprints(odd), fp.fingerprints(odd)).collect()
    assert (r["day"], r["n_before"], r["same"]) == (None, 2, True)
    assert [r["n_after"] for r in fp.compare(fp.fingerprints(odd), fp.fingerprints(none)).collect()] == [0]
