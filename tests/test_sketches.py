"""Kept statistics: merged days tell what all rows tell, within the sketch's error."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafwave.operators import sketches as sk


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 20_000
    pdf = pd.DataFrame({
        "epoch": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 20 * 1440, n), unit="min"), "receiver": np.where(rng.random(n) < 0.7, "hot", "cold"),
        "SNR": np.round(rng.gamma(3, 10, n), 2), "VOD": np.where(rng.random(n) < 0.5, 1.0, rng.normal(size=n)),
    })
    pdf.loc[rng.random(n) < 0.1, "SNR"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("epoch", F.col("epoch").cast("timestamp_ntz"))
    return pdf, df.withColumn("VOD", F.when(F.col("VOD") < 2, F.col("VOD")))


def within(values, probs, got, tolerance):
    values = np.sort(values)
    lo, hi = np.searchsorted(values, got, "left") / len(values), np.searchsorted(values, got, "right") / len(values)
    return ((lo - tolerance <= probs) & (probs <= hi + tolerance)).all()


def test_merged_and_direct_sketches_are_within_their_error(table):
    pdf, df = table
    days = sk.day_sketches(df, ["SNR", "VOD"], ["receiver"])
    for rows, key in ((sk.merged(days, ["receiver"]), "receiver"), (sk.merged(days), None)):
        for r in sk.summary(rows).collect():
            part = pdf if key is None else pdf[pdf.receiver == r["receiver"]]
            x = part[r["variable"]].dropna()
            x = x[x < 2] if r["variable"] == "VOD" else x
            assert (r["n"], r["n_missing"]) == (len(x), len(part) - len(x)) and (r["min"], r["max"]) == (x.min(), x.max())
            assert r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std(ddof=0))
            assert within(x.to_numpy(), np.array(sk.PROBS), np.array(r["quantiles"]), 2 * sk.EPSILON)


def test_days_replace_themselves_only(spark, table, tmp_path):
    _, df = table
    path = str(tmp_path / "kept")
    early, late = df.where("epoch < timestamp_ntz'2024-01-11'"), df.where("epoch >= timestamp_ntz'2024-01-09'")
    for part in (early, late, late):
        whole = part if part is early else df.join(late.select(F.to_date("epoch").alias("d")).distinct(), F.to_date("epoch") == F.col("d"), "left_semi")
        sk.save(sk.day_sketches(whole, ["SNR"], ["receiver"]), path)
    kept = sk.load(spark, path)
    assert sk.merged(kept).first()["n"] == df.where("SNR IS NOT NULL AND NOT isnan(SNR)").count() and kept.select("day").distinct().count() == 20
    some = sk.load(spark, path, "2024-01-05", "2024-01-06")
    assert sk.merged(some).first()["n"] == df.where("to_date(epoch) IN ('2024-01-05', '2024-01-06') AND SNR IS NOT NULL AND NOT isnan(SNR)").count()


def test_histograms_add_up(table):
    pdf, df = table
    days = sk.day_histograms(df, "SNR", 10.0, 60.0, 25, ["receiver"])
    got = {r["bin"]: r["n"] for r in days.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    x = pdf.SNR.dropna()
    want, _ = np.histogram(x, bins=25, range=(10.0, 60.0))
    assert [got.get(i, 0) for i in range(25)] == pytest.approx(want, abs=3)  # edges may round either way
    assert got[-1] == (x < 10).sum() and got[25] == (x > 60).sum() and sum(got.values()) == len(x)


def test_empty_and_missing(spark):
    schema = "epoch timestamp_ntz, SNR double"
    assert sk.summary(sk.merged(sk.day_sketches(spark.createDataFrame([], schema)))).collect() == []
    (r,) = sk.summary(sk.merged(sk.day_sketches(spark.createDataFrame([(None, None), (None, float("nan"))], schema)))).collect()
    assert (r["n"], r["n_missing"], r["mean"], r["quantiles"]) == (0, 2, None, None)


def test_size_follows_the_error():
    assert sk.sketch_size(0.0133) == pytest.approx(252, abs=60) and sk.sketch_size(0.001) > 3000 and sk.sketch_size(1e-9) == 65_535
