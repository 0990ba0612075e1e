"""Sliding medians against sorting every window."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from leafwave.operators import sliding
from leafwave.operators.hampel import MAD_SCALE, sliding_hampel


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(-4, 4)), min_size=1, max_size=60), st.integers(0, 20))
def test_window_equals_sorting_it(rows, half):
    rows.sort(key=lambda r: r[0])
    t, v = [r[0] for r in rows], [r[1] / 3 for r in rows]
    got = list(sliding.window_stats(t, v, [True] * len(t), half))
    for i, (median, mad, n) in enumerate(got):
        near = np.array([x for s, x in zip(t, v) if abs(s - t[i]) <= half])
        assert n == len(near) and median == np.median(near) and mad == np.median(np.abs(near - np.median(near)))


@pytest.mark.parametrize("load", [2, 512])
def test_sorted_blocks(monkeypatch, load):
    monkeypatch.setattr(sliding, "LOAD", load)
    rng = np.random.default_rng(load)
    held, plain = sliding.SortedBlocks(), []
    for step in range(4000):
        if plain and rng.random() < 0.45:
            x = plain.pop(int(rng.integers(len(plain))))
            held.remove(x)
        else:
            x = float(rng.integers(30)) if step % 2 else float(rng.normal())
            plain.append(x)
            held.add(x)
        if plain and step % 7 == 0:
            ordered = sorted(plain)
            i = int(rng.integers(len(plain)))
            m = float(np.median(ordered))
            assert held[i] == ordered[i] and held.size == len(ordered) and held.median() == m
            gaps = sorted(abs(x - m) for x in ordered)
            assert held.deviation(i, m) == pytest.approx(gaps[i], abs=1e-15) and held.mad(m) == pytest.approx(np.median(gaps), abs=1e-15)


def brute(pdf, keys, half, sigma, least):
    out = []
    for _, g in pdf.groupby(keys):
        g = g.dropna(subset=["v"])
        t, v = g.epoch.to_numpy(), g.v.to_numpy()
        for i, row in zip(g.id, range(len(g))):
            near = v[np.abs(t - t[row]) <= half]
            m = np.median(near)
            dev = np.median(np.abs(near - m))
            out.append((i, m, dev, len(near), bool(len(near) >= least and dev > 0 and abs(v[row] - m) > dev * MAD_SCALE * sigma)))
    return sorted(out)


@pytest.mark.parametrize("hours", [0.5, 3.0, 40.0])
def test_sliding_hampel_over_blocks_and_a_hot_key(spark, hours):
    rng = np.random.default_rng(11)
    n = 1500
    start = pd.Timestamp("2024-01-01")
    pdf = pd.DataFrame({
        "id": np.arange(n), "k": np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdef"), n)), "cell": rng.integers(0, 3, n),
        "epoch": start + pd.to_timedelta(rng.integers(0, 10 * 24 * 60, n), unit="min"), "v": np.round(rng.normal(size=n), 1), "note": "x",
    })
    pdf.loc[rng.random(n) < 0.05, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("epoch", F.col("epoch").cast("timestamp_ntz"))
    df = df.withColumn("v", F.when(F.col("id") % 2 == 0, F.nanvl("v", F.lit(None))).otherwise(F.col("v"))).repartition(6)
    got = sliding_hampel(df, hours, 2.0, 5, "v", keys=("k", "cell"), block_hours=max(1.0, hours), keep_window_stats=True).toPandas()
    assert len(got) == n and (got.note == "x").all()
    done = got.dropna(subset=["v"])
    have = sorted(zip(done.id, done.window_median, done.window_mad, done.window_n, done.hampel_outlier_mask))
    assert have == brute(pdf, ["k", "cell"], np.timedelta64(int(hours * 60), "m"), 2.0, 5)
    assert not got[got.v.isna()].hampel_processing_mask.any()
    assert (done.hampel_processing_mask == (done.window_n >= 5)).all()


def test_null_keys_and_empty_input(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0), (None, "2024-01-01 00:00:00", 9.0), ("a", "2024-01-01 00:10:00", None)]
    df = spark.createDataFrame(rows, "k string, epoch string, v double").withColumn("epoch", F.col("epoch").cast("timestamp_ntz"))
    got = sliding_hampel(df, 1.0, 3.0, 1, "v", keys=("k",))
    assert got.columns == ["k", "epoch", "v", "hampel_outlier_mask", "hampel_processing_mask", "v_filtered"]
    assert sorted((str(r["k"]), r["hampel_processing_mask"]) for r in got.collect()) == [("None", False), ("a", False), ("a", True)]
    assert sliding_hampel(df.limit(0), keys=("k",), var="v").collect() == []


def test_one_exchange_and_no_join(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1.0)], "k string, epoch string, v double").withColumn("epoch", F.col("epoch").cast("timestamp_ntz"))
    plan = sliding_hampel(df, keys=("k",), var="v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "Join" not in plan
