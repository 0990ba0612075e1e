import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafwave.operators import intervals as iv
from leafwave.operators.asof import nearest_asof
from leafwave.operators.ordered import running_sum, with_neighbours


def epochs(rng, n, days=20):
    s = np.sort(rng.choice(days * 24 * 60, size=n, replace=False))
    return pd.Timestamp("2024-01-01") + pd.to_timedelta(s, unit="min")


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    parts = [
        pd.DataFrame({"sid": sid, "epoch": epochs(rng, n), "v": rng.normal(size=n)})
        for sid, n in (("a", 400), ("b", 30), ("c", 1))
    ]
    pdf = pd.concat(parts, ignore_index=True)
    return pdf, to_ntz(spark.createDataFrame(pdf), "epoch").repartition(5)


def to_ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def test_neighbours_cross_blocks(series):
    pdf, df = series
    got = with_neighbours(df, ["sid"], "epoch", ["epoch", "v"], block_seconds=36000).toPandas()
    got = got.sort_values(["sid", "epoch"]).reset_index(drop=True)
    want = pdf.sort_values(["sid", "epoch"]).reset_index(drop=True)
    for name, step in (("prev", 1), ("next", -1)):
        pd.testing.assert_series_equal(
            got[f"{name}_v"], want.groupby("sid")["v"].shift(step), check_names=False
        )


def test_running_sum_crosses_blocks(series):
    pdf, df = series
    got = running_sum(df, ["sid"], "epoch", F.col("v"), "s", block_seconds=36000).toPandas()
    got = got.sort_values(["sid", "epoch"]).reset_index(drop=True)
    want = pdf.sort_values(["sid", "epoch"]).reset_index(drop=True).groupby("sid")["v"].cumsum()
    assert np.allclose(got["s"], want)


def test_nearest_asof_takes_later_on_ties(spark, series):
    pdf, df = series
    rng = np.random.default_rng(4)
    left = pd.concat(
        [pd.DataFrame({"sid": s, "epoch": epochs(rng, 200, 25)}) for s in ("a", "b", "c", "missing")], ignore_index=True
    )
    got = nearest_asof(to_ntz(spark.createDataFrame(left), "epoch"), df, ["sid"], ["v"], block_seconds=36000).toPandas()
    assert set(got["sid"]) == {"a", "b", "c"}
    assert len(got) == 600
    for _, r in got.iterrows():
        g = pdf[pdf["sid"] == r["sid"]]
        d = (g["epoch"] - r["epoch"]).abs()
        best = g[d == d.min()].sort_values("epoch").iloc[-1]
        assert best["epoch"] == r["epoch_matched"]
        assert best["v"] == r["v"]


@pytest.fixture(scope="module")
def spans(spark):
    rng = np.random.default_rng(5)
    n = 120
    start = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 2000, n), unit="min")
    pdf = pd.DataFrame(
        {"id": np.arange(n), "k": rng.choice(["x", "y"], n), "start": start,
         "end": start + pd.to_timedelta(rng.integers(0, 90, n), unit="min")}
    )
    # Identical intervals contain each other.
    pdf = pd.concat([pdf, pdf.head(2).assign(id=[900, 901])], ignore_index=True)
    return pdf, to_ntz(spark.createDataFrame(pdf), "start", "end")


def test_overlap_is_closed(spans):
    pdf, df = spans
    a, b = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    got = {r["id"] for r in iv.overlapping(a, b, ["k"], block_seconds=3600).collect()}
    pa, pb = pdf[pdf.id % 2 == 0], pdf[pdf.id % 2 == 1]
    want = {
        r.id for r in pa.itertuples()
        if any(s.k == r.k and s.start <= r.end and s.end >= r.start for s in pb.itertuples())
    }
    assert got == want


def test_containers(spans):
    pdf, df = spans
    got = {r["id"] for r in iv.containers(df, ["k"], block_seconds=3600).collect()}
    rows = list(pdf.itertuples())
    want = {
        i.id for i in rows
        if any(i.id != j.id and i.k == j.k and i.start <= j.start and i.end >= j.end for j in rows)
    }
    assert got == want and {0, 1, 900, 901} <= got


def test_overlap_pairs(spans):
    pdf, df = spans
    got = {(r["id_a"], r["id_b"]) for r in iv.overlap_pairs(df, "id", ["k"], bucket_seconds=1200).collect()}
    rows = list(pdf.itertuples())
    want = {
        (i.id, j.id) for i in rows for j in rows
        if i.id < j.id and i.k == j.k and i.start < j.end and j.start < i.end
    }
    assert got == want


def test_adjacent_files_do_not_overlap(spark):
    t = lambda h, m=0, s=0: pd.Timestamp(2025, 1, 1, h, m, s)
    a = to_ntz(spark.createDataFrame(pd.DataFrame({"start": [t(0, 15)], "end": [t(0, 29, 55)]})), "start", "end")
    b = to_ntz(spark.createDataFrame(pd.DataFrame({"start": [t(0)], "end": [t(0, 14, 55)]})), "start", "end")
    assert iv.overlapping(a, b).count() == 0


@pytest.mark.parametrize("block", [3600, 86400])
def test_merged_spans_are_the_union(spans, block):
    pdf, df = spans
    got = sorted((r["k"], r["start"], r["end"]) for r in iv.merged(df, ["k"], block_seconds=block).collect())
    want = []
    for k, g in pdf.sort_values("start").groupby("k"):
        for s, e in zip(g.start, g.end):
            if want and want[-1][0] == k and s <= want[-1][2]:
                want[-1][2] = max(want[-1][2], e)
            else:
                want.append([k, s, e])
    assert got == sorted(map(tuple, want)) and len(got) < len(pdf)


@pytest.mark.parametrize("limit", [iv.MAX_BROADCAST_SPANS, 1])
def test_points_inside_spans(spark, spans, monkeypatch, limit):
    monkeypatch.setattr(iv, "MAX_BROADCAST_SPANS", limit)
    pdf, df = spans
    rng = np.random.default_rng(8)
    times = np.concatenate([pdf.start.to_numpy(), pdf.end.to_numpy(), epochs(rng, 300, 2).to_numpy(), (pdf.end + pd.Timedelta("1us")).to_numpy()])
    pts = pd.DataFrame({"id": range(len(times)), "k": rng.choice(["x", "y", "z"], len(times)), "epoch": times})
    points = to_ntz(spark.createDataFrame(pts), "epoch")
    for keys in (["k"], []):
        want = {p.id for p in pts.itertuples() if any((not keys or s.k == p.k) and s.start <= p.epoch <= s.end for s in pdf.itertuples())}
        assert {r["id"] for r in iv.inside_any(points, df, keys, block_seconds=3600).collect()} == want
        assert {r["id"] for r in iv.inside_any(points, df, keys, invert=True, block_seconds=3600).collect()} == set(pts.id) - want
    assert iv.inside_any(points, df.limit(0), ["k"]).collect() == []


def test_points_are_not_shuffled_while_spans_are_few(spark, spans):
    _, df = spans
    points = df.select("id", "k", F.col("start").alias("epoch"))
    plan = iv.inside_any(points, df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "BroadcastHashJoin" in plan


def test_null_keys_are_a_key(spark):
    rows = [(None, f"2024-01-0{d} 00:00:00", float(d)) for d in (1, 2, 5)] + [("a", "2024-01-03 00:00:00", 3.0)]
    df = to_ntz(spark.createDataFrame(rows, "sid string, epoch string, v double"), "epoch")
    got = {r["v"]: (r["prev_v"], r["next_v"]) for r in with_neighbours(df, ["sid"], "epoch", ["v"]).collect()}
    assert got == {1.0: (None, 2.0), 2.0: (1.0, 5.0), 5.0: (2.0, None), 3.0: (None, None)}
    sums = {r["v"]: r["s"] for r in running_sum(df, ["sid"], "epoch", F.col("v"), "s").collect()}
    assert sums == {1.0: 1.0, 2.0: 3.0, 5.0: 8.0, 3.0: 3.0}
    right = df.withColumn("w", F.col("v"))
    near = {r["v"]: r["w"] for r in nearest_asof(df, right.where("v <> 2"), ["sid"], ["w"]).collect()}
    assert near == {1.0: 1.0, 2.0: 1.0, 5.0: 5.0, 3.0: 3.0}


def test_read_without_a_registry_keeps_first_rows(spark):
    from leafwave.operators.dedup import dedup_read

    rows = [("2024-01-01", "a", 2, 1.0), ("2024-01-01", "a", 1, 2.0), ("2024-01-01", "b", 9, 3.0)]
    df = to_ntz(spark.createDataFrame(rows, "epoch string, sid string, position int, v double"), "epoch")
    assert sorted(r["v"] for r in dedup_read(df, None).collect()) == [2.0, 3.0]
