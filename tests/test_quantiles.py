import numpy as np
import pandas as pd
import pytest

from leafwave.operators.quantiles import group_quantiles, median_and_mad

PROBS = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    # One key holds most rows, one has many ties, one is tiny.
    key = np.array(["hot"] * 4000 + ["ties"] * 900 + ["small"] * 3)
    value = np.concatenate([rng.normal(size=4000), rng.integers(0, 5, 900).astype(float), [1.0, 2.0, 4.0]])
    pdf = pd.DataFrame({"k": key, "v": value})
    return pdf, spark.createDataFrame(pdf).repartition(7)


@pytest.mark.parametrize("hot_rows,slices", [(10**9, 1024), (500, 64), (500, 1024), (1, 32)])
def test_exact_for_hot_and_cold_groups(data, hot_rows, slices):
    pdf, df = data
    got = {r["k"]: r["q"] for r in group_quantiles(df, ["k"], "v", PROBS, hot_rows=hot_rows, slices=slices).collect()}
    for k, g in pdf.groupby("k"):
        assert got[k] == pytest.approx(list(np.quantile(g["v"], PROBS)), abs=1e-12)


def test_whole_table_quantiles(data):
    pdf, df = data
    q = group_quantiles(df, [], "v", [0.25, 0.75], hot_rows=100, slices=64).first()["q"]
    assert q == pytest.approx(list(np.quantile(pdf["v"], [0.25, 0.75])), abs=1e-12)


@pytest.mark.parametrize("hot_rows", [10**9, 500])
def test_median_and_mad(data, hot_rows):
    pdf, df = data
    got = {r["k"]: r for r in median_and_mad(df, ["k"], "v", hot_rows=hot_rows).collect()}
    for k, g in pdf.groupby("k"):
        med = np.median(g["v"])
        assert got[k]["median"] == pytest.approx(med, abs=1e-12)
        assert got[k]["mad"] == pytest.approx(np.median(np.abs(g["v"] - med)), abs=1e-12)
        assert got[k]["n_obs"] == len(g)


@pytest.mark.parametrize("hot_rows", [10**9, 500])
def test_medians_of_several_columns(spark, hot_rows):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"k": ["h"] * 2000 + ["c"] * 21 + ["e"] * 2, "a": rng.normal(size=2023), "b": rng.normal(size=2023)})
    pdf.loc[pdf.k == "e", "b"] = np.nan
    from leafwave.operators.quantiles import group_medians
    from leafwave.schema import nan_to_null

    df = nan_to_null(spark.createDataFrame(pdf))
    got = group_medians(df, ["k"], ["a", "b"], hot_rows=hot_rows).toPandas().set_index("k")
    want = pdf.groupby("k")[["a", "b"]].median()
    for c in ("a", "b"):
        assert np.allclose(got[c].loc[want.index].astype(float), want[c], equal_nan=True)


def test_sketch_quantiles_keep_their_rank_error(data):
    from leafwave.operators.quality import distribution_summary

    pdf, df = data
    probs = (0.05, 0.25, 0.5, 0.75, 0.95)
    for r in distribution_summary(df, "v", ["k"], probs, epsilon=0.01).collect():
        values = np.sort(pdf[pdf.k == r["k"]]["v"].to_numpy())
        assert r["n"] == len(values)
        for p, q in zip(probs, r["quantiles"]):
            low, high = np.searchsorted(values, q, "left"), np.searchsorted(values, q, "right")
            rank = p * len(values)
            slack = 0.01 * len(values) + 1
            assert low - slack <= rank <= high + slack


def test_hot_whole_table_is_counted_by_value_once(spark):
    pdf = pd.DataFrame({"v": [float(i % 7) for i in range(3000)] + [100.0]})
    out = group_quantiles(spark.createDataFrame(pdf), [], "v", [0.05, 0.25, 0.5, 1.0], hot_rows=100, slices=64)
    assert out.first()["q"] == pytest.approx(list(np.quantile(pdf["v"], [0.05, 0.25, 0.5, 1.0])), abs=1e-12)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "rightHint=(strategy=broadcast)" in plan
