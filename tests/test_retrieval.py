import math
from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st

from leafwave.operators.retrieval import calculate_vod, register_calculator, tau_omega

SCHEMA = "epoch timestamp_ntz, sid string, SNR double, phi double, theta double"
T0 = datetime(2025, 1, 1)


def test_closed_form(spark):
    c = spark.createDataFrame([(T0, "G01|L1|C", 20.0, 1.0, math.pi / 4)], SCHEMA)
    r = spark.createDataFrame([(T0, "G01|L1|C", 10.0, 9.0, 9.0)], SCHEMA)
    row = tau_omega(c, r).first()
    assert row["VOD"] == pytest.approx(-math.log(10) * math.cos(math.pi / 4))
    assert (row["phi"], row["theta"]) == (1.0, math.pi / 4)


def test_alignment_kinds(spark):
    c = spark.createDataFrame([(T0, s, 20.0, 1.0, 0.5) for s in ("a", "b")], SCHEMA)
    r = spark.createDataFrame([(T0, s, 10.0, 1.0, 0.5) for s in ("b", "c")], SCHEMA)
    assert [x["sid"] for x in calculate_vod(c, r).collect()] == ["b"]
    left = {x["sid"]: x["VOD"] for x in calculate_vod(c, r, align=False).collect()}
    assert left["a"] is None and left["b"] is not None and set(left) == {"a", "b"}
    with pytest.raises(ValueError):
        calculate_vod(c.drop("SNR"), r)


def test_custom_calculator(spark):
    c = spark.createDataFrame([(T0, "a", 20.0, 1.0, 0.5)], SCHEMA)
    register_calculator("difference", lambda a, b, align=True: a.join(b.select("epoch", "sid"), ["epoch", "sid"]))
    assert calculate_vod(c, c, "difference").count() == 1


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.floats(-10, 60), st.floats(-10, 60), st.floats(0, math.pi / 2)), min_size=1, max_size=20
    )
)
def test_properties(spark, triples):
    c = spark.createDataFrame([(T0, str(i), a, 0.0, t) for i, (a, _, t) in enumerate(triples)], SCHEMA)
    r = spark.createDataFrame([(T0, str(i), b, 0.0, t) for i, (_, b, t) in enumerate(triples)], SCHEMA)
    for x in tau_omega(c, r).collect():
        a, b, t = triples[int(x["sid"])]
        assert math.isfinite(x["VOD"])
        assert x["VOD"] == pytest.approx(-(a - b) / 10 * math.log(10) * math.cos(t), abs=1e-9)
