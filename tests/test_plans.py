"""Shape of the plans of the heavier joins: few exchanges, inputs read once or twice."""

import os

import pytest

from leafwave.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", ["central_velocity", "hermite_interp", "clock_interp", "dedup_read", "overwrite_prepare"])
def test_interpolation_and_interval_plans_are_small(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") <= 15 and plan.count("Scan ") <= 3


def test_sliding_hampel_is_one_exchange(spark):
    plan = QUERIES["hampel_sliding_by_sid"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 2 and "Join" not in plan  # by (sid, block), and for the summary
