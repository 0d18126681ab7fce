"""Plan properties the scale design relies on, checked on the executed plans
of the key queries (sf0.001): no cartesian product or nested-loop join, no
window frame that reaches to the end of its partition (Spark re-aggregates
those for every row), and no window over row data without partition keys."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
KEY_QUERIES = ["config_history", "ffill_bfill", "vehicle_scores", "stratified_split", "oversample",
               "knn_vote", "sort_nulls_last", "roc_points", "segmentation_flags", "unmatched_plates"]


@pytest.mark.parametrize("name", KEY_QUERIES)
def test_plan_has_no_unscalable_operators(spark, name):
    df = entry.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "unboundedfollowing" not in plan.lower()
    # a keyless window is only allowed over the bounded chunk summaries,
    # whose input is an aggregate keyed by the chunk
    for m in re.finditer(r"Window \[(.*)\], \[\], \[", plan):
        assert "_chunk" in m.group(1) or "_n0" in m.group(1), m.group(0)[:200]
