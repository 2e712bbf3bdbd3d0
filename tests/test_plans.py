"""Shuffles and scans of the plans that used to repeat scores over minutes: counted, so that they stay."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
#: query -> (most exchanges by key that are not reused, most scans of the events)
LIMITS = {"a5_impact_scores": (7, 3), "a6_impact_stats": (9, 3), "m1_app_training_set": (28, 5), "m2_system_training_set": (28, 6)}


@pytest.mark.parametrize("name", LIMITS)
def test_exchanges_and_scans(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges, scans = len(re.findall(r"Exchange hashpartitioning", plan)), len(re.findall(r"FileScan parquet", plan))
    assert exchanges <= LIMITS[name][0] and scans <= LIMITS[name][1]
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
