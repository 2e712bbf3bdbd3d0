"""Edge cases from FIXTURES.md section 3 on tiny inline tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fleetcast.functions import time as T
from fleetcast.operators import aggregate as AG
from fleetcast.operators import alerts as AL
from fleetcast.operators import series as SE

T0 = dt.datetime(2024, 1, 1, 0, 0)


def minutes(m):
    return T0 + dt.timedelta(minutes=m)


def test_interpolation_limit_and_trailing(spark):
    vals = [1.0] + [None] * 6 + [8.0] + [None] * 7
    rows = [("t", "d", "a", minutes(i), v) for i, v in enumerate(vals)]
    rows += [("t", "d", "b", minutes(0), 0.0), ("t", "d", "b", minutes(14), 0.0)]  # grid to minute 14
    df = spark.createDataFrame(rows, "tenant string, device_id string, s string, time timestamp, value double")
    out = {r["time"]: r["value"] for r in SE.interpolate_linear(df, ["s"]).where("s = 'a'").collect()}
    got = [out.get(minutes(i)) for i in range(15)]
    assert got == [1, 2, 3, 4, 5, 6, None, 8, 8, 8, 8, 8, 8, None, None]


def test_interpolation_leading_gap(spark):
    vals = [None, None, 3.0, None, 5.0]
    rows = [("t", "d", "a", minutes(i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "tenant string, device_id string, s string, time timestamp, value double")
    out = {r["time"]: r["value"] for r in SE.interpolate_linear(df, ["s"]).collect()}
    assert [out.get(minutes(i)) for i in range(5)] == [None, None, 3, 4, 5]


def test_rolling_five_minutes(spark):
    rows = [("t", "d", "a", minutes(m), float(v)) for m, v in zip([0, 1, 5, 6, 12], [1, 2, 3, 4, 5])]
    df = spark.createDataFrame(rows, "tenant string, device_id string, s string, time timestamp, value double")
    r = SE.rolling_stats(df, ["s"], windows=[5], stats=["mean", "std"]).orderBy("time").collect()
    assert [x["mean_5"] for x in r] == [1, 1.5, 2.5, 3.5, 5]
    std = [x["std_5"] for x in r]
    assert std[0] is None and std[4] is None
    assert all(abs(s - 0.7071067811865476) < 1e-9 for s in std[1:4])


@pytest.mark.parametrize("pairs,expected", [
    ([(1, 1), (1, 2), (1, 3)], None),
    ([(1, 1)], None),
    ([(1, 1), (3, 4), (4, 1)], 0.188982),  # (2, null) dropped before pairing
])
def test_guarded_correlation(spark, pairs, expected):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "x double, y double")
    r = df.agg(AG.pearson("x", "y").alias("r")).collect()[0]["r"]
    if expected is None:
        assert r is None
    else:
        assert math.isclose(r, expected, abs_tol=1e-6)


def test_calendar_and_align(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 16, 30),)], "ts timestamp")
    r = df.select(*T.calendar_columns("ts"), T.align_time("ts", 7).alias("a7")).collect()[0]
    assert (r["day_of_week"], r["is_weekend"], r["hour"]) == (0, 0, 10)
    assert r["a7"] == dt.datetime(2024, 1, 1, 10, 14)


def test_step_by_horizon(spark):
    df = spark.createDataFrame([(h,) for h in [1, 2, 24, 25, 500]], "h int")
    assert [r[0] for r in df.select(T.step_minutes("h")).collect()] == [5, 15, 30, 60, 60]
    assert [T.step_minutes_py(h) for h in [1, 2, 24, 25, 500]] == [5, 15, 30, 60, 60]


def test_threshold_crossing(spark):
    fc = spark.createDataFrame(
        [("t", "d", "cpu", minutes(30 * i), v) for i, v in enumerate([70.0, 80.0, 79.0])],
        "tenant string, device_id string, resource_type string, target_time timestamp, predicted_value double")
    lim = spark.createDataFrame([("cpu", 80.0)], "resource_type string, threshold double")
    r = AL.threshold_crossings(fc, lim).collect()
    assert len(r) == 1
    assert r[0]["crossing_time"] == minutes(30)
    assert r[0]["time_to_threshold"] == 0.5
    assert (r[0]["current_value"], r[0]["predicted_value"]) == (70.0, 80.0)


def test_superseded_keeps_ties(spark):
    from fleetcast.operators.joins import superseded_predictions
    rows = [("t", None, minutes(0), minutes(60), "cpu", 1.0), ("t", None, minutes(30), minutes(60), "cpu", 2.0),
            ("t", None, minutes(30), minutes(60), "cpu", 3.0)]
    df = spark.createDataFrame(rows, "tenant string, device_id string, prediction_time timestamp, "
                                     "target_time timestamp, resource_type string, predicted_value double")
    out = superseded_predictions(df, "2024-01-05 00:00:00").collect()
    assert [r["predicted_value"] for r in out] == [1.0]


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], "tenant string, device_id string, s string, time timestamp, value double")
    out = SE.interpolate_linear(df, ["s"])
    assert out.count() == 0
    assert out.columns == ["tenant", "device_id", "s", "time", "value"]


def test_align_step_not_dividing_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 56, 59),), (dt.datetime(2024, 1, 1, 11, 3, 0),)],
                               "ts timestamp")
    got = [r[0] for r in df.select(T.align_time("ts", 7)).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 56), dt.datetime(2024, 1, 1, 11, 0)]


def test_rolling_window_excludes_left_edge(spark):
    rows = [("t", "d", "a", minutes(0), 1.0), ("t", "d", "a", minutes(5), 3.0)]
    df = spark.createDataFrame(rows, "tenant string, device_id string, s string, time timestamp, value double")
    r = SE.rolling_stats(df, ["s"], windows=[5], stats=["mean", "max", "min"]).orderBy("time").collect()
    assert [(x["mean_5"], x["max_5"], x["min_5"]) for x in r] == [(1.0, 1.0, 1.0), (3.0, 3.0, 3.0)]


def test_one_row_series(spark):
    rows = [("t", "d", "a", minutes(3), 7.0)]
    df = spark.createDataFrame(rows, "tenant string, device_id string, s string, time timestamp, value double")
    assert [r["value"] for r in SE.interpolate_linear(df, ["s"]).collect()] == [7.0]
    r = SE.rolling_stats(df, ["s"], windows=[5], stats=["mean", "std"]).collect()[0]
    assert r["mean_5"] == 7.0 and r["std_5"] is None


def test_impact_score_skips_undefined_correlations(spark):
    # one constant metric (r undefined) and one moving metric: the score is |r| of the moving one only
    app = [("t", "d", minutes(i), "app", m, v) for i in range(6)
           for m, v in (("flat", 5.0), ("up", float(i)))]
    res = [("t", "d", minutes(i), "cpu", float(2 * i)) for i in range(6)]
    a = spark.createDataFrame(app, "tenant string, device_id string, time timestamp, application string, "
                                   "metric_type string, value double")
    r = spark.createDataFrame(res, "tenant string, device_id string, time timestamp, resource_type string, "
                                   "value double")
    out = AG.impact_scores(a, r).collect()
    assert len(out) == 1 and out[0]["n_metrics"] == 1 and abs(out[0]["impact_score"] - 1.0) < 1e-12


def test_new_entities_and_cooldown(spark):
    from fleetcast.sources.tables import new_entities
    disc = spark.createDataFrame([("t-0", "dev-0"), ("t-0", "dev-2"), ("t-9", "dev-9")], "tenant string, device_id string")
    reg = spark.createDataFrame([("t-0", "dev-0")], "tenant string, device_id string")
    got = sorted((r["tenant"], r["device_id"], r["new_tenant"]) for r in new_entities(disc, reg).collect())
    assert got == [("t-0", "dev-2", False), ("t-9", "dev-9", True)]
    al = spark.createDataFrame([("t", "d", "cpu", minutes(m)) for m in (0, 30, 100, 159)],
                               "tenant string, device_id string, resource_type string, crossing_time timestamp")
    sup = [r["suppressed"] for r in SE.alert_cooldown(al, 60).orderBy("crossing_time").collect()]
    assert sup == [False, True, False, True]


def test_nearest_asof_against_brute_force(spark):
    from fleetcast.operators.joins import nearest_asof
    left = [("t", "d", minutes(m)) for m in (0, 3, 7, 10, 20)]
    right = [("t", "d", T0 + dt.timedelta(seconds=s), float(s)) for s in (50, 170, 190, 540, 545, 1300)]
    L = spark.createDataFrame(left, "tenant string, device_id string, time timestamp")
    R = spark.createDataFrame(right, "tenant string, device_id string, time timestamp, value double")
    got = {r["time"]: r["matched_value"] for r in nearest_asof(L, R, ["tenant", "device_id"], 2).collect()}
    for _, _, t in left:
        cands = [(abs((rt - t).total_seconds()), -rt.timestamp(), v) for _, _, rt, v in right
                 if abs((rt - t).total_seconds()) <= 120]
        assert got[t] == (min(cands)[2] if cands else None)
