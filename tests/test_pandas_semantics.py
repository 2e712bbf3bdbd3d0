"""Cross-checks against the frame-library semantics the operators re-create.

Small fixture (sf0.01 minute metrics, pulled to pandas only inside the test):
pivot + ``resample('1min').mean().interpolate(limit=5)`` for W3/W4, time-based
``rolling('5min', min_periods=1)`` on complete rows for W1, and
``resample('5min').last().dropna()`` for W2/A11.
"""

import math

import pandas as pd
import pytest

from fleetcast.operators.clean import complete_rows
from fleetcast.operators.features import rolling_features
from fleetcast.operators.series import interpolate_linear, rolling_stats
from fleetcast.plans.registry import _app

SF = "/root/testdata/sf0.01"
K = ["tenant", "device_id"]


@pytest.fixture(scope="module")
def app_pd(spark):
    return _app(spark, SF).toPandas()


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and not math.isnan(b) and abs(a - b) <= 1e-9 * max(1.0, abs(a))


def test_interpolation_matches_resample_interpolate(spark, app_pd):
    exp = {}
    for (t, d), g in app_pd.groupby(K):
        wide = g.pivot_table(index="time", columns=["application", "metric_type"], values="value", aggfunc="mean")
        filled = wide.resample("1min").mean().interpolate(method="linear", limit=5)
        for (a, m), s in filled.items():
            for ts, v in s.dropna().items():
                exp[(t, d, a, m, ts)] = v
    got = {(r["tenant"], r["device_id"], r["application"], r["metric_type"], pd.Timestamp(r["time"])): r["value"]
           for r in interpolate_linear(_app(spark, SF), ["application", "metric_type"]).collect()}
    assert set(got) == set(exp)
    assert all(_close(exp[k], got[k]) for k in exp)


def test_rolling_matches_time_rolling(spark, app_pd):
    exp = {}
    for (t, d, a), g in app_pd.groupby([*K, "application"]):
        wide = g.pivot_table(index="time", columns="metric_type", values="value", aggfunc="mean")
        wide = wide.reindex(columns=sorted(g["metric_type"].unique())).dropna()
        if wide.empty:
            continue
        r = wide.rolling("15min", min_periods=1)
        for stat, frame in (("mean", r.mean()), ("std", r.std()), ("max", r.max()), ("min", r.min())):
            for m, s in frame.items():
                for ts, v in s.items():
                    exp[(t, d, a, m, ts, stat)] = v
    full = complete_rows(_app(spark, SF), [*K, "application"], "metric_type")
    rows = rolling_stats(full, ["application", "metric_type"], windows=[15]).collect()
    got = {}
    for r in rows:
        for stat in ("mean", "std", "max", "min"):
            got[(r["tenant"], r["device_id"], r["application"], r["metric_type"], pd.Timestamp(r["time"]), stat)] = \
                r[f"{stat}_15"]
    assert set(got) == set(exp) and len(exp) > 0
    assert all(_close(exp[k], got[k]) for k in exp)


def test_rolling_features_match_resample_last(spark, app_pd):
    exp = {}
    for (t, d, a), g in app_pd.groupby([*K, "application"]):
        wide = g.pivot_table(index="time", columns="metric_type", values="value", aggfunc="mean")
        wide = wide.reindex(columns=sorted(g["metric_type"].unique())).dropna()
        if wide.empty:
            continue
        for w in (5, 60):
            r = wide.rolling(f"{w}min", min_periods=1)
            for stat, frame in (("mean", r.mean()), ("std", r.std())):
                last = frame.resample("5min").last().dropna()
                for m, s in last.items():
                    for ts, v in s.items():
                        exp[(t, d, a, f"{m}_{stat}_{w}min", ts)] = v
    rows = rolling_features(_app(spark, SF), windows=[5, 60], stats=["mean", "std"]).collect()
    got = {(r["tenant"], r["device_id"], r["application"], r["feature_name"], pd.Timestamp(r["time"])): r["value"]
           for r in rows}
    assert set(got) == set(exp) and len(exp) > 0
    assert all(_close(exp[k], got[k]) for k in exp)
