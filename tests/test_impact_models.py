"""Per-key impact models and raw training sets: planted signals, closed forms, folds, planted gaps."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetcast.operators import aggregate as AG
from fleetcast.operators import gram
from fleetcast.operators import models as MD
from fleetcast.operators.series import ts_folds

T0 = dt.datetime(2024, 1, 1)
K = ["tenant", "device_id"]
NAMES = ["load", "noise", "flat"]


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def planted(n=120, slopes=(2.0, -5.0)):
    """Tall M1 rows of two devices: cpu follows the load with another slope on each, mem follows nothing, disk is constant."""
    rng = np.random.default_rng(3)
    rows, wide = [], {}
    for d, slope in zip(("d0", "d1"), slopes):
        load, noise = rng.normal(1e6, 3.0, n), rng.normal(size=n)
        labels = {"cpu": slope * load + 7.0 + 0.01 * rng.normal(size=n), "mem": rng.normal(size=n), "disk": np.full(n, 0.25)}
        wide[d] = np.column_stack([load, noise, np.full(n, 4.0)]), labels
        for r, y in labels.items():
            for i in range(n):
                rows += [("t", d, "app", at(5 * i), f, float(v), r, float(y[i])) for f, v in zip(NAMES, (load[i], noise[i], 4.0))]
    return rows, wide


TALL = "tenant string, device_id string, application string, time timestamp, feature_name string, value double, resource_type string, label double"


@pytest.fixture(scope="module")
def train(spark):
    rows, wide = planted()
    return spark.createDataFrame(rows, TALL), wide


@pytest.mark.parametrize("chunk", [gram.WEEK_US, 3_600_000_000])
def test_models_per_key_are_least_squares(spark, train, chunk):
    """Whatever the chunks, a small penalty gives numpy's least squares, though the load's mean is a million times its deviation."""
    df, wide = train
    rows = MD.impact_rows(df, NAMES).withColumn("block", F.lit(0))
    got = gram.fit_per_key(rows, MD.IMPACT_KEYS, NAMES, penalty=1e-12, chunk_us=chunk).collect()
    assert {(r["device_id"], r["resource_type"], r["fold"]) for r in got} == {(d, r, -1) for d in wide for r in ("cpu", "mem", "disk")}
    for r in got:
        x, labels = wide[r["device_id"]]
        y = labels[r["resource_type"]]
        centered = x[:, :2] - x[:, :2].mean(axis=0)
        beta = np.linalg.lstsq(centered, y - y.mean(), rcond=None)[0]
        assert r["n_rows"] == 120 and r["coef"][2] == 0.0
        assert r["label_std"] == pytest.approx(y.std(), abs=1e-9)
        assert r["coef"][:2] == pytest.approx(list(beta) if r["resource_type"] != "disk" else [0.0, 0.0], rel=1e-5, abs=1e-7)
        assert sum(r["importance"]) == pytest.approx(0.0 if r["resource_type"] == "disk" else 1.0)


def test_folds_are_those_of_w12(spark):
    """Block f + 1 holds the test rows of fold f, the blocks before it the training rows."""
    rows = [("t", "d", a, at(i)) for a, n in (("big", 47), ("even", 12), ("few", 4), ("six", 6)) for i in range(n)]
    df = spark.createDataFrame(rows, "tenant string, device_id string, application string, time timestamp")
    keys = [*K, "application"]
    blocks = {(r["application"], r["time"]): r["block"] for r in gram.time_blocks(df, keys, "time", 5).collect()}
    folds = {}
    for r in ts_folds(df, keys, "time", 5).collect():
        folds.setdefault((r["application"], r["fold"], r["role"]), set()).add(r["time"])
    for (app, fold, role), times in folds.items():
        expected = {t for (a, t), b in blocks.items() if a == app and (b == fold + 1 if role == "test" else b <= fold)}
        assert times == expected
    assert {b for (a, _), b in blocks.items() if a == "few"} == {0}


def test_impact_models_find_a_planted_signal(spark, train, tmp_path):
    df, wide = train
    fm = MD.fit_impact_models(df, NAMES)
    met = {(r["device_id"], r["resource_type"]): r for r in fm.metrics.collect()}
    for d in wide:
        assert met[d, "cpu"]["mae"] < 0.05 * met[d, "cpu"]["mean_mae"] and met[d, "cpu"]["r2"] > 0.9 and met[d, "cpu"]["folds"] == 5
        assert met[d, "cpu"]["label_std"] > 1.0 and met[d, "mem"]["mae"] > 0.8 * met[d, "mem"]["mean_mae"]
        assert met[d, "disk"]["mae"] == pytest.approx(0.0, abs=1e-9) and met[d, "disk"]["r2"] is None
        shares = json.loads(met[d, "cpu"]["feature_importance"])
        assert max(shares, key=shares.get) == "load" and set(shares) == set(NAMES)
    # a key's own slope, the default for one never trained, and the same after saving
    profile = spark.createDataFrame([("t", "d0", "app", 1e6 + 1, 0.0, 4.0), ("t", "d1", "app", 1e6 + 1, 0.0, 4.0), ("t", "d9", "app", 1.0, 1.0, 1.0)],
                                    "tenant string, device_id string, application string, load double, noise double, flat double")
    got = {(r["device_id"], r["resource_type"]): r["impact_score"] for r in MD.predict_impacts(fm, profile, T0).collect()}
    assert got["d0", "cpu"] == pytest.approx(2e6 + 9, abs=0.5) and got["d1", "cpu"] == pytest.approx(-5e6 + 2, abs=0.5)
    assert {got["d9", r] for r in ("cpu", "mem", "disk")} == {0.5}
    MD.save_models(fm, str(tmp_path), "t", "d0")
    again, where = MD.load_models(spark, str(tmp_path), "impact", "t", "d0")
    assert where.endswith("t/d0") and again.kind == "ridge"
    assert {(r["device_id"], r["resource_type"]): r["impact_score"] for r in MD.predict_impacts(again, profile, T0).collect()} == got


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosting"])
def test_fleet_models_use_the_impact_keys(spark, kind, monkeypatch):
    """What the keys have in common is a signal in units of each.  Either estimator learns in units of (entity, application, resource) and says 0.5 for a key without a model."""
    monkeypatch.setitem(MD.FOREST, "numTrees", 10)
    monkeypatch.setitem(MD.BOOSTING, "maxIter", 15)
    df = spark.createDataFrame(planted(slopes=(2.0, 50.0))[0], TALL)
    fm = MD.fit_impact_models(df, NAMES, kind, cv_splits=1)
    assert fm.stats.columns[:4] == MD.IMPACT_KEYS and fm.stats.count() == 6
    rows = MD.score(fm, MD.impact_rows(df, NAMES)).where("resource_type = 'cpu'")
    for r in rows.groupBy("device_id").agg(F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("mae"), F.stddev_pop("label").alias("sd")).collect():
        assert r["mae"] < 0.6 * r["sd"]
    profile = spark.createDataFrame([("t", "d9", "app", 1.0, 1.0, 1.0)], "tenant string, device_id string, application string, load double, noise double, flat double")
    assert {r["impact_score"] for r in MD.predict_impacts(fm, profile, T0).collect()} == {0.5}


def test_no_rows_and_null_labels(spark, train):
    df, _ = train
    for kind in ("ridge", "random_forest"):
        fm = MD.fit_impact_models(df.where("false"), NAMES, kind)
        assert fm.metrics.count() == 0 and {"label_std", "mean_mae", "folds", "feature_importance"} <= set(fm.metrics.columns)
        profile = spark.createDataFrame([("t", "d9", "app", 1.0, 1.0, 1.0)], "tenant string, device_id string, application string, load double, noise double, flat double")
        assert {r["impact_score"] for r in MD.predict_impacts(fm, profile, T0).collect()} == {0.5}
    rows = MD.impact_rows(df, NAMES).withColumn("block", F.lit(0)).withColumn("label", F.when(F.col("resource_type") == "cpu", F.col("label")))
    assert {r["resource_type"] for r in gram.fit_per_key(rows, MD.IMPACT_KEYS, NAMES).collect()} == {"cpu"}


def test_raw_training_set_imputes_by_type(spark):
    """A metric gap takes the mean of the application's times, a label gap the mean label weighted by minutes, the calendar is whole."""
    app = [("t", "d", "a", at(m), "x", float(m)) for m in range(0, 130) if m != 7] + [("t", "d", "a", at(m), "y", 1.0) for m in range(0, 60)]
    app += [("t", "d", "b", at(m), "x", 1.0) for m in range(5)]  # too few times
    scores = [("t", "d", at(0), "a", "cpu", 0.2), ("t", "d", at(60), "a", "cpu", 0.8), ("t", "d", at(60), "a", "mem", 0.4), ("t", "d", at(0), "b", "cpu", 0.3)]
    df = spark.createDataFrame(app, "tenant string, device_id string, application string, time timestamp, metric_type string, value double")
    sc = spark.createDataFrame(scores, "tenant string, device_id string, period timestamp, application string, resource_type string, impact_score double")
    common = spark.createDataFrame([("t", "d", at(0), at(119))], "tenant string, device_id string, common_start timestamp, common_end timestamp")
    rows = MD.raw_training_set(df, sc, common, period="1 hour").collect()
    got = {(r["time"], r["feature_name"], r["resource_type"]): r for r in rows}
    assert {r["application"] for r in rows} == {"a"} and len(rows) == len(got) == 120 * 5 * 2
    y_mean, x_mean = 1.0, np.mean([m for m in range(120) if m != 7])
    r = got[at(7), "x", "cpu"]
    assert r["imputed"] and r["value"] == pytest.approx(x_mean) and r["label"] == 0.2 and not r["label_imputed"]
    assert got[at(100), "y", "mem"]["value"] == y_mean and got[at(100), "y", "mem"]["imputed"] and got[at(100), "y", "mem"]["label"] == 0.4
    assert got[at(3), "x", "mem"]["label_imputed"] and got[at(3), "x", "mem"]["label"] == pytest.approx(0.4)
    assert got[at(61), "hour", "cpu"]["value"] == 1.0 and got[at(61), "is_weekend", "cpu"]["value"] == 0.0 and not got[at(61), "hour", "cpu"]["imputed"]


def test_run_metadata_counts_every_entity(spark):
    impacts = spark.createDataFrame([("t", "d", "a"), ("t", "d", "a"), ("t", "d", "b"), ("t", "e", "a")], "tenant string, device_id string, application string")
    features = spark.createDataFrame([("t", "d"), ("t", "f")], "tenant string, device_id string")
    rows = {r["device_id"]: r for r in MD.run_metadata_rows(impacts, features, "k1", T0).collect()}
    counts = {d: json.loads(r["feature_importance"]) for d, r in rows.items()}
    assert {d: (c["impact_records"], c["feature_records"], c["applications"]) for d, c in counts.items()} == {"d": (3, 1, 2), "e": (1, 0, 1), "f": (0, 1, 0)}
    assert rows["d"]["version"] == "streaming_k1_20240101000000" and rows["d"]["mae"] == 0.0 and counts["d"]["training_method"] == "streaming_cache"


def test_profile_calendar_is_of_the_applications_newest_time(spark):
    rows = [("t", "d", "a", at(58), "x", 1.0), ("t", "d", "a", at(61), "y", 2.0), ("t", "d", "b", at(59), "x", 3.0)]
    df = spark.createDataFrame(rows, "tenant string, device_id string, application string, time timestamp, metric_type string, value double")
    got = {(r["application"], r["metric_type"]): (r["hour"], r["day_of_week"], r["is_weekend"]) for r in AG.latest_profile(df, at(70), 30).collect()}
    assert got == {("a", "x"): (1, 0, 0), ("a", "y"): (1, 0, 0), ("b", "x"): (0, 0, 0)}
