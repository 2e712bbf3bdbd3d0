"""Model fits: a planted signal, defaults for untrained keys, save and load, alignment rules."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
# the training-data queries have tests of their own
MODEL_QUERIES = sorted(n for n in set(E.queries()) - set(E.oracle_sql()) if not n.startswith(("op", "pipeline")))


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    assert len(rows) > 0
    assert len(df.columns) >= 3


def test_fit_finds_a_planted_signal_and_defaults_stand_in(spark, tmp_path):
    from fleetcast.operators import models as MD
    from fleetcast.operators.aggregate import STAT_COLUMNS
    rows = [("t", f"d{d}", f"2024-01-01 {h:02d}:{m:02d}:00", *[float(10 * d + h)] * 12, float(h), 0.0, 0.0, 30.0 * d + 2 * h, 50.0 + h, None)
            for d in range(3) for h in range(20) for m in range(0, 60, 10)]
    cols = ["tenant string", "device_id string", "time string"] + [f"{c} double" for c in STAT_COLUMNS] + [
        f"{c} double" for c in ("hour", "day_of_week", "is_weekend", "cpu", "mem", "disk")]
    train = spark.createDataFrame(rows, ", ".join(cols)).withColumn("time", F.col("time").cast("timestamp"))
    fm = MD.fit_system_models(train)
    met = {(r.device_id, r.resource_type): r for r in fm.metrics.collect()}
    assert set(met) == {(f"d{d}", r) for d in range(3) for r in ("cpu", "mem")}
    assert all(r.mae < 0.6 * r.mean_mae for r in met.values())
    seen = train.limit(1).select("tenant", "device_id", *STAT_COLUMNS)
    stats = seen.unionByName(seen.withColumn("device_id", F.lit("never")))
    grid = stats.select("tenant", "device_id", F.lit(0).alias("step_index"), F.lit("2024-01-02 05:00:00").cast("timestamp").alias("target_time"))
    got = {(r.device_id, r.resource_type): r.predicted_value for r in MD.forecast(fm, stats, grid).collect()}
    device = seen.first().device_id
    assert got["never", "cpu"] == 50.0 and got[device, "disk"] == 50.0 and got[device, "cpu"] != 50.0
    MD.save_models(fm, str(tmp_path), "t", device)
    again, at = MD.load_models(spark, str(tmp_path), fm.purpose, "t", device)
    assert at.endswith(f"t/{device}") and again.features == fm.features
    assert {(r.device_id, r.resource_type): r.predicted_value for r in MD.forecast(again, stats, grid).collect()} == got
    none, at = MD.load_models(spark, str(tmp_path), fm.purpose, "other", device)
    assert at is None and none.model is None
    assert {r.predicted_value for r in MD.forecast(none, stats, grid).collect()} == {50.0}


def test_alignment_rules():
    import datetime as dt

    from fleetcast.operators.models import base_feature, resolve_feature
    now = dt.datetime(2024, 1, 6, 9)  # Saturday
    cols = ["click", "heap_used", "view"]
    assert base_feature("heap_used_mean_5min") == "heap_used"
    assert resolve_feature("click", cols, now) == ("col", "click")
    assert resolve_feature("heap_used_max_60min", cols, now) == ("col", "heap_used")
    assert resolve_feature("click_rate", cols, now) == ("col", "click")
    assert resolve_feature("is_weekend", cols, now) == ("lit", 1.0)
    assert resolve_feature("gc_count", cols, now) == ("lit", 1000.0)
    assert resolve_feature("thread_pool", cols, now) == ("lit", 50.0)
    assert resolve_feature("other", cols, now) == ("lit", 0.0)
