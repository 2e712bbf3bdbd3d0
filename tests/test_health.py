"""Verdicts for silent, partial and cpu-only entities, written out by hand."""

import datetime as dt

from fleetcast.operators import aggregate as AG
from fleetcast.operators import clean as CL
from fleetcast.operators import health as HE

NOW = "2024-01-01 04:00:00"
T0 = dt.datetime(2024, 1, 1, 3, 59)


def _res(spark, rows):
    return spark.createDataFrame([("t", d, T0 - dt.timedelta(minutes=m), r, {"cpu": "usage_user"}.get(r, "used_percent"), float(v))
                                  for d, m, r, v in rows],
                                 "tenant string, device_id string, time timestamp, resource_type string, measurement string, value double")


def _app(spark, rows):
    return spark.createDataFrame([("t", d, T0 - dt.timedelta(minutes=m), a, k, 1.0) for d, m, a, k in rows],
                                 "tenant string, device_id string, time timestamp, application string, metric_type string, value double")


def _entities(spark, *names):
    return spark.createDataFrame([("t", n) for n in names], "tenant string, device_id string")


def _by_device(df):
    return {r.device_id: r for r in df.collect()}


def test_silent_entity_has_zero_resources_and_a_verdict(spark):
    res = _res(spark, [("a", 0, "cpu", 91), ("a", 0, "mem", 10), ("a", 30, "disk", 99)])
    got = _by_device(HE.resource_status(HE.latest_resources(res, NOW, entities=_entities(spark, "a", "s"))))
    assert (got["s"].cpu_percent, got["s"].mem_percent, got["s"].disk_percent, got["s"].status) == (0.0, 0.0, 0.0, "healthy")
    assert (got["a"].cpu_percent, got["a"].disk_percent, got["a"].over_limit, got["a"].status) == (91.0, 0.0, "cpu", "warning")


def test_collection_stopped_is_critical_and_half_is_a_warning(spark):
    app = _app(spark, [("a", m, "x", "k") for m in range(12)] + [("b", m, "x", "k") for m in range(12)] + [("late", -30, "x", "k")] * 20)
    res = _res(spark, [("a", m, "cpu", 1) for m in range(12)])
    got = _by_device(HE.collection_status(app, res, NOW, entities=_entities(spark, "a", "b", "s", "late")))
    assert {d: r.status for d, r in got.items()} == {"a": "healthy", "b": "warning", "s": "critical", "late": "critical"}
    assert (got["s"].app_rows, got["s"].res_rows) == (0, 0)


def test_no_model_no_forecast_no_job(spark):
    ents = _entities(spark, "s")
    perf = spark.createDataFrame([], "tenant string, device_id string, application string, resource_type string, model_type string, "
                                     "mae double, rmse double, r2_score double, trained_at timestamp")
    pred = spark.createDataFrame([], "tenant string, device_id string, prediction_time timestamp, error double")
    jobs = spark.createDataFrame([], "tenant string, device_id string, job_type string, start_time timestamp, end_time timestamp, status string")
    model = HE.model_status(perf, NOW, entities=ents).first()
    assert (model.model_count, model.n_poor, model.status) == (0, 0, "warning")
    assert HE.prediction_status(pred, NOW, entities=ents).first().status == "warning"
    assert HE.job_stats(jobs, NOW, entities=ents).first().status == "critical"
    assert HE.job_status(jobs, NOW, entities=ents).first().status == "healthy"


def test_a_failing_rare_job_type_is_not_hidden(spark):
    rows = [("t", "a", "often", T0, T0, "completed")] * 50 + [("t", "a", "rare", T0, T0, "failed")]
    jobs = spark.createDataFrame(rows, "tenant string, device_id string, job_type string, start_time timestamp, end_time timestamp, status string")
    got = HE.job_status(jobs, NOW).first()
    assert (got.jobs, got.bad_types, got.worst_success_pct, got.status) == (51, 1, 0.0, "warning")


def test_overall_status_takes_the_system_component(spark):
    one = spark.createDataFrame([("t", "a", "warning")], "tenant string, device_id string, status string")
    two = spark.createDataFrame([("t", "a", "healthy")], "tenant string, device_id string, status string")
    got = HE.overall_status({"system": one, "jobs": two}).first()
    assert (got.components, got.overall_status) == (2, "warning")


def test_resource_rows_without_app_rows_keep_the_first_window(spark):
    app = _app(spark, [("a", m, "x", "k") for m in range(0, 100, 5)])
    res = _res(spark, [("a", 50, "cpu", 1), ("a", 70, "cpu", 1), ("b", 20, "cpu", 1), ("b", 40, "cpu", 1)])
    _, out = CL.adaptive_lookback(app, res, NOW)
    assert sorted((r.device_id, (T0 - r.time).seconds // 60) for r in out.collect()) == [("a", 50), ("b", 20)]


def test_input_gate_asks_for_rows_apps_and_metrics_only(spark):
    app = _app(spark, [("a", m, "x", k) for m in range(15) for k in ("k1", "k2")])
    res = _res(spark, [("a", m, "cpu", 1) for m in range(12)])
    row = AG.input_gate(app, res).first()
    assert (row.app_rows, row.n_metrics, row.res_rows, row.input_ok) == (30, 2, 12, True)
