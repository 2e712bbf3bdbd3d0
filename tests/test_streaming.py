"""Streaming jobs: restarts, late rows, state over several deliveries, replayed batches, and stream = batch on closed windows."""

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetcast.sources import tables as TB
from fleetcast.sources.fixtures import fx_points, fx_points_stream
from fleetcast.sources.points import scan_points
from fleetcast.operators.aggregate import window_mean
from fleetcast.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_restart_resumes_without_duplicates(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="fleetcast-stream-", dir="/tmp"), "r1")
    first = J.run_available(spark, J.stream_window_mean(fx_points_stream(spark, SF)), "r1", base=base).count()
    again = J.run_available(spark, J.stream_window_mean(fx_points_stream(spark, SF)), "r1", base=base).count()
    assert first > 0 and again == first


def test_stream_equals_batch_on_closed_windows(spark):
    out = J.run_available(spark, J.stream_window_mean(fx_points_stream(spark, SF)), "r1")
    pts = scan_points(fx_points(spark, SF)).where(F.col("field") == "value")
    wm = pts.agg(F.max("ts")).first()[0]
    keys = ["tenant", "device_id", "location", "gateway", "measurement"]
    batch = window_mean(pts, "1 minute", keys).where(
        F.col("time") <= F.lit(wm) - F.expr("INTERVAL 10 MINUTES"))
    s = {(tuple(r[k] for k in keys), r["time"]): round(r["value"], 9) for r in out.collect()}
    b = {(tuple(r[k] for k in keys), r["time"]): round(r["value"], 9) for r in batch.collect()}
    assert s == b and len(s) > 0


# ---------------------------------------------------------------- several deliveries, late rows, restarts
T0 = dt.datetime(2024, 1, 1)
POINTS = ("ts timestamp, origin string, tenant string, device_id string, location string, gateway string, measurement string, "
          "field string, value double")


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def point(minutes, value=1.0, device="d", location="service_resource_data", gateway="app", measurement="m"):
    return (at(minutes), "server_data", "t", device, location, gateway, measurement, "value", float(value))


def run(spark, deliveries, job, name):
    """The job after each delivery of points, each run a new query from the same checkpoint."""
    def arrive(i, folder):
        spark.createDataFrame(deliveries[i], POINTS).coalesce(1).write.mode("append").parquet(folder)
    return J.run_in_arrivals(spark, arrive, len(deliveries), lambda f: spark.readStream.schema(POINTS).parquet(f), job, name)


def test_late_rows_inside_and_outside_the_delay(spark):
    """After 30 minutes the watermark is 20: a row of minute 21 counts, one of minute 10 comes too late."""
    out = run(spark, [[point(10.5, 1), point(21.5, 2), point(30, 3)], [point(21.6, 4), point(10.6, 100), point(50, 5)], [point(90, 6)]],
              J.stream_window_mean, "late")
    rows = {r["time"]: (r["value"], r["n"]) for r in out.collect()}
    assert rows == {at(11): (1.0, 1), at(22): (3.0, 2), at(31): (3.0, 1), at(51): (5.0, 1)}


def test_duplicates_over_two_deliveries(spark):
    """State outlives the runs: the repeat of minute 25 goes, the one of minute 5 comes too late to be looked at."""
    out = run(spark, [[point(5), point(25), point(25), point(30)], [point(25), point(5), point(31)], [point(31), point(60)]],
              J.stream_dedup, "twice")
    assert sorted(r["ts"] for r in out.collect()) == [at(5), at(25), at(30), at(31), at(60)]


def test_rolling_is_one_stream_of_chained_aggregations(spark):
    values = [(1, 2.0), (2, 4.0), (7, 9.0), (22, -1.0), (58, 5.0), (58.5, 5.0)]
    deliveries = [[point(m, v) for m, v in values[:3]], [point(m, v) for m, v in values[3:]], [point(200)], [point(300)]]
    seen = []
    out = run(spark, deliveries, lambda s: seen.append(J.stream_rolling(s)) or seen[-1], "rolling")
    plan = seen[0]._jdf.queryExecution().logical().toString()
    assert plan.count("Aggregate [") == 2
    rows = {(r["time"], r["window_minutes"]): r for r in out.collect() if r["time"] <= at(150)}
    expected = {}
    for size in (5, 15, 30, 60):
        for end in range(5, 151, 5):
            inside = [v for m, v in values if end - size <= m < end]
            if inside:
                mean = sum(inside) / len(inside)
                std = (sum((v - mean) ** 2 for v in inside) / (len(inside) - 1)) ** 0.5 if len(inside) > 1 else None
                expected[at(end), size] = (len(inside), mean, std, max(inside), min(inside), at(end - size))
    assert set(rows) == set(expected)
    for k, (n, mean, std, hi, lo, start) in expected.items():
        r = rows[k]
        assert (r["n"], r["max"], r["min"], r["window_start"]) == (n, hi, lo, start)
        assert abs(r["mean"] - mean) < 1e-9 and (r["std"] is None if std is None else abs(r["std"] - std) < 1e-6)


def test_silence_of_a_stop_and_of_a_pause(spark):
    """One device stops at 20, one pauses from 30 to 100 and goes on; a pause of 59 minutes is none."""
    def beat(device, *minutes):
        return [point(m, device=device) for m in minutes]
    out = run(spark, [beat("stops", 0, 20) + beat("pauses", 0, 30) + beat("steady", 0, 59), beat("pauses", 100) + beat("steady", 118),
                      beat("pauses", 150) + beat("steady", 170)], J.stream_silence, "silence")
    rows = {(r["device_id"], r["last_seen"], r["silent_at"]) for r in out.collect()}
    assert rows == {("stops", at(20), at(80)), ("pauses", at(30), at(90))}


def forecasts(spark, rows):
    from fleetcast.sources.tables import PREDICTION_COLUMNS
    data = [("t", "d", at(m - 30), at(m), "mem", v, None, None, "v1", None, b) for m, v, b in rows]
    schema = ("tenant string, device_id string, prediction_time timestamp, target_time timestamp, resource_type string, predicted_value double, "
              "actual_value double, error double, model_version string, confidence_score double, batch_id string")
    return spark.createDataFrame(data, schema).select(*PREDICTION_COLUMNS)


def minute_rows(spark, rows):
    return spark.createDataFrame([("t", "d", at(m), "mem", "used_percent", v) for m, v in rows],
                                 "tenant string, device_id string, time timestamp, resource_type string, measurement string, value double")


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The writer fails after its rows are there; the restarted query runs the batch again, with the same id."""
    store, base = str(tmp_path / "store"), str(tmp_path / "r5")
    TB.store_predictions(forecasts(spark, [(5, 1.0, "001"), (6, 2.0, "001"), (6, 3.0, "002")]), store)
    schema = minute_rows(spark, [(1, 1.0)]).schema
    minute_rows(spark, [(5, 1.5), (6, 1.0), (7, 9.0)]).write.parquet(f"{base}/in")
    write, calls = J.attach_batch(store, f"{base}/out"), []

    def fails_once(df, batch_id):
        write(df, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost after writing")

    def start():
        return (spark.readStream.schema(schema).parquet(f"{base}/in").writeStream.foreachBatch(fails_once)
                .option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    with pytest.raises(Exception):
        start().awaitTermination()
    before = sorted(map(tuple, J.attached(spark, base).collect()))
    start().awaitTermination()
    assert calls == [0, 0]
    after = sorted(map(tuple, J.attached(spark, base).collect()))
    assert after == before and len(after) == 3
    assert [(r["target_time"], r["predicted_value"], r["error"], r["batch_id"]) for r in J.attached(spark, base).orderBy("target_time", "batch_id").collect()] \
        == [(at(5), 1.0, 0.5, "001"), (at(6), 2.0, 1.0, "001"), (at(6), 3.0, 2.0, "002")]
    # forecasts stored between two batches are seen by the next one
    TB.store_predictions(forecasts(spark, [(9, 4.0, "003")]), store)
    minute_rows(spark, [(9, 5.0)]).write.mode("append").parquet(f"{base}/in")
    start().awaitTermination()
    assert J.attached(spark, base).count() == 4


def test_actuals_look_back_a_day(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    TB.store_predictions(forecasts(spark, [(0, 1.0, "001"), (10, 1.0, "001"), (1445, 1.0, "001")]), store)
    minutes = minute_rows(spark, [(0, 2.0), (10, 2.0), (1445, 2.0)])
    J.attach_batch(store, out)(minutes, 0)
    assert sorted(r["target_time"] for r in spark.read.parquet(out).collect()) == [at(10), at(1445)]
    J.attach_batch(store, out)(minutes.where("false"), 1)
    assert spark.read.parquet(out).count() == 2


def test_batches_are_stored_once(spark, tmp_path):
    """S6 run twice is S6 run once, and other batches keep their files."""
    store = str(tmp_path / "store")
    first = forecasts(spark, [(5, 1.0, "001"), (1500, 2.0, "001")])
    TB.store_predictions(first, store)
    TB.store_predictions(forecasts(spark, [(5, 7.0, "002")]), store)
    files = sorted(f for f in glob.glob(f"{store}/**/*.parquet", recursive=True) if "batch_id=002" in f)
    TB.store_predictions(first, store)
    rows = TB.read_predictions(spark, store)
    assert sorted((r["predicted_value"], r["batch_id"]) for r in rows.collect()) == [(1.0, "001"), (2.0, "001"), (7.0, "002")]
    assert sorted(f for f in glob.glob(f"{store}/**/*.parquet", recursive=True) if "batch_id=002" in f) == files
