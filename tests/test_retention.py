"""Pruning stored tables: read back, untouched partitions keep their files, dropped ones go, a second run changes nothing."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from fleetcast.operators import retention as RT
from fleetcast.operators.aggregate import every_micros, window_mean

T0 = dt.datetime(2024, 1, 1)


def files(path):
    return {f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture
def table(spark, tmp_path):
    """Ten days of hourly rows, two tenants, stored by day; returns (path, rows)."""
    rows = [(f"t{k}", T0 + dt.timedelta(hours=h), h) for h in range(240) for k in range(2)]
    df = spark.createDataFrame(rows, "tenant string, prediction_time timestamp, n int")
    path = str(tmp_path / "table")
    df.withColumn("day", F.to_date("prediction_time").cast("string")).repartition(2).write.partitionBy("day").parquet(path)
    return path, rows


def test_age_cut_drops_folders_and_rewrites_one(spark, table):
    path, rows = table
    before = files(path)
    keep = lambda t: RT.retain(t, "prediction_time", "2024-01-11 06:30:00", 7)
    done = RT.prune(spark, path, keep, ["day"])
    assert [k[0] for k in done.dropped] == ["2024-01-01", "2024-01-02", "2024-01-03"] and [k[0] for k in done.rewritten] == ["2024-01-04"]
    assert done.untouched == 6 and done.rows == 2 * (72 + 7)
    left = spark.read.parquet(path)
    assert sorted((r["tenant"], r["n"]) for r in left.collect()) == sorted((t, n) for t, at, n in rows if at >= dt.datetime(2024, 1, 4, 6, 30))
    after = files(path)
    days = lambda fs: {f for f in fs if not any(f"2024-01-0{d}" in f for d in range(1, 5))}
    assert days(after) == days(before) and not glob.glob(f"{path}/day=2024-01-01/*")
    again = RT.prune(spark, path, keep, ["day"])
    assert again == RT.Pruned([], [], 7, 0) and files(path) == after


def test_two_levels_and_superseded_rows(spark, tmp_path):
    """Rows of one target lose to a newer forecast in another batch: only that batch's folder changes."""
    rows = [("t", "d", T0 + dt.timedelta(hours=b), T0 + dt.timedelta(hours=10 + i), "cpu", float(b), f"{b:03d}") for b in (1, 2) for i in range(4) if b == 2 or i < 3]
    rows.append(("t", "d", T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=50), "cpu", 9.0, "001"))
    df = spark.createDataFrame(rows, "tenant string, device_id string, prediction_time timestamp, target_time timestamp, resource_type string, v double, batch string")
    path = str(tmp_path / "two")
    df.withColumn("day", F.to_date("target_time").cast("string")).write.partitionBy("day", "batch").parquet(path)
    before = files(path)
    done = RT.prune(spark, path, lambda t: RT.prune_predictions(t, T0 + dt.timedelta(days=3)), ["day", "batch"])
    assert done.dropped == [("2024-01-01", "001")] and done.rewritten == [] and done.untouched == 2 and done.rows == 3
    assert {f for f in before if "batch=002" in f or "2024-01-03" in f} == files(path)
    some = RT.prune(spark, path, lambda t: t.where("not (batch = '002' and v = 2.0 and hour(target_time) = 11)"), ["day", "batch"])
    assert some.rewritten == [("2024-01-01", "002")] and some.rows == 1
    assert spark.read.parquet(path).count() == 4


def test_day_and_week_bins(spark):
    assert every_micros("1 day") == 86_400_000_000 and every_micros("2 weeks") == 14 * 86_400_000_000
    rows = [("s", T0 + dt.timedelta(hours=h), float(h)) for h in range(48)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double")
    got = {r["time"]: r["value"] for r in window_mean(df, "1 day", ["k"], label="start").collect()}
    assert got == {T0: 11.5, T0 + dt.timedelta(days=1): 35.5}
