"""Partitioned point storage: a time range prunes date folders."""

import os
import tempfile

from fleetcast.sources.fixtures import fx_points
from fleetcast.sources import points as P
from fleetcast.sources.points import read_points, scan_points, write_points

SF = "/root/testdata/sf0.001"


def test_date_partition_pruning(spark):
    from fleetcast.sources.fixtures import events, points_from
    path = os.path.join(tempfile.mkdtemp(prefix="fleetcast-pts-", dir="/tmp"), "points")
    # uncompressed January clock: one date folder per day
    write_points(points_from(events(spark, SF, compress=False)), path, mode="overwrite")
    assert len([d for d in os.listdir(path) if d.startswith("date=")]) >= 28
    p = read_points(spark, path)
    q = scan_points(p, tenant="t-0", start="2024-01-10 00:00:00", stop="2024-01-12 00:00:00")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan
    assert "PushedFilters" in plan
    n = q.count()
    ref = scan_points(points_from(events(spark, SF, compress=False)), tenant="t-0",
                      start="2024-01-10 00:00:00", stop="2024-01-12 00:00:00").count()
    assert n == ref > 0


def test_fixture_points_shape(spark):
    p = fx_points(spark, SF)
    assert p.columns == ["ts", "origin", "tenant", "device_id", "location", "gateway", "measurement", "field", "value"]
    assert p.count() == 2 * events_count(spark)


def events_count(spark):
    from fleetcast.sources.fixtures import events
    return events(spark, SF).count()


def test_look_backs_prune_date_folders(spark, tmp_path):
    import re

    from pyspark.sql import functions as F

    from fleetcast.operators import health as HE
    rows = spark.range(0, 5 * 1440).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"), F.lit("server_data").alias("origin"),
        F.lit("t").alias("tenant"), F.lit("d").alias("device_id"), F.lit("server_resource_data").alias("location"),
        F.lit("mem").alias("gateway"), F.lit("used_percent").alias("measurement"), F.lit("value").alias("field"), F.lit(1.0).alias("value"))
    P.write_points(rows, str(tmp_path / "points"))
    pts = P.read_points(spark, str(tmp_path / "points"))
    now = "2024-01-05 12:00:00"
    recent = P.resource_metrics(P.recent_points(pts, now, 5))
    for df in (HE.latest_resources(recent, now), HE.collection_status(recent, recent, now), P.discover_entities(pts, now, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
        assert found and all("date#" in f for f in found), plan
    assert recent.count() == 5
    read = P.scan_points(pts, start="2024-01-05 11:55:00", stop=now)
    assert {r[0] for r in read.select(F.to_date("ts")).distinct().collect()} == {__import__("datetime").date(2024, 1, 5)}
