"""A hot device (a third of all points) must not land in one task of the minute aggregation."""

import datetime as dt

from pyspark.sql import functions as F

from fleetcast.sources.points import app_metrics


def test_hot_device_spreads_over_minutes(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the 8 hash partitions visible
    try:
        base = spark.range(0, 60_000).select(
            (F.col("id") % 3 == 0).alias("hot"), F.col("id"))
        pts = base.select(
            F.timestamp_micros(F.lit(int(dt.datetime(2024, 1, 1).timestamp() * 1e6)) + F.col("id") * 1_000_000)
            .alias("ts"),
            F.lit("server_data").alias("origin"), F.lit("t").alias("tenant"),
            F.when(F.col("hot"), F.lit("hot")).otherwise(F.concat(F.lit("d"), (F.col("id") % 50).cast("string")))
            .alias("device_id"),
            F.lit("service_resource_data").alias("location"), F.lit("app").alias("gateway"),
            F.lit("m").alias("measurement"), F.lit("value").alias("field"), (F.col("id") % 7).cast("double").alias("value"))
        out = app_metrics(pts)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        hot_rows = out.where(F.col("device_id") == "hot").count()
        assert hot_rows == 1000  # one row per minute of the hot device
        assert max(sizes) < 2.0 * (sum(sizes) / len(sizes))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
