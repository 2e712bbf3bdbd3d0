"""Tagged-point scans and the two metric views.

``points``: ts, origin, tenant, device_id, location, gateway, measurement,
field, value.  Stored partitioned by date, a range on ``ts`` prunes files
and the equality filters reach the parquet reader as pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_lit
from ..operators.aggregate import mean_by_key, window_mean

K = ["tenant", "device_id"]

# The canonical host-resource selection.
#   cpu  -> raw measurement usage_idle,  public measurement usage_user (100 - idle)
#   mem  -> raw measurement used_percent, public measurement used_percent
#   disk -> raw measurement used_percent, public measurement used_percent
RESOURCE_SOURCES = [
    ("cpu", "usage_idle", "usage_user"),
    ("mem", "used_percent", "used_percent"),
    ("disk", "used_percent", "used_percent"),
]
APP_LOCATION = "service_resource_data"
RESOURCE_LOCATION = "server_resource_data"
ORIGIN = "server_data"


def write_points(points: DataFrame, path: str, mode: str = "append", spread: int = 64) -> None:
    """Store points partitioned by UTC date, sorted within files by series and time.

    A time range then prunes whole date folders and the sort keeps row-group
    min/max statistics tight for tenant / device filters.  Each date is
    spread over ``spread`` writer tasks by a hash of (series, ts), so a hot
    device never lands in a single task.
    """
    salt = F.pmod(F.xxhash64("tenant", "device_id", "ts"), F.lit(spread))
    (points.withColumn("date", F.to_date("ts"))
     .repartition("date", salt)
     .sortWithinPartitions("tenant", "device_id", "ts")
     .write.mode(mode).partitionBy("date").parquet(path))


def read_points(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_points(points: DataFrame, tenant: str | None = None, start=None, stop=None,
                device: str | None = None, origin: str = ORIGIN) -> DataFrame:
    """Origin, tenant, optional device, half-open ``[start, stop)``.

    On a date-partitioned table the range is repeated on ``date`` so the
    partition filter prunes folders before any file is opened.
    """
    cond = F.col("origin") == origin
    if "date" in points.columns:
        if start is not None:
            cond = cond & (F.col("date") >= F.to_date(_ts(start)))
        if stop is not None:
            cond = cond & (F.col("date") <= F.to_date(_ts(stop)))
    if tenant is not None:
        cond = cond & (F.col("tenant") == tenant)
    if device is not None:
        cond = cond & (F.col("device_id") == device)
    if start is not None:
        cond = cond & (F.col("ts") >= _ts(start))
    if stop is not None:
        cond = cond & (F.col("ts") < _ts(stop))
    return points.where(cond)


def _ts(v):
    return ts_lit(v) if isinstance(v, (str, _dt.datetime)) else v


def recent_points(points: DataFrame, now, minutes: int, origin: str = ORIGIN) -> DataFrame:
    """The points of ``[now - minutes, now)``: what a look-back over minute rows (end labels) is made of.

    Look-backs cut the points, not the minute rows, so that the range reaches
    the files and the date folders.  ``now`` should be a whole minute.
    """
    return scan_points(points, start=_ts(now) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)), stop=now, origin=origin)


def is_app_metric() -> Column:
    """Points that S2 reads."""
    return (F.col("location") == APP_LOCATION) & (F.col("field") == "value")


def is_resource_metric() -> Column:
    """Points that S3 reads."""
    pick = F.lit(False)
    for gw, raw_m, _ in RESOURCE_SOURCES:
        pick = pick | ((F.col("gateway") == gw) & (F.col("measurement") == raw_m))
    return (F.col("location") == RESOURCE_LOCATION) & (F.col("field") == "value") & pick


def app_metrics(points: DataFrame, every: str = "1 minute", label: str = "end") -> DataFrame:
    """S2 + A1 + A2: per-minute mean per application metric.

    Output: tenant, device_id, time, application, metric_type, value.
    """
    raw = points.where(is_app_metric())
    per_series = window_mean(raw, every, K + ["gateway", "measurement"], ts="ts", value="value", label=label)
    renamed = per_series.select(*K, "time", F.col("gateway").alias("application"),
                                F.col("measurement").alias("metric_type"), "value")
    return mean_by_key(renamed, K + ["time", "application", "metric_type"])


def resource_metrics(points: DataFrame, every: str = "1 minute", label: str = "end") -> DataFrame:
    """S3 + U1: cpu / mem / disk utilisation per minute from one scan.

    The cpu value is ``100 - mean(idle)``, applied after averaging.
    Output: tenant, device_id, time, resource_type, measurement, value.
    """
    raw = points.where(is_resource_metric())
    per_series = window_mean(raw, every, K + ["gateway", "measurement"], ts="ts", value="value", label=label)
    # A2 on the series key itself (gateway = resource, raw measurement), so it reuses
    # the A1 partitioning; the public measurement and the cpu flip follow (the flip is
    # linear, and each public key has exactly one series)
    merged = mean_by_key(per_series, K + ["time", "gateway", "measurement"])
    public_m = None
    for gw, _, pub in RESOURCE_SOURCES:
        public_m = F.when(F.col("gateway") == gw, pub) if public_m is None else public_m.when(F.col("gateway") == gw, pub)
    value = F.when(F.col("gateway") == "cpu", F.lit(100.0) - F.col("value")).otherwise(F.col("value"))
    return merged.select(*K, "time", F.col("gateway").alias("resource_type"), public_m.alias("measurement"),
                         value.alias("value"))


def discover_entities(points: DataFrame, now, days: int, origin: str = ORIGIN) -> DataFrame:
    """Distinct (tenant, device_id) seen in the last ``days``; null/empty ids dropped."""
    lo = _ts(now) - F.make_dt_interval(F.lit(days))
    return (scan_points(points, start=lo, stop=now, origin=origin)
            .where(F.col("tenant").isNotNull() & (F.col("tenant") != "")
                   & F.col("device_id").isNotNull() & (F.col("device_id") != ""))
            .select(*K).dropDuplicates())
