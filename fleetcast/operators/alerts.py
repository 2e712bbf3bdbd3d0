"""Forecast frame and alerts.

The forecast horizon is a job parameter, so the step and the number of
points are plain integers; the grid itself is an ``explode(sequence)`` per
entity row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import align_time, hours_between, step_minutes_py, ts_lit

K = ["tenant", "device_id"]


def _ts(v) -> Column:
    return ts_lit(v) if isinstance(v, (str, _dt.datetime)) else v


# M9 ------------------------------------------------------------------------
def forecast_grid(entities: DataFrame, now, hours: int = 24) -> DataFrame:
    """(K, step_index, target_time): start = align(now, step) + step, ``hours*60 // step`` points."""
    step = step_minutes_py(hours)
    n = hours * 60 // step
    start = align_time(_ts(now), step) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(step))
    idx = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("step_index")
    g = entities.select(*K).distinct().select(*K, idx)
    return g.withColumn("target_time", start + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("step_index") * F.lit(step)).cast("int")))


def baseline_forecast(res: DataFrame, now, hours: int = 24) -> DataFrame:
    """Deterministic forecast: mean utilisation x (1 + step_index / points) per resource.

    Stands in for the model output wherever a checkable forecast is needed.
    """
    step = step_minutes_py(hours)
    n = hours * 60 // step
    mean = res.groupBy(*K, "resource_type").agg(F.avg("value").alias("_m"))
    grid = forecast_grid(res, now, hours)
    return grid.join(mean, K).select(
        *K, "resource_type", "step_index", "target_time",
        (F.col("_m") * (F.lit(1.0) + F.col("step_index") / F.lit(float(n)))).alias("predicted_value"))


# W7 ------------------------------------------------------------------------
def threshold_crossings(fc: DataFrame, limits: DataFrame) -> DataFrame:
    """First forecast at or above the limit per (K, resource).

    ``time_to_threshold`` is hours from the first forecast time; the current
    value is the first forecast.  ``limits`` (resource_type, threshold) is a
    small configuration table; the engine decides on a broadcast.
    """
    j = fc.join(limits, "resource_type")
    hit = F.col("predicted_value") >= F.col("threshold")
    g = j.groupBy(*K, "resource_type", "threshold").agg(
        F.min("target_time").alias("_first"),
        F.min(F.struct("target_time", "predicted_value")).alias("_cur"),
        F.min(F.when(hit, F.struct("target_time", "predicted_value"))).alias("_hit"))
    g = g.where(F.col("_hit").isNotNull())
    return g.select(*K, "resource_type", "threshold", F.col("_hit.target_time").alias("crossing_time"),
                    hours_between("_first", "_hit.target_time").alias("time_to_threshold"),
                    F.col("_cur.predicted_value").alias("current_value"),
                    F.col("_hit.predicted_value").alias("predicted_value"))


# X1 ------------------------------------------------------------------------
def _one_decimal(c: Column) -> Column:
    # round(x * 10) / 10 first, so '%.1f' never meets an exact half
    return F.round(c * F.lit(10.0)) / F.lit(10.0)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alert text per alert row (resource upper case, one decimal)."""
    device = F.when(F.coalesce(F.col("device_id"), F.lit("")) != "",
                    F.concat(F.lit(" (device: "), F.col("device_id"), F.lit(")"))).otherwise(F.lit(""))
    msg = F.format_string(
        "Resource threshold expected to be reached%s\n"
        "Resource: %s\nThreshold: %.1f%%\nExpected at: %s\nTime to threshold: %.1f h\n"
        "Current usage: %.1f%%\nPredicted usage: %.1f%%\n\nPlease check and act now.",
        device, F.upper("resource_type"), _one_decimal(F.col("threshold")),
        F.date_format("crossing_time", "yyyy-MM-dd HH:mm:00"), _one_decimal(F.col("time_to_threshold")),
        _one_decimal(F.col("current_value")), _one_decimal(F.col("predicted_value")))
    return alerts.select(*K, "resource_type", "crossing_time", msg.alias("message"))


# T3 ------------------------------------------------------------------------
def pending_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts not yet notified, newest first."""
    return alerts.where(~F.col("is_notified")).orderBy(F.col("created_at").desc())


# L4 ------------------------------------------------------------------------
ALERT_KEY = ["tenant", "device_id", "resource_type", "crossing_time", "batch_id"]


def mark_notified(alerts: DataFrame, sent: DataFrame, now) -> DataFrame:
    """New version of the alert table with the ``sent`` alerts marked notified at ``now``."""
    s = sent.select(*ALERT_KEY).distinct().withColumn("_sent", F.lit(True))
    j = alerts.join(s, ALERT_KEY, "left")
    hit = F.coalesce(F.col("_sent"), F.lit(False))
    return j.withColumn("notified_at", F.when(hit & ~F.col("is_notified"), _ts(now)).otherwise(F.col("notified_at"))) \
            .withColumn("is_notified", F.col("is_notified") | hit).select(*alerts.columns)
