"""Forecast accuracy over the prediction table.

All are set-based aggregations per (K, resource); the reference's per-row
select/update loop becomes one join (J3) followed by these.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import hours_between, ts_lit

K = ["tenant", "device_id"]
KR = [*K, "resource_type"]


def _ts(v) -> Column:
    return ts_lit(v) if isinstance(v, (str, _dt.datetime)) else v


def _since(now, hours: int, col: str = "prediction_time") -> Column:
    return F.col(col) >= _ts(now) - F.make_dt_interval(F.lit(0), F.lit(hours))


# A15 -----------------------------------------------------------------------
def validate_predictions(pred: DataFrame, now, hours: int = 24, max_error: float = 10.0,
                         max_mape: float = 15.0) -> DataFrame:
    """Count, mean/max/min error and MAPE per resource; zero actuals skip the sum but stay counted."""
    d = pred.where(F.col("actual_value").isNotNull() & _since(now, hours))
    ape = F.when(F.col("actual_value") != 0,
                 F.abs((F.col("actual_value") - F.col("predicted_value")) / F.col("actual_value")))
    g = d.groupBy(*KR).agg(F.count(F.lit(1)).alias("count"), F.avg("error").alias("avg_error"),
                           F.max("error").alias("max_error"), F.min("error").alias("min_error"),
                           F.coalesce(F.sum(ape), F.lit(0.0)).alias("_ape"))
    mape = F.col("_ape") / F.col("count") * F.lit(100.0)
    return g.select(*KR, "count", "avg_error", "max_error", "min_error", mape.alias("mape"),
                    ((F.col("avg_error") > max_error) | (mape > max_mape)).alias("degraded"))


# A16 -----------------------------------------------------------------------
def prediction_performance(pred: DataFrame, now, hours: int = 24) -> DataFrame:
    """MAE, RMSE, R^2 of the last ``hours``; the R^2 mean is over *all* actuals of the key.

    The all-history mean is a small per-key aggregate joined back (the
    reference's scalar subquery), so no window holds a whole key.
    """
    act = pred.where(F.col("actual_value").isNotNull())
    mean_all = act.groupBy(*KR).agg(F.avg("actual_value").alias("_mean"))
    recent = act.where(_since(now, hours)).join(mean_all, KR)
    dev = F.col("actual_value") - F.col("_mean")
    g = recent.groupBy(*KR).agg(F.count(F.lit(1)).alias("n"), F.avg("error").alias("mae"),
                                F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
                                F.sum(F.col("error") * F.col("error")).alias("_sse"), F.sum(dev * dev).alias("_sst"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.when(F.col("_sst") != 0, F.col("_sst")))
    return g.select(*KR, "n", "mae", "rmse", r2.alias("r2"))


# A17 -----------------------------------------------------------------------
def degraded_resources(pred: DataFrame, now, max_error: float = 10.0, min_count: int = 5,
                       hours: int = 24) -> DataFrame:
    """24 h mean error per resource with at least ``min_count`` rows; flag above the limit."""
    d = pred.where(F.col("actual_value").isNotNull() & _since(now, hours))
    g = d.groupBy(*KR).agg(F.avg("error").alias("avg_error"), F.count(F.lit(1)).alias("count"))
    return g.where(F.col("count") >= min_count).withColumn("degraded", F.col("avg_error") > max_error)


# A18 -----------------------------------------------------------------------
def model_freshness(perf: DataFrame, entities: DataFrame, now, max_age_hours: float = 168.0) -> DataFrame:
    """Latest training per entity, its age in hours, stale if older than the limit or absent."""
    last = perf.groupBy(*K).agg(F.max("trained_at").alias("last_trained"))
    j = entities.select(*K).distinct().join(last, K, "left")
    age = hours_between("last_trained", _ts(now))
    return j.select(*K, "last_trained", age.alias("age_hours"),
                    (F.col("last_trained").isNull() | (age > max_age_hours)).alias("stale"))


# M13 -----------------------------------------------------------------------
def retrain_decision(perf: DataFrame, pred: DataFrame, entities: DataFrame, now, max_age_hours: float = 168.0,
                     interval_hours: float = 6.0, max_error: float = 10.0) -> DataFrame:
    """Retrain when stale and (degraded, or the last training is older than the interval).

    Without any training row the last training counts as 30 days ago.
    """
    fresh = model_freshness(perf, entities, now, max_age_hours)
    deg = degraded_resources(pred, now, max_error).groupBy(*K).agg(
        F.max(F.col("degraded").cast("int")).alias("_deg"))
    j = fresh.join(deg, K, "left")
    last = F.coalesce(F.col("last_trained"), _ts(now) - F.make_dt_interval(F.lit(30)))
    overdue = hours_between(last, _ts(now)) > interval_hours
    degraded = F.coalesce(F.col("_deg"), F.lit(0)) == 1
    return j.select(*K, "stale", degraded.alias("degraded"), overdue.alias("overdue"),
                    (F.col("stale") & (degraded | overdue)).alias("retrain"))
