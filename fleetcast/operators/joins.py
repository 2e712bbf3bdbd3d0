"""Joins (J1-J5).

All are equi joins whose key contains the time (or the entity plus a time
bucket), so a hot entity is spread over its minutes; the only joins on the
entity key alone involve one-row-per-entity tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import ts_lit
from .series import grid_bounds

K = ["tenant", "device_id"]
MINUTE_US = 60_000_000


def _now(now) -> Column:
    return ts_lit(now) if isinstance(now, (str, _dt.datetime)) else now


# J1 ------------------------------------------------------------------------
def common_times(a: DataFrame, b: DataFrame, min_common: int = 5, ts: str = "time",
                 keys: Sequence[str] = K) -> DataFrame:
    """Shared minutes of two gridded series sets, per entity, gated at ``min_common``.

    Both grids run every minute from their entity's first to last time, so
    their intersection is the overlap of the two spans; only the bounds are
    joined (one row per entity on each side).
    """
    ba = grid_bounds(a, ts, keys).withColumnRenamed("grid_start", "a0").withColumnRenamed("grid_end", "a1")
    bb = grid_bounds(b, ts, keys).withColumnRenamed("grid_start", "b0").withColumnRenamed("grid_end", "b1")
    j = ba.join(bb, list(keys))
    start, end = F.greatest("a0", "b0"), F.least("a1", "b1")
    n = ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(MINUTE_US)).cast("long") + 1
    out = j.select(*keys, start.alias("common_start"), end.alias("common_end"), n.alias("n_common"))
    return out.where((F.col("common_start") <= F.col("common_end")) & (F.col("n_common") >= min_common))


# J2 ------------------------------------------------------------------------
def expand_scores(scores: DataFrame, common: DataFrame, keys: Sequence[str] = K) -> DataFrame:
    """Repeat each constant score at every common minute of its entity.

    ``common`` has one row per entity, so the join is on a small side and
    the expansion is an ``explode`` per score row.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    j = scores.join(common.select(*keys, "common_start", "common_end"), list(keys))
    return j.select(*[c for c in scores.columns], F.explode(F.sequence("common_start", "common_end", step)).alias("time"))


# J3 ------------------------------------------------------------------------
def attach_actuals(pred: DataFrame, res: DataFrame, now, lookback_hours: int = 24) -> DataFrame:
    """Fill ``actual_value`` / ``error`` of due forecasts from the resource table.

    Due: actual still null, ``target_time <= now``, whole-minute target, made
    within ``lookback_hours``.  The actual is the row of the same entity,
    resource, mapped measurement and exact minute (deduplicated first).  The
    result is the new version of the whole prediction table: only due rows
    meet the resource table, and of that only the minutes that due rows can
    ask for (a forecast is made before its target, so not before the
    look-back); all other rows pass by without a shuffle.
    """
    now_c = _now(now)
    since = now_c - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))
    due = F.coalesce(F.col("actual_value").isNull() & (F.col("target_time") <= now_c) & (F.second("target_time") == 0)
                     & (F.col("prediction_time") >= since) & (F.col("target_time") >= since), F.lit(False))
    measurement = F.when(F.col("resource_type") == "cpu", "usage_user").otherwise("used_percent")
    act = (res.where((F.col("time") >= since) & (F.col("time") <= now_c))
           .groupBy(*K, "resource_type", F.col("measurement").alias("_m"), F.col("time").alias("target_time"))
           .agg(F.min("value").alias("_actual")))
    j = pred.where(due).withColumn("_m", measurement).join(act, K + ["resource_type", "_m", "target_time"], "left")
    hit = F.col("_actual").isNotNull()
    done = j.withColumn("actual_value", F.when(hit, F.col("_actual")).otherwise(F.col("actual_value"))) \
            .withColumn("error", F.when(hit, F.abs(F.col("predicted_value") - F.col("_actual"))).otherwise(F.col("error")))
    return done.select(*pred.columns).unionByName(pred.where(~due))


# J4 ------------------------------------------------------------------------
def nearest_asof(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance_minutes: int = 2,
                 ts: str = "time", value: str = "value") -> DataFrame:
    """Nearest right row within the tolerance for each left row (ties -> later right row).

    Bucketed equi join: right rows are bucketed by ``tolerance``; each left
    row probes its bucket and both neighbours, so no range nested loop is
    planned.  The left table must be unique on (keys, ts).
    """
    b_us = tolerance_minutes * MINUTE_US
    r = right.select(*keys, F.col(ts).alias("_rt"), F.col(value).alias("_rv"),
                     F.floor(F.unix_micros(F.col(ts)) / F.lit(b_us)).alias("_b"))
    lb = F.floor(F.unix_micros(F.col(ts)) / F.lit(b_us))
    l_ = left.select("*", F.explode(F.array(lb - 1, lb, lb + 1)).alias("_b"))
    j = l_.join(r, list(keys) + ["_b"])
    gap = F.abs(F.unix_micros("_rt") - F.unix_micros(F.col(ts)))
    j = j.where(gap <= F.lit(b_us))
    best = j.groupBy(*keys, ts).agg(
        F.min_by(F.struct("_rt", "_rv"), F.struct(gap.alias("g"), (-F.unix_micros("_rt")).alias("o"))).alias("_m"))
    return left.join(best, list(keys) + [ts], "left").select(
        *left.columns, F.col("_m._rt").alias("matched_time"), F.col("_m._rv").alias(f"matched_{value}"))


# J5 ------------------------------------------------------------------------
PRED_KEY = ["tenant", "device_id", "target_time", "resource_type"]


def superseded_predictions(pred: DataFrame, now, keep_days: int = 1) -> DataFrame:
    """Rows older than the newest forecast of the same target (targets before now - 1 d).

    A window ``max`` replaces the self join; ``<`` keeps ties.  A null
    device compares equal to another null device.
    """
    cutoff = _now(now) - F.make_dt_interval(F.lit(keep_days))
    old = pred.where(F.col("target_time") < cutoff)
    w = Window.partitionBy("tenant", F.coalesce(F.col("device_id"), F.lit("")), "target_time", "resource_type")
    return old.withColumn("_latest", F.max("prediction_time").over(w)) \
              .where(F.col("prediction_time") < F.col("_latest")).drop("_latest")
