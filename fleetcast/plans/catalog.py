"""Registered queries for the cleaning, forecast, accuracy, health, retention and config operators.

Each entry pairs the Spark plan with its DuckDB twin (see ``oracle.py``).
``now`` is fixed per query (FIXTURES.md): the fixture clock ends at
2024-01-01 04:00; day-scale cuts use later instants.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions import time as T
from ..operators import accuracy as ACC
from ..operators import aggregate as AG
from ..operators import alerts as AL
from ..operators import clean as CL
from ..operators import config as CF
from ..operators import health as HE
from ..operators import joins as JN
from ..operators import retention as RT
from ..operators import series as SE
from ..operators.cooldown import alert_cooldown
from ..sources import points as PT
from ..sources import tables as TB
from ..sources.fixtures import events, fx_points
from ..session import ensure_checkpoint_dir
from . import impact as IP
from .oracle import cte, sql_with
from .registry import _app, _res, register

NOW = "2024-01-01 04:00:00"
K = ["tenant", "device_id"]
NOW_SQL = "TIMESTAMP '2024-01-01 04:00:00'"
RES3 = ["cpu", "mem", "disk"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _canon(spark, sf):
    return CL.canonical_resources(_res(spark, sf))


def _pred(spark, sf):
    return TB.fx_predictions(spark, sf)


def _pred_actual(spark, sf):
    return JN.attach_actuals(_pred(spark, sf), _res(spark, sf), NOW)


# ============================================================== fixtures (SQL)
cte("fx_predictions", ["canon_res"], """
WITH b AS (
  SELECT tenant, device_id, resource_type, time AS target_time,
         lag(value, 1) OVER (PARTITION BY tenant, device_id, resource_type ORDER BY time) AS lag1,
         lag(value, 2) OVER (PARTITION BY tenant, device_id, resource_type ORDER BY time) AS lag2
  FROM canon_res),
r AS (
  SELECT tenant, device_id, target_time - INTERVAL 30 minute AS prediction_time, target_time, resource_type,
         lag1 AS predicted_value FROM b
  UNION ALL
  SELECT tenant, device_id, target_time - INTERVAL 60 minute, target_time, resource_type, lag2 FROM b
  UNION ALL
  SELECT tenant, device_id, target_time - INTERVAL 30 minute, target_time, resource_type, lag1 + 1.0
  FROM b WHERE minute(target_time) % 7 = 0)
SELECT tenant, device_id, prediction_time, target_time, resource_type, predicted_value,
       CAST(NULL AS DOUBLE) AS actual_value, CAST(NULL AS DOUBLE) AS error,
       strftime(prediction_time, '%Y%m%d%H%M%S') AS model_version, CAST(NULL AS DOUBLE) AS confidence_score,
       strftime(prediction_time, '%Y%m%d%H%M%S') AS batch_id
FROM r WHERE predicted_value IS NOT NULL""")

cte("fx_model_performance", ["app_metrics", "canon_res"], """
SELECT a.tenant, a.device_id, a.application, r.resource_type, 'gradient_boosting' AS model_type,
       avg(abs(a.value - r.value)) AS mae, sqrt(avg((a.value - r.value) * (a.value - r.value))) AS rmse,
       coalesce(regr_r2(r.value, a.value), 0.0) AS r2_score, '{}' AS feature_importance,
       date_trunc('hour', a.time) AS trained_at, strftime(date_trunc('hour', a.time), '%Y%m%d%H%M%S') AS version
FROM app_metrics a JOIN canon_res r ON a.tenant = r.tenant AND a.device_id = r.device_id AND a.time = r.time
GROUP BY a.tenant, a.device_id, a.application, r.resource_type, date_trunc('hour', a.time)""")

cte("fx_jobs", ["ev"], """
SELECT concat('t-', CAST(user_id % 2 AS VARCHAR)) AS tenant, concat('dev-', CAST(user_id % 2 AS VARCHAR)) AS device_id,
       ['processing', 'training', 'prediction', 'cleanup', 'discovery'][user_id % 5 + 1] AS job_type,
       ts AS start_time, make_timestamp(epoch_us(ts) + CAST(trunc(value * 1000000) AS BIGINT)) AS end_time,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status
FROM ev""")

cte("fx_configurations", ["ev"], """
WITH c AS (
  SELECT *, ['time_alignment', 'collection', 'aggregation', 'excluded', 'model', 'alert'][event_id % 6 + 1] AS ctype,
         (event_id // 6) % 3 AS sub,
         ['cpu', 'mem', 'disk'][(event_id // 6) % 3 + 1] AS res,
         ['max', 'last', 'avg', 'mean'][user_id % 4 + 1] AS method,
         [' dev-1 , ,', 'dev-0 ,app-9', '', 'app-1, app-2'][user_id % 4 + 1] AS csv
  FROM ev)
SELECT event_id AS id, concat('t-', CAST(user_id % 2 AS VARCHAR)) AS tenant,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id % 2 END AS server_no,
       ctype AS config_type,
       CASE WHEN ctype = 'aggregation' THEN res
            WHEN ctype = 'alert' THEN res || '_threshold'
            WHEN ctype = 'excluded' THEN CASE WHEN sub = 2 THEN 'gateways' ELSE 'devices' END
            ELSE ctype || '_' || CAST(sub AS VARCHAR) END AS config_key,
       CASE WHEN ctype = 'aggregation' THEN
              CASE WHEN event_id % 4 = 0 THEN '{"method": "' || method || '", "reason": "r' || CAST(event_id AS VARCHAR) || '"}'
                   ELSE method END
            WHEN ctype = 'excluded' THEN csv
            ELSE CAST(CAST(round(value) AS BIGINT) AS VARCHAR) END AS config_value,
       event_id % 13 <> 0 AS is_active, ts AS updated_at
FROM c""")

cte("fx_registry", ["fx_points"], """
SELECT DISTINCT tenant, device_id, 'srv-' || device_id AS server_name, true AS is_active,
       CAST(NULL AS TIMESTAMP) AS registered_at
FROM fx_points WHERE tenant = 't-0'""")

cte("thresholds", [], """
SELECT resource_type, CAST(threshold AS DOUBLE) AS threshold
FROM (VALUES ('cpu', 80.0), ('mem', 80.0), ('disk', 85.0)) t(resource_type, threshold)""")

cte("fx_alerts", ["fx_predictions", "thresholds"], """
WITH p AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY tenant, device_id, resource_type, target_time
                                 ORDER BY predicted_value) AS rn
    FROM fx_predictions WHERE prediction_time = target_time - INTERVAL 30 minute) WHERE rn = 1)
SELECT p.tenant, p.device_id, p.resource_type, t.threshold, p.target_time AS crossing_time,
       CAST(0.5 AS DOUBLE) AS time_to_threshold, p.predicted_value AS current_value, p.predicted_value,
       minute(p.target_time) % 3 = 0 AS is_notified,
       CASE WHEN minute(p.target_time) % 3 = 0 THEN p.target_time END AS notified_at,
       CASE WHEN p.predicted_value >= t.threshold + 10 THEN 'critical' ELSE 'warning' END AS alert_level,
       p.prediction_time AS created_at, p.batch_id
FROM p JOIN thresholds t USING (resource_type) WHERE p.predicted_value >= t.threshold""")

cte("pred_actual", ["fx_predictions", "resource_metrics"], f"""
SELECT p.tenant, p.device_id, p.prediction_time, p.target_time, p.resource_type, p.predicted_value,
       CASE WHEN p.due AND a.actual IS NOT NULL THEN a.actual ELSE p.actual_value END AS actual_value,
       CASE WHEN p.due AND a.actual IS NOT NULL THEN abs(p.predicted_value - a.actual) ELSE p.error END AS error,
       p.model_version, p.confidence_score, p.batch_id
FROM (SELECT *, actual_value IS NULL AND target_time <= {NOW_SQL} AND second(target_time) = 0
                AND prediction_time >= {NOW_SQL} - INTERVAL 24 hour AS due,
             CASE WHEN resource_type = 'cpu' THEN 'usage_user' ELSE 'used_percent' END AS m
      FROM fx_predictions) p
LEFT JOIN (SELECT tenant, device_id, resource_type, measurement, time, min(value) AS actual
           FROM resource_metrics GROUP BY tenant, device_id, resource_type, measurement, time) a
  ON p.tenant = a.tenant AND p.device_id = a.device_id AND p.resource_type = a.resource_type
 AND p.m = a.measurement AND p.target_time = a.time""")

cte("fx_forecast", ["canon_res"], f"""
SELECT m.tenant, m.device_id, m.resource_type, CAST(i AS INTEGER) AS step_index,
       date_trunc('hour', {NOW_SQL}) + to_minutes(CAST(floor(minute({NOW_SQL}) / 30) * 30 AS BIGINT))
         + INTERVAL 30 minute + to_minutes(CAST(i * 30 AS BIGINT)) AS target_time,
       m.mean * (1.0::DOUBLE + CAST(i AS DOUBLE) / 48.0::DOUBLE) AS predicted_value
FROM (SELECT tenant, device_id, resource_type, avg(value) AS mean FROM canon_res
      GROUP BY tenant, device_id, resource_type) m, range(0, 48) t(i)""")

cte("crossings", ["fx_forecast", "thresholds"], """
SELECT f.tenant, f.device_id, f.resource_type, t.threshold,
       min(f.target_time) FILTER (WHERE f.predicted_value >= t.threshold) AS crossing_time,
       CAST(epoch_us(min(f.target_time) FILTER (WHERE f.predicted_value >= t.threshold)) - epoch_us(min(f.target_time))
            AS DOUBLE) / 3600000000.0 AS time_to_threshold,
       arg_min(f.predicted_value, f.target_time) AS current_value,
       arg_min(f.predicted_value, f.target_time) FILTER (WHERE f.predicted_value >= t.threshold) AS predicted_value
FROM fx_forecast f JOIN thresholds t USING (resource_type)
GROUP BY f.tenant, f.device_id, f.resource_type, t.threshold
HAVING count(*) FILTER (WHERE f.predicted_value >= t.threshold) > 0""")

cte("eff_config", ["fx_configurations"], """
SELECT tenant, config_type, config_key, arg_max(config_value, id) AS config_value, max(id) AS id
FROM fx_configurations WHERE is_active GROUP BY tenant, config_type, config_key""")

cte("agg_config", ["eff_config"], """
SELECT tenant, config_key AS resource_type,
       CASE WHEN starts_with(config_value, '{') THEN coalesce(json_extract_string(config_value, '$.method'), config_value)
            ELSE config_value END AS method,
       CASE WHEN starts_with(config_value, '{') THEN json_extract_string(config_value, '$.reason') END AS reason
FROM eff_config WHERE config_type = 'aggregation'""")


def _excl_items(key: str, trim: bool) -> str:
    x = "trim(x)" if trim else "x"
    return f"""
SELECT DISTINCT tenant, unnest(list_filter(list_transform(string_split(coalesce(config_value, ''), ','), lambda x: {x}),
                                           lambda x: x <> '')) AS item
FROM eff_config WHERE config_type = 'excluded' AND config_key = '{key}'"""


cte("excl_devices", ["eff_config"], _excl_items("devices", True))
cte("excl_gateways", ["eff_config"], _excl_items("gateways", False))


# ============================================================== projections / filters
@register("p1_local_time", sql_with(["app_metrics"], """
SELECT tenant, device_id, time, application, metric_type, time + INTERVAL 9 hour AS local_time,
       time AS utc_again FROM app_metrics"""))
def q_p1(spark, sf):
    """UTC <-> local wall clock (Asia/Seoul, fixed +9 h)."""
    a = _app(spark, sf)
    loc = T.to_local("time", "Asia/Seoul")
    return a.select(*K, "time", "application", "metric_type", loc.alias("local_time"),
                    T.to_utc(loc, "Asia/Seoul").alias("utc_again"))


@register("p2_align_time", sql_with(["fx_points"], """
SELECT ts, date_trunc('minute', ts) AS aligned_1,
       date_trunc('hour', ts) + to_minutes(CAST(floor(minute(ts) / 7) * 7 AS BIGINT)) AS aligned_7,
       date_trunc('hour', ts) + to_minutes(CAST(floor(minute(ts) / 15) * 15 AS BIGINT)) AS aligned_15
FROM fx_points WHERE location = 'service_resource_data'"""))
def q_p2(spark, sf):
    """Align down within the hour (1, 7 and 15 minutes)."""
    p = fx_points(spark, sf).where(F.col("location") == "service_resource_data")
    return p.select("ts", T.align_time("ts", 1).alias("aligned_1"), T.align_time("ts", 7).alias("aligned_7"),
                    T.align_time("ts", 15).alias("aligned_15"))


@register("p3_calendar", sql_with(["ev_raw"], """
SELECT event_id, ts, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM ev_raw"""))
def q_p3(spark, sf):
    """Hour, day_of_week (Mon = 0), is_weekend over the uncompressed January events."""
    ev = events(spark, sf, compress=False)
    return ev.select("event_id", "ts", *T.calendar_columns("ts"))


@register("p4_canonical_resources", sql_with(["canon_res"], "SELECT * FROM canon_res"), ["value"])
def q_p4(spark, sf):
    """Canonical (resource, measurement) pairs."""
    return _canon(spark, sf)


@register("p5_exclude_devices", sql_with(["app_metrics", "excl_devices"], """
SELECT * FROM app_metrics a WHERE NOT EXISTS (
  SELECT 1 FROM excl_devices e WHERE e.tenant = a.tenant AND e.item = a.device_id)"""), ["value"])
def q_p5(spark, sf):
    """P5: drop devices in the tenant's (trimmed CSV) exclusion list."""
    return CL.exclude_devices(_app(spark, sf), TB.fx_configurations(spark, sf))


@register("p6_exclude_gateways", sql_with(["app_metrics", "excl_gateways"], """
SELECT * FROM app_metrics a WHERE NOT EXISTS (
  SELECT 1 FROM excl_gateways e WHERE e.tenant = a.tenant AND e.item = a.application)"""), ["value"])
def q_p6(spark, sf):
    """Drop applications in the tenant's gateway exclusion list (no trim)."""
    return CL.exclude_gateways(_app(spark, sf), TB.fx_configurations(spark, sf))


# Range rules (reference rules plus two for fixture metrics).
RANGE_RULES = [("cpu_utilization_percent", 0.0, 100.0), ("memory_usage_percent", 0.0, 100.0),
               ("disk_usage_percent", 0.0, 100.0), ("thread_count", 0.0, 10000.0), ("memory_bytes", 0.0, 1e12),
               ("purchase", 0.0, 100.0), ("error", 0.0, 50.0)]
_rules_sql = ", ".join(f"('{m}', {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for m, lo, hi in RANGE_RULES)


@register("p7_validate_ranges", sql_with(["app_metrics"], f"""
SELECT a.* FROM app_metrics a LEFT JOIN (VALUES {_rules_sql}) r(metric, lo, hi) ON a.metric_type = r.metric
WHERE r.metric IS NULL OR a.value BETWEEN r.lo AND r.hi"""), ["value"])
def q_p7(spark, sf):
    """Per-metric value ranges; unknown metrics pass."""
    rules = spark.createDataFrame(RANGE_RULES, "metric string, min double, max double")
    return CL.validate_ranges(_app(spark, sf), rules)


@register("p9_lookback", sql_with(["ev_raw"], """
SELECT event_id, ts, value FROM ev_raw WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 day"""), ["value"])
def q_p9(spark, sf):
    """P9: '2w' lookback over the uncompressed events."""
    ev = events(spark, sf, compress=False)
    return CL.lookback(ev, "ts", "2024-01-31 00:00:00", "2w").select("event_id", "ts", "value")


# resource rows of a device without app rows and with one resource only, beside the others
cte("p10_res", ["resource_metrics"], """
SELECT * FROM resource_metrics UNION ALL
SELECT tenant, 'dev-quiet' AS device_id, time, resource_type, measurement, value FROM resource_metrics
WHERE device_id = 'dev-0' AND resource_type = 'cpu'""")
# ... and its app rows, for the gates
cte("gate_app", ["app_metrics"], """
SELECT * FROM app_metrics UNION ALL
SELECT tenant, 'dev-quiet' AS device_id, time, application, metric_type, value FROM app_metrics WHERE device_id = 'dev-0'""")
# the registry also knows a device of each tenant that never reported
cte("fx_entities", ["fx_points"], """
SELECT DISTINCT tenant, device_id FROM fx_points UNION SELECT DISTINCT tenant, 'dev-silent' AS device_id FROM fx_points""")


def _quiet_res(spark, sf, minutes=None):
    res = _res(spark, sf) if minutes is None else _recent_res(spark, sf, minutes)
    quiet = res.where((F.col("device_id") == "dev-0") & (F.col("resource_type") == "cpu"))
    return res.unionByName(quiet.withColumn("device_id", F.lit("dev-quiet")))


def _quiet_app(spark, sf):
    app = _app(spark, sf)
    return app.unionByName(app.where(F.col("device_id") == "dev-0").withColumn("device_id", F.lit("dev-quiet")))


def _recent_res(spark, sf, minutes):
    return PT.resource_metrics(PT.recent_points(fx_points(spark, sf), NOW, minutes))


def _recent_app(spark, sf, minutes):
    return PT.app_metrics(PT.recent_points(fx_points(spark, sf), NOW, minutes))


def _entities(spark, sf):
    seen = fx_points(spark, sf).select(*K).distinct()
    return seen.unionByName(seen.select("tenant", F.lit("dev-silent").alias("device_id")).distinct())


_P10 = f"""
WITH n AS (
  SELECT tenant, device_id,
    {', '.join(f"count(*) FILTER (WHERE time > {NOW_SQL} - INTERVAL {m} minute) AS n{m}" for m in (30, 60, 120, 360))}
  FROM app_metrics WHERE time > {NOW_SQL} - INTERVAL 360 minute AND time <= {NOW_SQL} GROUP BY tenant, device_id),
c AS (
  SELECT tenant, device_id,
    coalesce(CASE WHEN n30 >= 10 THEN 30 WHEN n60 >= 10 THEN 60 WHEN n120 >= 10 THEN 120 WHEN n360 >= 10 THEN 360 END, 360) AS am,
    coalesce(CASE WHEN n30 >= 10 THEN 30 WHEN n60 >= 10 THEN 60 WHEN n120 >= 10 THEN 120 WHEN n360 >= 10 THEN 360 END, 30) AS rm
  FROM n)"""


@register("p10_adaptive_app", sql_with(["app_metrics"], _P10 + f"""
SELECT a.* FROM app_metrics a JOIN c USING (tenant, device_id)
WHERE a.time > {NOW_SQL} - to_minutes(CAST(c.am AS BIGINT)) AND a.time <= {NOW_SQL}"""), ["value"])
def q_p10a(spark, sf):
    """P10: adaptive lookback, application rows."""
    return CL.adaptive_lookback(_recent_app(spark, sf, 360), _recent_res(spark, sf, 360), NOW)[0]


@register("p10_adaptive_res", sql_with(["app_metrics", "p10_res"], _P10 + f"""
SELECT r.* FROM p10_res r LEFT JOIN c ON r.tenant = c.tenant AND r.device_id = c.device_id
WHERE r.time > {NOW_SQL} - to_minutes(CAST(coalesce(c.rm, 30) AS BIGINT)) AND r.time <= {NOW_SQL}"""), ["value"])
def q_p10r(spark, sf):
    """P10: adaptive lookback, resource rows (follow the app window; 30 min when none qualifies)."""
    return CL.adaptive_lookback(_recent_app(spark, sf, 360), _quiet_res(spark, sf, 360), NOW)[1]


# ============================================================== sources
@register("s1_scan_points", sql_with(["fx_points"], """
SELECT * FROM fx_points WHERE origin = 'server_data' AND tenant = 't-1'
  AND ts >= TIMESTAMP '2024-01-01 01:00:00' AND ts < TIMESTAMP '2024-01-01 03:00:00'"""), ["value"])
def q_s1(spark, sf):
    """Origin, tenant and half-open time range."""
    return PT.scan_points(fx_points(spark, sf), tenant="t-1", start="2024-01-01 01:00:00", stop="2024-01-01 03:00:00")


@register("s4_discover_entities", sql_with(["fx_points"], f"""
SELECT DISTINCT tenant, device_id FROM fx_points
WHERE origin = 'server_data' AND ts >= {NOW_SQL} - INTERVAL 7 day AND ts < {NOW_SQL}
  AND tenant IS NOT NULL AND tenant <> '' AND device_id IS NOT NULL AND device_id <> ''"""))
def q_s4(spark, sf):
    """Entities seen in the last 7 days."""
    return PT.discover_entities(fx_points(spark, sf), NOW, 7)


@register("s5_new_entities", sql_with(["fx_points", "fx_registry"], f"""
WITH d AS (SELECT DISTINCT tenant, device_id FROM fx_points
           WHERE origin = 'server_data' AND ts >= {NOW_SQL} - INTERVAL 7 day AND ts < {NOW_SQL})
SELECT d.tenant, d.device_id, d.tenant NOT IN (SELECT tenant FROM fx_registry) AS new_tenant
FROM d WHERE NOT EXISTS (SELECT 1 FROM fx_registry r WHERE r.tenant = d.tenant AND r.device_id = d.device_id)"""))
def q_s5(spark, sf):
    """Discovered entities not yet in the registry."""
    return TB.new_entities(PT.discover_entities(fx_points(spark, sf), NOW, 7), TB.fx_registry(spark, sf))


@register("s6_prediction_rows", sql_with(["fx_forecast"], f"""
SELECT tenant, device_id, {NOW_SQL} AS prediction_time, target_time, resource_type, predicted_value,
       CAST(NULL AS DOUBLE) AS actual_value, CAST(NULL AS DOUBLE) AS error, '20240101040000' AS model_version,
       CAST(NULL AS DOUBLE) AS confidence_score, '20240101040000' AS batch_id
FROM fx_forecast"""), ["predicted_value"])
def q_s6(spark, sf):
    """Forecast -> prediction rows, stored by target date and batch; the batch is stored twice and is there once."""
    rows = TB.to_prediction_rows(AL.baseline_forecast(_canon(spark, sf), NOW, 24), NOW)
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    for _ in range(2):
        TB.store_predictions(rows, path)
    return TB.read_predictions(spark, path).select(*rows.columns)


@register("s7_alert_rows", sql_with(["crossings"], f"""
SELECT tenant, device_id, resource_type, threshold, crossing_time, time_to_threshold, current_value,
       predicted_value, false AS is_notified, CAST(NULL AS TIMESTAMP) AS notified_at,
       CASE WHEN predicted_value >= threshold + 10 THEN 'critical' ELSE 'warning' END AS alert_level,
       {NOW_SQL} AS created_at, '20240101040000' AS batch_id
FROM crossings"""), ["threshold", "time_to_threshold", "current_value", "predicted_value"])
def q_s7(spark, sf):
    """Threshold crossings -> alert rows, stored by batch; the batch is stored twice and is there once."""
    fc = AL.baseline_forecast(_canon(spark, sf), NOW, 24)
    rows = TB.to_alert_rows(AL.threshold_crossings(fc, TB.thresholds(spark)), NOW)
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    for _ in range(2):
        TB.write_batches(rows, path)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@register("s8_profile", sql_with(["impacts"], """
SELECT tenant, device_id, count(*) AS n_rows, count(DISTINCT application) AS n_application,
       count(DISTINCT resource_type) AS n_resource_type, min(impact_score) AS min_value,
       max(impact_score) AS max_value, avg(impact_score) AS mean_value
FROM impacts GROUP BY tenant, device_id"""), ["min_value", "max_value", "mean_value"])
def q_s8(spark, sf):
    """Snapshot profile of the impacts table."""
    return TB.profile(IP.impact_table(fx_points(spark, sf)), K, ["application", "resource_type"], "impact_score")


# ============================================================== joins
@register("j3_attach_actuals", sql_with(["pred_actual"], "SELECT * FROM pred_actual"),
          ["predicted_value", "actual_value", "error", "confidence_score"])
def q_j3(spark, sf):
    """Due forecasts get the actual of the same minute and their error."""
    return _pred_actual(spark, sf)


@register("j4_nearest_asof", sql_with(["canon_res", "app_metrics"], """
WITH l AS (SELECT * FROM canon_res WHERE resource_type = 'cpu'),
r AS (SELECT * FROM app_metrics WHERE application = 'app-0' AND metric_type = 'click'),
c AS (
  SELECT l.tenant, l.device_id, l.time, r.time AS rt, r.value AS rv,
         row_number() OVER (PARTITION BY l.tenant, l.device_id, l.time
                            ORDER BY abs(epoch_us(r.time) - epoch_us(l.time)), r.time DESC) AS rn
  FROM l JOIN r ON l.tenant = r.tenant AND l.device_id = r.device_id
   AND abs(epoch_us(r.time) - epoch_us(l.time)) <= 120000000)
SELECT l.*, c.rt AS matched_time, c.rv AS matched_value
FROM l LEFT JOIN c ON l.tenant = c.tenant AND l.device_id = c.device_id AND l.time = c.time AND c.rn = 1"""),
          ["value", "matched_value"])
def q_j4(spark, sf):
    """Nearest app sample within 2 minutes of each cpu minute (ties -> later)."""
    left = _canon(spark, sf).where(F.col("resource_type") == "cpu")
    right = _app(spark, sf).where((F.col("application") == "app-0") & (F.col("metric_type") == "click"))
    return JN.nearest_asof(left, right, K, 2)


@register("j5_superseded", sql_with(["fx_predictions"], """
SELECT * EXCLUDE (latest) FROM (
  SELECT *, max(prediction_time) OVER (PARTITION BY tenant, coalesce(device_id, ''), target_time, resource_type) AS latest
  FROM fx_predictions WHERE target_time < TIMESTAMP '2024-01-03 00:00:00' - INTERVAL 1 day)
WHERE prediction_time < latest"""), ["predicted_value", "actual_value", "error", "confidence_score"])
def q_j5(spark, sf):
    """Forecasts superseded by a newer one for the same target (ties survive)."""
    return JN.superseded_predictions(_pred(spark, sf), "2024-01-03 00:00:00")


# ============================================================== aggregates
_pivot_cols = ", ".join(f"avg(value) FILTER (WHERE metric_type = '{m}') AS {m}" for m in EVENT_TYPES)


@register("a4_pivot_mean", sql_with(["app_metrics"], f"""
SELECT tenant, device_id, time, application, {_pivot_cols}
FROM app_metrics GROUP BY tenant, device_id, time, application"""), EVENT_TYPES)
def q_a4(spark, sf):
    """A4: time x (application, metric) pivot with explicit values."""
    return AG.pivot_mean(_app(spark, sf), [*K, "time", "application"], "metric_type", "value", EVENT_TYPES)


_a3_sql = """
WITH pts AS (
  SELECT tenant, device_id, gateway AS resource_type, ts,
         CASE WHEN gateway = 'cpu' THEN 100.0 - value ELSE value END AS value
  FROM fx_points WHERE origin = 'server_data' AND location = 'server_resource_data'
   AND ((gateway = 'cpu' AND measurement = 'usage_idle') OR (gateway IN ('mem', 'disk') AND measurement = 'used_percent'))),
agg AS (
  SELECT tenant, device_id, resource_type, time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute AS time,
         max(value) AS v_max, arg_max(value, ts) AS v_last, avg(value) AS v_avg
  FROM pts GROUP BY tenant, device_id, resource_type, time_bucket(INTERVAL 1 minute, ts)),
j AS (
  SELECT a.*, coalesce(m.method, CASE a.resource_type WHEN 'cpu' THEN 'max' WHEN 'mem' THEN 'last'
                                                       WHEN 'disk' THEN 'last' END, 'avg') AS method
  FROM agg a LEFT JOIN agg_config m ON a.tenant = m.tenant AND a.resource_type = m.resource_type)
SELECT tenant, device_id, resource_type, time, method,
       CASE WHEN method = 'max' THEN v_max WHEN method = 'last' THEN v_last ELSE v_avg END AS value
FROM j"""


@register("a3_resource_rollup", sql_with(["fx_points", "agg_config"], _a3_sql), ["value"])
def q_a3(spark, sf):
    """A3: per-minute resource roll-up by the tenant's configured method (default cpu max, mem/disk last)."""
    p = PT.scan_points(fx_points(spark, sf))
    pick = (((F.col("gateway") == "cpu") & (F.col("measurement") == "usage_idle"))
            | (F.col("gateway").isin("mem", "disk") & (F.col("measurement") == "used_percent")))
    pts = p.where((F.col("location") == "server_resource_data") & pick).select(
        *K, F.col("gateway").alias("resource_type"), "ts",
        F.when(F.col("gateway") == "cpu", F.lit(100.0) - F.col("value")).otherwise(F.col("value")).alias("value"))
    methods = CF.decode_aggregation_config(TB.fx_configurations(spark, sf))
    return AG.resource_rollup(pts, "1 minute", methods.select("tenant", "resource_type", "method"))


@register("a7_serving_impact_stats", sql_with(["scores"], f"""
SELECT tenant, device_id,
  {', '.join(f'''CASE WHEN count(impact_score) FILTER (WHERE resource_type = '{r}') > 0 THEN sum(impact_score) FILTER (WHERE resource_type = '{r}') ELSE 0.5 END AS {r}_impact_sum,
  CASE WHEN count(impact_score) FILTER (WHERE resource_type = '{r}') > 0 THEN avg(impact_score) FILTER (WHERE resource_type = '{r}') ELSE 0.5 END AS {r}_impact_mean,
  CASE WHEN count(impact_score) FILTER (WHERE resource_type = '{r}') > 0 THEN max(impact_score) FILTER (WHERE resource_type = '{r}') ELSE 0.5 END AS {r}_impact_max,
  CASE WHEN count(impact_score) FILTER (WHERE resource_type = '{r}') > 0 THEN stddev_pop(impact_score) FILTER (WHERE resource_type = '{r}') ELSE 0.0 END AS {r}_impact_std''' for r in RES3)}
FROM scores GROUP BY tenant, device_id"""), AG.STAT_COLUMNS)
def q_a7(spark, sf):
    """Serving impact statistics over current scores (population std, absent -> 0.5)."""
    return AG.serving_impact_stats(IP.impact_score_table(fx_points(spark, sf)))


@register("a8_latest_profile", sql_with(["app_metrics"], f"""
WITH r AS (SELECT *, max(time) OVER (PARTITION BY tenant, device_id, application) AS newest FROM app_metrics
           WHERE time > {NOW_SQL} - INTERVAL 30 minute AND time <= {NOW_SQL})
SELECT tenant, device_id, application, metric_type, avg(value) AS value, max(time) AS latest_time, CAST(hour(newest) AS INTEGER) AS hour,
       CAST(isodow(newest) - 1 AS INTEGER) AS day_of_week, CASE WHEN isodow(newest) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM r GROUP BY tenant, device_id, application, metric_type, newest"""), ["value"])
def q_a8(spark, sf):
    """Mean per application metric over the last 30 minutes, with the calendar of the application's newest time."""
    return AG.latest_profile(_recent_app(spark, sf, 30), NOW, 30)


@register("a9_last_profile", sql_with(["app_metrics"], """
SELECT tenant, device_id, application, metric_type, arg_max(value, time) AS value, max(time) AS latest_time
FROM app_metrics GROUP BY tenant, device_id, application, metric_type"""), ["value"])
def q_a9(spark, sf):
    """Last value per application metric."""
    return AG.last_profile(_app(spark, sf))


@register("a10_resample_mean", sql_with(["canon_res"], """
SELECT tenant, device_id, resource_type, time_bucket(INTERVAL 5 minute, time) AS time, avg(value) AS value
FROM canon_res GROUP BY tenant, device_id, resource_type, time_bucket(INTERVAL 5 minute, time)"""), ["value"])
def q_a10(spark, sf):
    """A10: 5-minute mean of the resources (bin start label)."""
    return AG.resample_mean(_canon(spark, sf), "5 minutes", [*K, "resource_type"])


@register("a11_resample_last", sql_with(["canon_res"], """
SELECT tenant, device_id, resource_type, time_bucket(INTERVAL 5 minute, time) AS time, arg_max(value, time) AS value
FROM canon_res WHERE value IS NOT NULL
GROUP BY tenant, device_id, resource_type, time_bucket(INTERVAL 5 minute, time)"""), ["value"])
def q_a11(spark, sf):
    """Last non-null resource value per 5-minute bin."""
    return AG.resample_last(_canon(spark, sf), "5 minutes", [*K, "resource_type"])


_gate_sql = """
WITH a AS (SELECT tenant, device_id, count(*) AS app_rows, count(DISTINCT application) AS n_apps,
                  count(DISTINCT metric_type) AS n_metrics, count(value) AS app_values
           FROM app_metrics GROUP BY tenant, device_id),
r AS (SELECT tenant, device_id, count(*) AS res_rows, list_sort(list(DISTINCT resource_type)) AS resources,
             count(value) AS res_values FROM resource_metrics GROUP BY tenant, device_id),
j AS (SELECT coalesce(a.tenant, r.tenant) AS tenant, coalesce(a.device_id, r.device_id) AS device_id,
             coalesce(app_rows, 0) AS app_rows, coalesce(n_apps, 0) AS n_apps, coalesce(n_metrics, 0) AS n_metrics,
             coalesce(res_rows, 0) AS res_rows, coalesce(app_values, 0) AS app_values,
             coalesce(res_values, 0) AS res_values,
             list_filter(['cpu', 'mem', 'disk'], lambda x: NOT list_contains(coalesce(resources, []), x)) AS missing
      FROM a FULL JOIN r ON a.tenant = r.tenant AND a.device_id = r.device_id)"""


@register("a12_training_gate", sql_with(["app_metrics", "resource_metrics"], _gate_sql + """
SELECT tenant, device_id, app_rows, n_apps, n_metrics, res_rows, array_to_string(missing, ',') AS missing_resources,
       app_rows >= 50 AND n_apps >= 2 AND n_metrics >= 3 AND res_rows >= 30 AND len(missing) = 0
       AND app_values > 0 AND res_values > 0 AS is_valid
FROM j"""))
def q_a12(spark, sf):
    """Training input gate per entity."""
    return AG.training_gate(_app(spark, sf), _res(spark, sf))


@register("a13_input_gate", sql_with(["gate_app", "p10_res"], """
WITH a AS (SELECT tenant, device_id, count(*) AS app_rows, count(DISTINCT application) AS n_apps,
                  count(DISTINCT metric_type) AS n_metrics FROM gate_app GROUP BY tenant, device_id),
r AS (SELECT tenant, device_id, count(*) AS res_rows FROM p10_res GROUP BY tenant, device_id)
SELECT tenant, device_id, coalesce(app_rows, 0) AS app_rows, coalesce(n_apps, 0) AS n_apps,
       coalesce(n_metrics, 0) AS n_metrics, coalesce(res_rows, 0) AS res_rows,
       coalesce(app_rows, 0) >= 20 AND coalesce(n_apps, 0) >= 1 AND coalesce(n_metrics, 0) >= 2
       AND coalesce(res_rows, 0) >= 10 AS input_ok
FROM a FULL JOIN r USING (tenant, device_id)"""))
def q_a13(spark, sf):
    """Processing input gate per entity (one entity reports cpu alone)."""
    return AG.input_gate(_quiet_app(spark, sf), _quiet_res(spark, sf))


@register("a13_impact_gate", sql_with(["impacts"], """
SELECT tenant, device_id, count(DISTINCT application) AS n_apps, count(DISTINCT resource_type) AS n_resources,
       count(DISTINCT application) >= 1 AND count(DISTINCT resource_type) >= 2 AND count(impact_score) > 0 AS impact_ok,
       min(impact_score) < 0 OR max(impact_score) > 2 AS range_warning
FROM impacts GROUP BY tenant, device_id"""))
def q_a13i(spark, sf):
    """Impact stage gate."""
    return AG.impact_gate(IP.impact_table(fx_points(spark, sf)))


@register("a13_feature_gate", sql_with(["features"], """
SELECT tenant, device_id, count(DISTINCT feature_name) AS n_features,
       count(DISTINCT feature_name) >= 5 AND count(value) > 0 AS feature_ok
FROM features GROUP BY tenant, device_id"""))
def q_a13f(spark, sf):
    """Feature stage gate."""
    from ..operators.features import feature_table
    return AG.feature_gate(feature_table(_app(spark, sf)))


@register("a14_feature_variability", sql_with(["features"], """
WITH p AS (SELECT tenant, device_id, feature_name, stddev_samp(value) AS std FROM features
           GROUP BY tenant, device_id, feature_name)
SELECT tenant, device_id, count(*) AS n_features, count(*) FILTER (WHERE std = 0) AS n_constant,
       CAST(count(*) FILTER (WHERE std = 0) AS DOUBLE) / count(*) > 0.8 AS low_variability
FROM p GROUP BY tenant, device_id"""))
def q_a14(spark, sf):
    """Share of constant features per entity."""
    from ..operators.features import feature_table
    return AG.feature_variability(feature_table(_app(spark, sf)))


@register("a20_applications", sql_with(["app_metrics"], """
SELECT DISTINCT tenant, device_id, application FROM app_metrics"""))
def q_a20(spark, sf):
    """Distinct applications per entity."""
    return AG.applications(_app(spark, sf))


@register("a22_config_gate", sql_with(["fx_configurations"], """
SELECT count(*) AS n_rows, count(*) >= 5 AS config_ok FROM fx_configurations
WHERE config_type IN ('time_alignment', 'collection', 'aggregation', 'excluded', 'model', 'alert')"""))
def q_a22(spark, sf):
    """Configuration completeness."""
    return CF.config_gate(TB.fx_configurations(spark, sf))


# ============================================================== forecast frame and alerts
@register("m8_step_minutes", sql_with(["ev"], """
SELECT event_id, CAST(user_id % 200 AS INTEGER) AS hours,
       CAST(CASE WHEN user_id % 200 <= 1 THEN 5 WHEN user_id % 200 <= 6 THEN 15 WHEN user_id % 200 <= 24 THEN 30
                 WHEN user_id % 200 <= 168 THEN 60 ELSE 60 END AS INTEGER) AS step_minutes FROM ev"""))
def q_m8(spark, sf):
    """M8: forecast step by horizon (hours taken from the event's user id)."""
    ev = events(spark, sf)
    h = (F.col("user_id") % 200).cast("int")
    return ev.select("event_id", h.alias("hours"), T.step_minutes(h).alias("step_minutes"))


@register("m9_forecast_grid", sql_with(["canon_res"], f"""
SELECT e.tenant, e.device_id, CAST(i AS INTEGER) AS step_index,
       date_trunc('hour', {NOW_SQL}) + to_minutes(CAST(floor(minute({NOW_SQL}) / 30) * 30 AS BIGINT))
         + INTERVAL 30 minute + to_minutes(CAST(i * 30 AS BIGINT)) AS target_time
FROM (SELECT DISTINCT tenant, device_id FROM canon_res) e, range(0, 48) t(i)"""))
def q_m9(spark, sf):
    """M9: 24 h forecast grid per entity (30-minute step, 48 points)."""
    return AL.forecast_grid(_canon(spark, sf), NOW, 24)


@register("w7_threshold_crossings", sql_with(["crossings"], "SELECT * FROM crossings"),
          ["threshold", "time_to_threshold", "current_value", "predicted_value"])
def q_w7(spark, sf):
    """First forecast at or above the limit per resource."""
    fc = AL.baseline_forecast(_canon(spark, sf), NOW, 24)
    return AL.threshold_crossings(fc, TB.thresholds(spark))


_msg = ("Resource threshold expected to be reached%s\nResource: %s\nThreshold: %.1f%%\nExpected at: %s\n"
        "Time to threshold: %.1f h\nCurrent usage: %.1f%%\nPredicted usage: %.1f%%\n\nPlease check and act now.")


@register("x1_alert_messages", sql_with(["crossings"], f"""
SELECT tenant, device_id, resource_type, crossing_time,
       printf('{_msg}',
              CASE WHEN coalesce(device_id, '') <> '' THEN ' (device: ' || device_id || ')' ELSE '' END,
              upper(resource_type), round(threshold * 10.0) / 10.0, strftime(crossing_time, '%Y-%m-%d %H:%M:00'),
              round(time_to_threshold * 10.0) / 10.0, round(current_value * 10.0) / 10.0,
              round(predicted_value * 10.0) / 10.0) AS message
FROM crossings"""))
def q_x1(spark, sf):
    """Alert message text."""
    fc = AL.baseline_forecast(_canon(spark, sf), NOW, 24)
    return AL.alert_messages(AL.threshold_crossings(fc, TB.thresholds(spark)))


@register("t3_pending_alerts", sql_with(["fx_alerts"], "SELECT * FROM fx_alerts WHERE NOT is_notified"),
          ["threshold", "time_to_threshold", "current_value", "predicted_value"])
def q_t3(spark, sf):
    """Alerts not yet notified, newest first."""
    return AL.pending_alerts(TB.fx_alerts(spark, sf))


@register("l4_mark_notified", sql_with(["fx_alerts"], f"""
SELECT tenant, device_id, resource_type, threshold, crossing_time, time_to_threshold, current_value, predicted_value,
       is_notified OR alert_level = 'critical' AS is_notified,
       CASE WHEN alert_level = 'critical' AND NOT is_notified THEN {NOW_SQL} ELSE notified_at END AS notified_at,
       alert_level, created_at, batch_id
FROM fx_alerts"""), ["threshold", "time_to_threshold", "current_value", "predicted_value"])
def q_l4(spark, sf):
    """L4: mark the critical pending alerts as notified."""
    al = TB.fx_alerts(spark, sf)
    sent = AL.pending_alerts(al).where(F.col("alert_level") == "critical")
    return AL.mark_notified(al, sent, NOW)


@register("w13_alert_cooldown", sql_with(["fx_alerts"], """
WITH RECURSIVE times AS (SELECT DISTINCT tenant, device_id, resource_type, crossing_time FROM fx_alerts),
sent AS (
  SELECT tenant, device_id, resource_type, min(crossing_time) AS crossing_time FROM times GROUP BY tenant, device_id, resource_type
  UNION ALL
  SELECT s.tenant, s.device_id, s.resource_type, min(t.crossing_time)
  FROM sent s JOIN times t ON s.tenant = t.tenant AND s.device_id = t.device_id AND s.resource_type = t.resource_type
   AND t.crossing_time >= s.crossing_time + INTERVAL 60 minute
  GROUP BY s.tenant, s.device_id, s.resource_type, s.crossing_time)
SELECT a.*, s.crossing_time IS NULL AS suppressed
FROM fx_alerts a LEFT JOIN sent s ON a.tenant = s.tenant AND a.device_id = s.device_id AND a.resource_type = s.resource_type
 AND a.crossing_time = s.crossing_time"""), ["threshold", "time_to_threshold", "current_value", "predicted_value"])
def q_w13(spark, sf):
    """Suppress alerts within 60 minutes of the last one sent."""
    return alert_cooldown(TB.fx_alerts(spark, sf), 60)


# ============================================================== accuracy
@register("a15_validate_predictions", sql_with(["pred_actual"], f"""
SELECT tenant, device_id, resource_type, count(*) AS count, avg(error) AS avg_error, max(error) AS max_error,
       min(error) AS min_error,
       coalesce(sum(CASE WHEN actual_value <> 0 THEN abs((actual_value - predicted_value) / actual_value) END), 0.0)
         / count(*) * 100.0 AS mape,
       avg(error) > 10 OR coalesce(sum(CASE WHEN actual_value <> 0 THEN abs((actual_value - predicted_value) / actual_value) END), 0.0)
         / count(*) * 100.0 > 15 AS degraded
FROM pred_actual WHERE actual_value IS NOT NULL AND prediction_time >= {NOW_SQL} - INTERVAL 24 hour
GROUP BY tenant, device_id, resource_type"""), ["avg_error", "max_error", "min_error", "mape"])
def q_a15(spark, sf):
    """Forecast validation per resource over 24 h."""
    return ACC.validate_predictions(_pred_actual(spark, sf), NOW)


@register("a16_prediction_performance", sql_with(["pred_actual"], f"""
WITH m AS (SELECT tenant, device_id, resource_type, avg(actual_value) AS mean FROM pred_actual
           WHERE actual_value IS NOT NULL GROUP BY tenant, device_id, resource_type)
SELECT p.tenant, p.device_id, p.resource_type, count(*) AS n, avg(error) AS mae, sqrt(avg(error * error)) AS rmse,
       1.0 - sum(error * error) / nullif(sum((actual_value - m.mean) * (actual_value - m.mean)), 0) AS r2
FROM pred_actual p JOIN m USING (tenant, device_id, resource_type)
WHERE actual_value IS NOT NULL AND prediction_time >= {NOW_SQL} - INTERVAL 24 hour
GROUP BY p.tenant, p.device_id, p.resource_type"""), ["mae", "rmse", "r2"])
def q_a16(spark, sf):
    """24 h MAE / RMSE / R^2 with the all-history mean."""
    return ACC.prediction_performance(_pred_actual(spark, sf), NOW)


@register("a17_degraded_resources", sql_with(["pred_actual"], f"""
SELECT tenant, device_id, resource_type, avg(error) AS avg_error, count(*) AS count, avg(error) > 10 AS degraded
FROM pred_actual WHERE actual_value IS NOT NULL AND prediction_time >= {NOW_SQL} - INTERVAL 24 hour
GROUP BY tenant, device_id, resource_type HAVING count(*) >= 5"""), ["avg_error"])
def q_a17(spark, sf):
    """Degraded resources (24 h mean error above 10, at least 5 rows)."""
    return ACC.degraded_resources(_pred_actual(spark, sf), NOW)


# t-0 was trained eight days before and forecasts well, t-1 just now and forecasts badly, t-9 was never trained
cte("perf_aged", ["fx_model_performance"], """
SELECT * REPLACE (CASE WHEN tenant = 't-0' THEN trained_at - INTERVAL 8 day ELSE trained_at END AS trained_at) FROM fx_model_performance""")
cte("pred_aged", ["pred_actual"], """
SELECT * REPLACE (CASE WHEN tenant = 't-0' THEN error / 100.0 ELSE error END AS error) FROM pred_actual""")
cte("fresh", ["perf_aged", "fx_points"], f"""
WITH e AS (SELECT DISTINCT tenant, device_id FROM fx_points UNION ALL SELECT 't-9', 'dev-9'),
l AS (SELECT tenant, device_id, max(trained_at) AS last_trained FROM perf_aged GROUP BY tenant, device_id),
a AS (SELECT e.tenant, e.device_id, l.last_trained,
             CAST(epoch_us({NOW_SQL}) - epoch_us(l.last_trained) AS DOUBLE) / 3600000000.0 AS age_hours
      FROM e LEFT JOIN l USING (tenant, device_id))
SELECT *, last_trained IS NULL OR age_hours > 168 AS stale FROM a""")


def _aged(spark, sf):
    """(performance, forecasts, entities) of the three cases."""
    old = F.col("tenant") == "t-0"
    perf = TB.fx_model_performance(spark, sf).withColumn("trained_at", F.when(old, F.col("trained_at") - F.make_dt_interval(F.lit(8))).otherwise(F.col("trained_at")))
    pred = _pred_actual(spark, sf).withColumn("error", F.when(old, F.col("error") / 100.0).otherwise(F.col("error")))
    points = fx_points(spark, sf).select("tenant", "device_id").distinct()
    never = points.limit(1).select(F.lit("t-9").alias("tenant"), F.lit("dev-9").alias("device_id"))
    return perf, pred, points.unionByName(never)


@register("a18_model_freshness", sql_with(["fresh"], "SELECT * FROM fresh"), ["age_hours"])
def q_a18(spark, sf):
    """Model age per entity (stale after 168 h): a stale, a fresh and an untrained entity."""
    perf, _, entities = _aged(spark, sf)
    return ACC.model_freshness(perf, entities, NOW)


@register("m13_retrain_decision", sql_with(["fresh", "pred_aged"], f"""
WITH d AS (SELECT tenant, device_id, max(CASE WHEN avg_error > 10 THEN 1 ELSE 0 END) AS deg FROM (
        SELECT tenant, device_id, resource_type, avg(error) AS avg_error FROM pred_aged
        WHERE actual_value IS NOT NULL AND prediction_time >= {NOW_SQL} - INTERVAL 24 hour
        GROUP BY tenant, device_id, resource_type HAVING count(*) >= 5) GROUP BY tenant, device_id),
o AS (SELECT f.*, coalesce(d.deg, 0) = 1 AS degraded,
             CAST(epoch_us({NOW_SQL}) - epoch_us(coalesce(f.last_trained, {NOW_SQL} - INTERVAL 30 day)) AS DOUBLE) / 3600000000.0 > 6 AS overdue
      FROM fresh f LEFT JOIN d USING (tenant, device_id))
SELECT tenant, device_id, stale, degraded, overdue, stale AND (degraded OR overdue) AS retrain FROM o"""))
def q_m13(spark, sf):
    """Retrain decision per entity: old and good, fresh and degraded, never trained."""
    perf, pred, entities = _aged(spark, sf)
    return ACC.retrain_decision(perf, pred, entities, NOW)


@register("m12_regression_metrics", sql_with(["pred_actual"], """
SELECT tenant, device_id, resource_type, count(*) AS n, avg(abs(predicted_value - actual_value)) AS mae,
       sqrt(avg((predicted_value - actual_value) * (predicted_value - actual_value))) AS rmse,
       CASE WHEN var_pop(actual_value) * count(*) = 0 THEN NULL ELSE
         1.0 - sum((predicted_value - actual_value) * (predicted_value - actual_value)) / (var_pop(actual_value) * count(*)) END AS r2
FROM pred_actual WHERE actual_value IS NOT NULL GROUP BY tenant, device_id, resource_type"""), ["mae", "rmse", "r2"])
def q_m12(spark, sf):
    """MAE / RMSE / R^2 per key on a scored table."""
    d = _pred_actual(spark, sf).where(F.col("actual_value").isNotNull())
    return AG.regression_metrics(d, [*K, "resource_type"], "actual_value", "predicted_value")


# ============================================================== health
cte("w8", ["canon_res", "fx_entities"], f"""
SELECT e.tenant, e.device_id,
  {', '.join(f"coalesce(arg_max(c.value, c.time) FILTER (WHERE c.resource_type = '{r}'), 0.0) AS {r}_percent" for r in RES3)}
FROM fx_entities e LEFT JOIN canon_res c ON c.tenant = e.tenant AND c.device_id = e.device_id
  AND c.time > {NOW_SQL} - INTERVAL 5 minute AND c.time <= {NOW_SQL}
GROUP BY e.tenant, e.device_id""")


@register("w8_latest_resources", sql_with(["w8"], "SELECT * FROM w8"), [f"{r}_percent" for r in RES3])
def q_w8(spark, sf):
    """Latest cpu / mem / disk in the last 5 minutes, zeros for a silent entity."""
    return HE.latest_resources(_recent_res(spark, sf, 5), NOW, entities=_entities(spark, sf))


cte("h1", ["w8"], """
WITH o AS (SELECT *, concat_ws(',', CASE WHEN cpu_percent > 80 THEN 'cpu' END, CASE WHEN mem_percent > 80 THEN 'mem' END,
                          CASE WHEN disk_percent > 85 THEN 'disk' END) AS over_limit FROM w8)
SELECT *, CASE WHEN over_limit <> '' THEN 'warning' ELSE 'healthy' END AS status FROM o""")


@register("h1_resource_status", sql_with(["h1"], "SELECT * FROM h1"), [f"{r}_percent" for r in RES3])
def q_h1(spark, sf):
    """H1: resource status from the latest values."""
    return HE.resource_status(HE.latest_resources(_recent_res(spark, sf, 5), NOW, entities=_entities(spark, sf)))


_h2_sql = f"""
WITH a AS (SELECT tenant, device_id, count(*) AS app_rows FROM app_metrics
           WHERE time > {NOW_SQL} - INTERVAL 60 minute AND time <= {NOW_SQL} GROUP BY tenant, device_id),
r AS (SELECT tenant, device_id, count(*) AS res_rows FROM resource_metrics
      WHERE time > {NOW_SQL} - INTERVAL 60 minute AND time <= {NOW_SQL} GROUP BY tenant, device_id),
j AS (SELECT tenant, device_id, coalesce(app_rows, 0) AS app_rows, coalesce(res_rows, 0) AS res_rows
      FROM fx_entities LEFT JOIN a USING (tenant, device_id) LEFT JOIN r USING (tenant, device_id))
SELECT *, CASE WHEN app_rows < 10 AND res_rows < 10 THEN 'critical'
               WHEN app_rows < 10 OR res_rows < 10 THEN 'warning' ELSE 'healthy' END AS status FROM j"""
cte("h2", ["app_metrics", "resource_metrics", "fx_entities"], _h2_sql)


@register("h2_collection_status", sql_with(["h2"], "SELECT * FROM h2"))
def q_h2(spark, sf):
    """H2: data collection status over the last hour."""
    return HE.collection_status(_recent_app(spark, sf, 60), _recent_res(spark, sf, 60), NOW, entities=_entities(spark, sf))


cte("t2", ["fx_model_performance"], """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY tenant, device_id
                               ORDER BY trained_at DESC, application, resource_type, model_type) AS rank
  FROM fx_model_performance) WHERE rank <= 10""")


@register("t2_recent_models", sql_with(["t2"], """
SELECT *, r2_score < 0.5 OR mae > 20 AS poor FROM t2"""), ["mae", "rmse", "r2_score"])
def q_t2(spark, sf):
    """Last 10 model rows per entity with the poor-model flag."""
    return HE.recent_models(TB.fx_model_performance(spark, sf)).withColumn("rank", F.col("rank").cast("long"))


cte("h3", ["t2", "fx_entities"], f"""
WITH g AS (
  SELECT tenant, device_id, count(*) AS model_count, max(trained_at) AS latest_training,
         array_to_string(list_sort(list(application || '-' || resource_type)
                                   FILTER (WHERE r2_score < 0.5 OR mae > 20)), ', ') AS poor_models,
         count(*) FILTER (WHERE r2_score < 0.5 OR mae > 20) AS n_poor
  FROM t2 GROUP BY tenant, device_id)
SELECT tenant, device_id, coalesce(model_count, 0) AS model_count, latest_training,
       CAST(epoch_us({NOW_SQL}) - epoch_us(latest_training) AS DOUBLE) / 3600000000.0 AS age_hours, coalesce(n_poor, 0) AS n_poor,
       coalesce(poor_models, '') AS poor_models,
       CASE WHEN model_count IS NULL OR CAST(epoch_us({NOW_SQL}) - epoch_us(latest_training) AS DOUBLE) / 3600000000.0 > 168 OR n_poor > 0
            THEN 'warning' ELSE 'healthy' END AS status
FROM fx_entities LEFT JOIN g USING (tenant, device_id)""")


@register("h3_model_status", sql_with(["h3"], "SELECT * FROM h3"), ["age_hours"])
def q_h3(spark, sf):
    """H3: model age and poor-model list per entity."""
    return HE.model_status(TB.fx_model_performance(spark, sf), NOW, entities=_entities(spark, sf))


cte("h4", ["pred_actual", "fx_entities"], f"""
WITH r AS (SELECT tenant, device_id, max(prediction_time) AS latest_prediction, count(*) AS prediction_count,
             avg(error) AS avg_error FROM pred_actual
      WHERE prediction_time > {NOW_SQL} - INTERVAL 120 minute AND prediction_time <= {NOW_SQL} GROUP BY tenant, device_id)
SELECT e.tenant, e.device_id, r.latest_prediction, coalesce(r.prediction_count, 0) AS prediction_count, r.avg_error,
       CASE WHEN r.latest_prediction IS NULL THEN 'warning'
            WHEN coalesce(r.prediction_count, 0) < 1.0 OR coalesce(r.avg_error, 0.0) > 15 THEN 'warning'
            ELSE 'healthy' END AS status
FROM fx_entities e LEFT JOIN r USING (tenant, device_id)""")


@register("h4_prediction_status", sql_with(["h4"], "SELECT * FROM h4"), ["avg_error"])
def q_h4(spark, sf):
    """H4: forecast status over the last 2 hours."""
    return HE.prediction_status(_pred_actual(spark, sf), NOW, entities=_entities(spark, sf))


cte("a21", ["fx_jobs", "fx_entities"], f"""
SELECT tenant, device_id, coalesce(jobs, 0) AS jobs, coalesce(success_pct, 0.0) AS success_pct,
       coalesce(avg_duration_s, 0.0) AS avg_duration_s, coalesce(failure_rate, 0.0) AS failure_rate,
       coalesce(status, 'critical') AS status
FROM fx_entities LEFT JOIN (
SELECT tenant, device_id, count(*) AS jobs,
       avg(CASE WHEN status = 'completed' THEN 1.0 ELSE 0.0 END) * 100.0 AS success_pct,
       avg(CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1000000.0) AS avg_duration_s,
       avg(CASE WHEN status = 'failed' THEN 1.0 ELSE 0.0 END) AS failure_rate,
       CASE WHEN avg(CASE WHEN status = 'completed' THEN 1.0 ELSE 0.0 END) * 100.0 > 80 THEN 'healthy'
            WHEN avg(CASE WHEN status = 'completed' THEN 1.0 ELSE 0.0 END) * 100.0 > 50 THEN 'warning'
            ELSE 'critical' END AS status
FROM fx_jobs WHERE start_time >= {NOW_SQL} - INTERVAL 24 hour GROUP BY tenant, device_id) USING (tenant, device_id)""")


@register("a21_job_stats", sql_with(["a21"], "SELECT * FROM a21"), ["success_pct", "avg_duration_s", "failure_rate"])
def q_a21(spark, sf):
    """Job statistics per entity over 24 h."""
    return HE.job_stats(TB.fx_jobs(spark, sf), NOW, entities=_entities(spark, sf))


cte("h5", ["fx_jobs", "fx_entities"], f"""
WITH t AS (SELECT tenant, device_id, job_type, count(*) AS jobs,
                  avg(CASE WHEN status = 'completed' THEN 1.0 ELSE 0.0 END) * 100.0 AS success_pct,
                  avg(CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1000000.0) AS avg_duration_s
           FROM fx_jobs WHERE start_time >= {NOW_SQL} - INTERVAL 24 hour GROUP BY tenant, device_id, job_type),
g AS (SELECT tenant, device_id, CAST(sum(jobs) AS BIGINT) AS jobs,
             count(*) FILTER (WHERE success_pct < 70.0 OR avg_duration_s > 300) AS bad_types,
             min(success_pct) AS worst_success_pct, max(avg_duration_s) AS slowest_type_s FROM t GROUP BY tenant, device_id)
SELECT tenant, device_id, coalesce(jobs, 0) AS jobs, coalesce(bad_types, 0) AS bad_types, worst_success_pct, slowest_type_s,
       CASE WHEN coalesce(bad_types, 0) > 0 THEN 'warning' ELSE 'healthy' END AS status
FROM fx_entities LEFT JOIN g USING (tenant, device_id)""")


@register("h5_job_status", sql_with(["h5"], "SELECT * FROM h5"), ["worst_success_pct", "slowest_type_s"])
def q_h5(spark, sf):
    """H5: job status (a job type under 70 % success or over 300 s on average -> warning)."""
    return HE.job_status(TB.fx_jobs(spark, sf), NOW, entities=_entities(spark, sf))


@register("h6_overall_status", sql_with(["h1", "h2", "h3", "h4", "h5"], """
WITH u AS (SELECT tenant, device_id, status FROM h1 UNION ALL SELECT tenant, device_id, status FROM h2 UNION ALL SELECT tenant, device_id, status FROM h3
           UNION ALL SELECT tenant, device_id, status FROM h4 UNION ALL SELECT tenant, device_id, status FROM h5)
SELECT tenant, device_id, count(*) AS components,
       ['healthy', 'warning', 'critical'][max(CASE WHEN status = 'critical' THEN 2 WHEN status = 'warning' THEN 1
                                                    ELSE 0 END) + 1] AS overall_status
FROM u GROUP BY tenant, device_id"""))
def q_h6(spark, sf):
    """H6: worst component status per entity."""
    ents = _entities(spark, sf)
    return HE.overall_status({
        "system": HE.resource_status(HE.latest_resources(_recent_res(spark, sf, 5), NOW, entities=ents)),
        "collection": HE.collection_status(_recent_app(spark, sf, 60), _recent_res(spark, sf, 60), NOW, entities=ents),
        "model": HE.model_status(TB.fx_model_performance(spark, sf), NOW, entities=ents),
        "prediction": HE.prediction_status(_pred_actual(spark, sf), NOW, entities=ents),
        "jobs": HE.job_status(TB.fx_jobs(spark, sf), NOW, entities=ents)})


@register("h7_entity_summary", sql_with(["fx_points"], f"""
WITH d AS (SELECT DISTINCT tenant, device_id FROM fx_points
           WHERE origin = 'server_data' AND ts >= {NOW_SQL} - INTERVAL 7 day AND ts < {NOW_SQL})
SELECT tenant, count(DISTINCT device_id) AS devices, min(device_id) AS first_device, max(device_id) AS last_device
FROM d GROUP BY tenant"""))
def q_h7(spark, sf):
    """H7: devices per tenant."""
    return HE.entity_summary(PT.discover_entities(fx_points(spark, sf), NOW, 7))


# ============================================================== retention
RET_NOW = "2024-01-08 00:30:00"
RET_SQL = "TIMESTAMP '2024-01-08 00:30:00'"


def _pruned(spark, rows, ts, keep):
    """``rows`` stored by the hour of ``ts``, pruned in place, read back."""
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    rows.withColumn("hour", F.date_format(ts, "yyyyMMddHH")).write.partitionBy("hour").parquet(path)
    RT.prune(spark, path, keep, ["hour"])
    return spark.read.parquet(path).select(*rows.columns)


@register("l1_retain_predictions", sql_with(["fx_predictions"], f"""
SELECT * FROM fx_predictions WHERE prediction_time >= {RET_SQL} - INTERVAL 7 day"""),
          ["predicted_value", "actual_value", "error", "confidence_score"])
def q_l1(spark, sf):
    """L1: drop forecasts made more than 7 days ago from a stored table, read back."""
    return _pruned(spark, _pred(spark, sf), "prediction_time", lambda t: RT.retain(t, "prediction_time", RET_NOW, 7))


@register("l2_prune_predictions", sql_with(["fx_predictions"], f"""
SELECT * EXCLUDE (latest) FROM (
  SELECT *, max(prediction_time) OVER (PARTITION BY tenant, coalesce(device_id, ''), target_time, resource_type) AS latest
  FROM fx_predictions WHERE prediction_time >= {RET_SQL} - INTERVAL 7 day)
WHERE NOT (target_time < {RET_SQL} - INTERVAL 1 day) OR prediction_time >= latest"""),
          ["predicted_value", "actual_value", "error", "confidence_score"])
def q_l2(spark, sf):
    """L2: age cut then superseded cut of a stored table, read back."""
    return _pruned(spark, _pred(spark, sf), "target_time", lambda t: RT.prune_predictions(t, RET_NOW))


@register("l3_retain_performance", sql_with(["fx_model_performance"], """
SELECT * FROM fx_model_performance WHERE trained_at >= TIMESTAMP '2024-01-04 02:00:00' - INTERVAL 3 day"""),
          ["mae", "rmse", "r2_score"])
def q_l3(spark, sf):
    """L3: drop model performance older than 3 days from a stored table, read back."""
    return _pruned(spark, TB.fx_model_performance(spark, sf), "trained_at", lambda t: RT.retain(t, "trained_at", "2024-01-04 02:00:00", 3))


@register("a19_retention_stats", sql_with(["fx_predictions"], """
SELECT count(*) AS total_records, min(prediction_time) AS oldest, max(prediction_time) AS latest,
       count(DISTINCT CAST(target_time AS DATE)) AS unique_days FROM fx_predictions"""))
def q_a19(spark, sf):
    """Prediction table statistics."""
    return RT.retention_stats(_pred(spark, sf))


@register("a19_performance_stats", sql_with(["fx_model_performance"], """
SELECT count(*) AS total_records, min(trained_at) AS oldest, max(trained_at) AS latest,
       count(DISTINCT application) AS unique_apps FROM fx_model_performance"""))
def q_a19p(spark, sf):
    """Model performance table statistics."""
    return RT.performance_retention_stats(TB.fx_model_performance(spark, sf))


# ============================================================== config
@register("w9_effective_config", sql_with(["eff_config"], "SELECT * FROM eff_config"))
def q_w9(spark, sf):
    """Newest active configuration per (tenant, type, key)."""
    return CF.effective_config(TB.fx_configurations(spark, sf))


@register("x2_decode_aggregation", sql_with(["agg_config"], "SELECT * FROM agg_config"))
def q_x2(spark, sf):
    """Aggregation config as (method, reason)."""
    return CF.decode_aggregation_config(TB.fx_configurations(spark, sf))


@register("x3_upsert_config", sql_with(["fx_configurations"], """
WITH ch AS (
  SELECT id + 1000000000 AS id, tenant, server_no, config_type, config_key, config_value || '0' AS config_value,
         is_active, updated_at FROM fx_configurations WHERE config_type = 'model' AND id % 5 = 0),
u AS (SELECT *, 0 AS src FROM fx_configurations UNION ALL SELECT *, 1 AS src FROM ch),
r AS (SELECT *, max(src) OVER k AS has_change, min(CASE WHEN src = 0 THEN id END) OVER k AS old_id,
             row_number() OVER (PARTITION BY tenant, coalesce(server_no, -1), config_type, config_key
                                ORDER BY src DESC, id DESC) AS rn
      FROM u WINDOW k AS (PARTITION BY tenant, coalesce(server_no, -1), config_type, config_key))
SELECT CASE WHEN src = 1 THEN coalesce(old_id, id) ELSE id END AS id, tenant, server_no, config_type, config_key,
       config_value, is_active, updated_at
FROM r WHERE has_change = 0 OR rn = 1"""))
def q_x3(spark, sf):
    """Upsert of changed 'model' settings (null server compares equal)."""
    cfg = TB.fx_configurations(spark, sf)
    ch = cfg.where((F.col("config_type") == "model") & (F.col("id") % 5 == 0)).select(
        (F.col("id") + F.lit(1000000000)).alias("id"), "tenant", "server_no", "config_type", "config_key",
        F.concat(F.col("config_value"), F.lit("0")).alias("config_value"), "is_active", "updated_at")
    return CF.upsert_config(cfg, ch)


# ============================================================== sets and series
@register("u3_missing_resources", sql_with(["resource_metrics"], """
SELECT tenant, device_id, array_to_string(list_filter(['cpu', 'mem', 'disk'],
         lambda x: NOT list_contains(list(DISTINCT resource_type), x)), ',') AS missing
FROM resource_metrics GROUP BY tenant, device_id"""))
def q_u3(spark, sf):
    """Required resources not seen per entity."""
    from ..operators.ranking import missing_resources
    return missing_resources(_res(spark, sf))


@register("w5_ffill", sql_with(["canon_res"], """
WITH b AS (SELECT tenant, device_id, resource_type, time_bucket(INTERVAL 5 minute, time) AS time, avg(value) AS value
           FROM canon_res GROUP BY tenant, device_id, resource_type, time_bucket(INTERVAL 5 minute, time)),
bd AS (SELECT tenant, device_id, min(time) AS g0, max(time) AS g1 FROM b GROUP BY tenant, device_id),
g AS (SELECT s.tenant, s.device_id, s.resource_type, unnest(generate_series(bd.g0, bd.g1, INTERVAL 5 minute)) AS time
      FROM (SELECT DISTINCT tenant, device_id, resource_type FROM b) s JOIN bd USING (tenant, device_id))
SELECT g.tenant, g.device_id, g.resource_type, g.time,
       coalesce(last_value(b.value IGNORE NULLS) OVER (PARTITION BY g.tenant, g.device_id, g.resource_type ORDER BY g.time
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS value
FROM g LEFT JOIN b USING (tenant, device_id, resource_type, time)"""), ["value"])
def q_w5(spark, sf):
    """5-minute grid, forward fill, then 0."""
    b = AG.resample_mean(_canon(spark, sf), "5 minutes", [*K, "resource_type"])
    return SE.ffill(b, ["resource_type"], step_minutes=5)


@register("w6_overlap_slice", sql_with(["app_metrics", "canon_res"], """
WITH a AS (SELECT tenant, device_id, min(time) AS a0, max(time) AS a1 FROM app_metrics GROUP BY ALL),
b AS (SELECT tenant, device_id, min(time) AS b0, max(time) AS b1 FROM canon_res GROUP BY ALL)
SELECT tenant, device_id, greatest(a0, b0) AS slice_start, least(a1, b1) AS slice_end
FROM a JOIN b USING (tenant, device_id) WHERE greatest(a0, b0) < least(a1, b1)"""))
def q_w6(spark, sf):
    """Overlap of the app and resource spans."""
    return SE.overlap_slice(_app(spark, sf), _canon(spark, sf))


@register("w10_dedup_last", sql_with(["features"], """
WITH d AS (SELECT *, 0 AS ord FROM features UNION ALL
           SELECT tenant, device_id, time, application, feature_name, value + 1.0, window_size, 1
           FROM features WHERE feature_name LIKE '%\\_mean\\_5min' ESCAPE '\\')
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY tenant, device_id, time, application, feature_name ORDER BY ord DESC) AS rn
  FROM d) WHERE rn = 1"""), ["value"])
def q_w10(spark, sf):
    """Keep-last dedup on (time, application, feature) over features with planted repeats."""
    from ..operators.features import feature_table
    f = feature_table(_app(spark, sf)).withColumn("ord", F.lit(0))
    dup = f.where(F.col("feature_name").endswith("_mean_5min")).withColumn("value", F.col("value") + F.lit(1.0)) \
           .withColumn("ord", F.lit(1))
    return SE.dedup_last(f.unionByName(dup), [*K, "time", "application", "feature_name"], ["ord"])


@register("w11_chrono_split", sql_with(["sys_train"], """
SELECT *, row_number() OVER (PARTITION BY tenant, device_id ORDER BY time)
          <= floor(count(*) OVER (PARTITION BY tenant, device_id) * 0.8) AS is_train
FROM sys_train"""), AG.STAT_COLUMNS + ["hour", "day_of_week", "is_weekend", "cpu", "mem", "disk"])
def q_w11(spark, sf):
    """Chronological 80 / 20 split of the system training rows."""
    from ..operators.features import system_training_set
    st = system_training_set(*IP.scores_and_spans(fx_points(spark, sf)), _res(spark, sf))
    return SE.chrono_split(st, K, "time", 0.8)


@register("w12_ts_folds", sql_with(["sys_train"], """
WITH b AS (SELECT tenant, device_id, time, row_number() OVER (PARTITION BY tenant, device_id ORDER BY time) - 1 AS i,
                  count(*) OVER (PARTITION BY tenant, device_id) AS n FROM sys_train),
f AS (SELECT b.*, CAST(fold AS INTEGER) AS fold, n // 6 AS t FROM b, range(0, 5) r(fold))
SELECT tenant, device_id, time, fold,
       CASE WHEN i < n - (5 - fold) * t THEN 'train' ELSE 'test' END AS role
FROM f WHERE t > 0 AND i < n - (5 - fold) * t + t"""))
def q_w12(spark, sf):
    """Five expanding time-series folds over the system training rows."""
    from ..operators.features import system_training_set
    st = system_training_set(*IP.scores_and_spans(fx_points(spark, sf)), _res(spark, sf))
    return SE.ts_folds(st.select(*K, "time"), K, "time", 5)


@register("t1_top_features", sql_with(["features"], """
SELECT * FROM (
  SELECT tenant, device_id, application, feature_name, importance,
         row_number() OVER (PARTITION BY tenant, device_id, application ORDER BY importance DESC, feature_name) AS rank
  FROM (SELECT tenant, device_id, application, feature_name, stddev_samp(value) AS importance
        FROM features GROUP BY tenant, device_id, application, feature_name)
  WHERE importance IS NOT NULL) WHERE rank <= 10"""), ["importance"])
def q_t1(spark, sf):
    """Top-10 features per application by spread (importance stand-in)."""
    from ..operators.features import feature_table
    from ..operators.ranking import top_features
    f = feature_table(_app(spark, sf))
    imp = f.groupBy(*K, "application", "feature_name").agg(F.stddev_samp("value").alias("importance"))
    return top_features(imp.where(F.col("importance").isNotNull()), [*K, "application"], 10)


@register("t5_active_tenants", sql_with(["fx_points"], """
SELECT tenant, registered_at, rank FROM (
  SELECT tenant, registered_at,
         row_number() OVER (ORDER BY CASE WHEN tenant = 't-1' THEN 0 ELSE 1 END, registered_at, tenant) AS rank
  FROM (SELECT tenant, min(ts) AS registered_at FROM fx_points GROUP BY tenant)) WHERE rank <= 5"""))
def q_t5(spark, sf):
    """T5: first 5 active tenants by registration, the preferred one first."""
    from ..operators.ranking import active_tenants
    reg = fx_points(spark, sf).groupBy("tenant").agg(F.min("ts").alias("registered_at")) \
        .withColumn("is_active", F.lit(True))
    return active_tenants(reg, 5, "t-1")


# ============================================================== more sources / series / baseline
@register("a1_window_mean", sql_with(["fx_points"], """
SELECT tenant, device_id, location, gateway, measurement,
       time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute AS time, avg(value) AS value
FROM fx_points WHERE origin = 'server_data' AND field = 'value' GROUP BY tenant, device_id, location, gateway, measurement, time_bucket(INTERVAL 1 minute, ts)"""),
          ["value"])
def q_a1(spark, sf):
    """A1: one-minute tumbling mean per raw series, labelled by window end."""
    p = PT.scan_points(fx_points(spark, sf)).where(F.col("field") == "value")
    return AG.window_mean(p, "1 minute", [*K, "location", "gateway", "measurement"], ts="ts", value="value")


@register("w3_minute_grid", sql_with(["app_g"], """
SELECT tenant, device_id, application, metric_type, time, value FROM app_g"""), ["value"])
def q_w3(spark, sf):
    """Every application metric on the entity's whole minute grid (value or null)."""
    return SE.minute_grid(_app(spark, sf), ["application", "metric_type"])


@register("m14_linear_baseline", sql_with(["pairs", "common"], """
WITH p AS (SELECT * FROM pairs WHERE (tenant, device_id) IN (SELECT (tenant, device_id) FROM common)),
s AS (SELECT tenant, device_id, application, metric_type, resource_type, count(*) AS n,
             covar_pop(x, y) AS c, var_pop(x) AS vx, var_pop(y) AS vy, avg(x) AS mx, avg(y) AS my
      FROM p GROUP BY tenant, device_id, application, metric_type, resource_type)
SELECT tenant, device_id, application, metric_type, resource_type, n,
       CASE WHEN vx = 0 THEN NULL ELSE c / vx END AS slope,
       my - (CASE WHEN vx = 0 THEN NULL ELSE c / vx END) * mx AS intercept,
       CASE WHEN vy = 0 OR vx = 0 THEN NULL ELSE c * c / (vx * vy) END AS r2
FROM s"""), ["slope", "intercept", "r2"])
def q_m14(spark, sf):
    """Closed-form least squares resource ~ app metric on the gap-filled grids."""
    return IP.baseline_table(fx_points(spark, sf))


@register("s8_snapshot_reuse", sql_with(["impacts"], f"""
WITH p AS (SELECT count(*) AS n_rows, count(DISTINCT application) AS n_application, count(DISTINCT resource_type) AS n_resource_type
           FROM impacts)
SELECT asked_at, created_at, reused, n_rows, n_application, n_resource_type
FROM p, (VALUES ({NOW_SQL}, {NOW_SQL}, false), ({NOW_SQL} + INTERVAL 1 hour, {NOW_SQL}, true),
                ({NOW_SQL} + INTERVAL 7 hour, {NOW_SQL} + INTERVAL 7 hour, false)) v(asked_at, created_at, reused)"""))
def q_s8s(spark, sf):
    """A snapshot is written, found fresh one hour later and reused, and rebuilt after seven (TTL 6 h)."""
    import os
    import uuid

    from ..session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), "snapshots", f"impacts-{uuid.uuid4().hex}")
    out = None
    for asked in (NOW, "2024-01-01 05:00:00", "2024-01-01 11:00:00"):
        snap = TB.snapshot(spark, path, lambda: IP.impact_table(fx_points(spark, sf)), asked, ["application", "resource_type"], 6.0,
                           partition_by=["tenant"])
        row = snap.rows.agg(F.count(F.lit(1)).alias("n_seen")).select(
            T.ts_lit(asked).alias("asked_at"), F.lit(snap.meta["created_at"]).cast("timestamp").alias("created_at"),
            F.lit(snap.reused).alias("reused"), F.col("n_seen").alias("n_rows"),
            *[F.lit(snap.meta[c]).cast("long").alias(c) for c in ("n_application", "n_resource_type")])
        out = row if out is None else out.unionByName(row)
    return out


@register("s9_table_roundtrip", sql_with(["fx_predictions"], "SELECT * FROM fx_predictions"),
          ["predicted_value", "actual_value", "error", "confidence_score"])
def q_s9(spark, sf):
    """Append the forecasts to a parquet table (partitioned by tenant) and read it back."""
    import os
    import uuid

    from ..session import ensure_checkpoint_dir
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex[:8])
    TB.append_table(_pred(spark, sf), root, "predictions", partition_by=["tenant"])
    return TB.read_table(spark, root, "predictions").select(*TB.PREDICTION_COLUMNS)


# Setup defaults for keys a tenant may not have configured.
CONFIG_DEFAULTS = [("model", "retrain_threshold_hours", "24"), ("model", "min_training_records", "100"),
                   ("alert", "cpu_threshold", "80.0"), ("alert", "memory_threshold", "80.0"),
                   ("alert", "disk_threshold", "85.0"), ("alert", "notification_cooldown_minutes", "60")]
_dflt_sql = ", ".join(f"('{t}', '{k}', '{v}')" for t, k, v in CONFIG_DEFAULTS)


@register("w9_effective_config_defaults", sql_with(["eff_config", "fx_configurations"], f"""
WITH d AS (SELECT t.tenant, v.config_type, v.config_key, v.config_value
           FROM (SELECT DISTINCT tenant FROM fx_configurations) t, (VALUES {_dflt_sql}) v(config_type, config_key, config_value))
SELECT tenant, config_type, config_key, config_value, id FROM eff_config
UNION ALL
SELECT d.tenant, d.config_type, d.config_key, d.config_value, CAST(NULL AS BIGINT) AS id FROM d
WHERE NOT EXISTS (SELECT 1 FROM eff_config e WHERE e.tenant = d.tenant AND e.config_type = d.config_type
                  AND e.config_key = d.config_key)"""))
def q_w9d(spark, sf):
    """Effective configuration with setup defaults for absent keys."""
    return CF.effective_config(TB.fx_configurations(spark, sf), CONFIG_DEFAULTS)


@register("a5_impact_scores_hourly", sql_with(["pairs", "common"], """
WITH c AS (
  SELECT tenant, device_id, time_bucket(INTERVAL 1 hour, time) AS period, application, metric_type, resource_type,
         CASE WHEN isnan(corr(x, y)) THEN NULL ELSE corr(x, y) END AS correlation
  FROM pairs WHERE (tenant, device_id) IN (SELECT (tenant, device_id) FROM common)
  GROUP BY tenant, device_id, time_bucket(INTERVAL 1 hour, time), application, metric_type, resource_type)
SELECT tenant, device_id, period, application, resource_type, avg(abs(correlation)) AS impact_score,
       count(*) AS n_metrics, 'correlation' AS calculation_method
FROM c WHERE correlation IS NOT NULL GROUP BY tenant, device_id, period, application, resource_type"""),
          ["impact_score"])
def q_a5h(spark, sf):
    """A5 with a period: one impact score per hour (time-varying impact for the system model)."""
    return IP.periodic_impact_scores(fx_points(spark, sf), "1 hour")
