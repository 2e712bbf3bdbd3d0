"""Registered streaming queries.

The events come in three deliveries, with late ones among them; a query runs
its job after each delivery, from one checkpoint, and returns the written output
as a table.  The DuckDB twin applies the watermark rules: the watermark after
a delivery is ``max(event time) - delay`` of all rows so far; a row comes too
late if the window it belongs to ended at or before the watermark of the
deliveries before its own; a window is emitted once the last watermark has
passed its end.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import tables as TB
from ..sources.fixtures import ARRIVAL_MINUTES, ARRIVALS, deliver, delivered, fx_points_stream
from ..streaming import jobs as J
from .oracle import CTES, cte, sql_with
from .registry import register

# fx_points with the delivery each point comes with
cte("st_points", ["ev"], CTES["fx_points"][0].replace("SELECT ts,", f"""SELECT least({ARRIVALS - 1},
       least({ARRIVALS - 1}, greatest(0, (epoch_us(ts) - 1704067200000000) // {ARRIVAL_MINUTES * 60_000_000}))
       + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) AS arrival, ts,"""))
cte("st_src", ["st_points"], "SELECT * FROM st_points WHERE origin = 'server_data' AND field = 'value'")


def watermarks(name: str, src: str) -> None:
    """(arrival, wm): the watermark a delivery meets, and one more for what is emitted in the end."""
    cte(name, [src], f"""
SELECT d.arrival, coalesce((SELECT max(ts) FROM {src} s WHERE s.arrival < d.arrival) - INTERVAL 10 minute, TIMESTAMP '1970-01-01') AS wm
FROM (SELECT unnest(generate_series(0, {ARRIVALS})) AS arrival) d""")


def minutes(name: str, src: str, wm: str) -> None:
    """One-minute means of the rows that came in time, of the windows that are closed in the end."""
    cte(name, [src, wm], f"""
SELECT tenant, device_id, location, gateway, measurement,
       time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute AS time, avg(value) AS value, count(*) AS n
FROM {src} JOIN {wm} USING (arrival)
WHERE time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute > wm
GROUP BY tenant, device_id, location, gateway, measurement, time_bucket(INTERVAL 1 minute, ts)
HAVING time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute <= (SELECT max(wm) FROM {wm})""")


_PICK = """((gateway = 'cpu' AND measurement = 'usage_idle') OR (gateway = 'mem' AND measurement = 'used_percent')
     OR (gateway = 'disk' AND measurement = 'used_percent'))"""
watermarks("st_wm", "st_src")
minutes("st_r1", "st_src", "st_wm")
cte("st_app", ["st_src"], "SELECT * FROM st_src WHERE location = 'service_resource_data'")
watermarks("st_wm_app", "st_app")
cte("st_res", ["st_src"], f"SELECT * FROM st_src WHERE location = 'server_resource_data' AND {_PICK}")
watermarks("st_wm_res", "st_res")
minutes("st_res_minutes", "st_res", "st_wm_res")


def _run(spark, sf, job, name, repeats=False):
    return J.run_in_arrivals(spark, deliver(spark, sf, repeats), ARRIVALS, delivered(spark, sf), job, name)


@register("r1_stream_window_mean", sql_with(["st_r1"], "SELECT * FROM st_r1"), ["value"])
def q_r1(spark, sf):
    """Streaming one-minute mean per series with a 10-minute watermark, late rows among three deliveries."""
    return _run(spark, sf, J.stream_window_mean, "r1")


@register("r2_stream_rolling", sql_with(["st_app", "st_wm_app"], """
WITH x AS (SELECT s.*, w.w, unnest(generate_series(time_bucket(INTERVAL 5 minute, ts) - to_minutes(w.w - 5),
                                             time_bucket(INTERVAL 5 minute, ts), INTERVAL 5 minute)) AS ws
      FROM st_app s JOIN st_wm_app m USING (arrival), (VALUES (5), (15), (30), (60)) w(w)
      WHERE time_bucket(INTERVAL 5 minute, ts) + INTERVAL 5 minute > wm)
SELECT tenant, device_id, gateway AS application, measurement AS metric_type, ws AS window_start,
       ws + to_minutes(w) AS time, CAST(w AS INTEGER) AS window_minutes, avg(value) AS mean,
       stddev_samp(value) AS std, max(value) AS max, min(value) AS min, count(*) AS n
FROM x GROUP BY tenant, device_id, gateway, measurement, ws, w
HAVING ws + to_minutes(w) <= (SELECT max(wm) FROM st_wm_app)"""), ["mean", "std", "max", "min"])
def q_r2(spark, sf):
    """R2: sliding 5/15/30/60-minute statistics every 5 minutes, two chained aggregations in one stream."""
    return _run(spark, sf, J.stream_rolling, "r2")


cte("st_twice", ["st_points"], f"""
SELECT * FROM st_points
UNION ALL SELECT * REPLACE (least(arrival + 1, {ARRIVALS - 1}) AS arrival) FROM st_points WHERE minute(ts) % 7 = 0""")
watermarks("st_wm_twice", "st_twice")


@register("r3_stream_dedup", sql_with(["st_twice", "st_wm_twice"], """
SELECT DISTINCT tenant, device_id, location, gateway, measurement, field, ts
FROM st_twice JOIN st_wm_twice USING (arrival) WHERE ts > date_trunc('millisecond', wm)"""))
def q_r3(spark, sf):
    """Duplicate removal on (series, ts) within the watermark; points of every seventh minute come again with the next delivery."""
    out = _run(spark, sf, J.stream_dedup, "r3", repeats=True)
    return out.select("tenant", "device_id", "location", "gateway", "measurement", "field", "ts")


@register("r4_stream_alerts", sql_with(["st_src", "thresholds"], f"""
SELECT s.tenant, s.device_id, s.ts, s.gateway AS resource_type,
       CASE WHEN s.gateway = 'cpu' THEN 100.0 - s.value ELSE s.value END AS value, t.threshold
FROM st_src s JOIN thresholds t ON s.gateway = t.resource_type
WHERE s.location = 'server_resource_data' AND {_PICK}
  AND CASE WHEN s.gateway = 'cpu' THEN 100.0 - s.value ELSE s.value END > t.threshold"""), ["value", "threshold"])
def q_r4(spark, sf):
    """Live utilisation above its limit."""
    return J.run_available(spark, J.stream_alerts(fx_points_stream(spark, sf), TB.thresholds(spark)), "r4")


@register("r5_stream_attach_actuals", sql_with(["st_res_minutes", "fx_predictions"], f"""
WITH r AS (
  SELECT tenant, device_id, gateway AS resource_type, time AS target_time,
         CASE WHEN gateway = 'cpu' THEN 100.0 - value ELSE value END AS actual_value
  FROM st_res_minutes)
SELECT r.tenant, r.device_id, r.resource_type, r.target_time, r.actual_value, p.prediction_time,
       p.predicted_value, p.model_version, p.confidence_score, p.batch_id,
       abs(p.predicted_value - r.actual_value) AS error
FROM r JOIN fx_predictions p ON r.tenant = p.tenant AND r.device_id = p.device_id
 AND r.resource_type = p.resource_type AND r.target_time = p.target_time
WHERE p.actual_value IS NULL AND second(p.target_time) = 0"""),
          ["actual_value", "predicted_value", "confidence_score", "error"])
def q_r5(spark, sf):
    """Stored forecasts meet their actuals as resource minutes close, batch by batch."""
    base = J.stream_base(spark, "r5")
    store = f"{base}/predictions"
    TB.store_predictions(TB.fx_predictions(spark, sf), store)
    arrive, source = deliver(spark, sf), delivered(spark, sf)
    for i in range(ARRIVALS):
        arrive(i, f"{base}/in")
        J.stream_attach_actuals(J.stream_resource_minutes(source(f"{base}/in")), store, base)
    return J.attached(spark, base)


# one device stops after two hours, one pauses for two hours and returns
cte("st_src6", ["st_src"], """
SELECT * FROM st_src
UNION ALL SELECT * REPLACE ('dev-quiet' AS device_id) FROM st_src
          WHERE device_id = 'dev-0' AND ts < TIMESTAMP '2024-01-01 02:00:00'
UNION ALL SELECT * REPLACE ('dev-back' AS device_id) FROM st_src
          WHERE device_id = 'dev-0' AND (ts < TIMESTAMP '2024-01-01 01:00:00' OR ts >= TIMESTAMP '2024-01-01 03:00:00')""")


def _stop_and_pause(stream):
    own = F.col("device_id") == "dev-0"
    at = lambda h: F.lit(f"2024-01-01 0{h}:00:00").cast("timestamp")
    quiet = F.when(own & (F.col("ts") < at(2)), "dev-quiet")
    back = F.when(own & ((F.col("ts") < at(1)) | (F.col("ts") >= at(3))), "dev-back")
    return stream.withColumn("device_id", F.explode(F.filter(F.array("device_id", quiet, back), lambda d: d.isNotNull())))


@register("r6_stream_silence", sql_with(["st_src6", "st_wm"], """
WITH kept AS (SELECT tenant, device_id, ts FROM st_src6 JOIN st_wm USING (arrival) WHERE ts + INTERVAL 60 minute > wm),
n AS (SELECT *, lead(ts) OVER (PARTITION BY tenant, device_id ORDER BY ts) AS next_ts FROM kept)
SELECT tenant, device_id, ts AS last_seen, ts + INTERVAL 60 minute AS silent_at
FROM n WHERE (next_ts IS NULL OR next_ts >= ts + INTERVAL 60 minute) AND ts + INTERVAL 60 minute <= (SELECT max(wm) FROM st_wm)"""))
def q_r6(spark, sf):
    """Silences of an hour of event time: a device that stops, and one that pauses and returns (session windows)."""
    return _run(spark, sf, lambda stream: J.stream_silence(_stop_and_pause(stream)), "r6")
