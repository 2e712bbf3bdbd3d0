"""DuckDB twins of the registered queries (the correctness oracle).

Each twin starts from the driver's raw views (``events`` ...) and derives the
same fixtures in SQL, so the check covers the whole chain.  Named CTE blocks
are assembled with their dependencies by ``sql_with``.  Doubles are rounded
to 6 places on both sides (summation order differs between engines).
"""

from __future__ import annotations

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (body, deps)


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][1]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def sql_with(needs: list[str], final: str) -> str:
    names = _order(needs)
    parts = [f"{n} AS (\n{CTES[n][0].strip()}\n)" for n in names]
    final = final.strip()
    if final[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + final[15:]
    if final[:5].upper() == "WITH ":
        # the final query's own CTEs continue the list
        return "WITH " + ",\n".join(parts) + ",\n" + final[5:]
    return "WITH " + ",\n".join(parts) + "\n" + final


def rounded(sql: str, doubles: list[str]) -> str:
    """Round the named double columns like ``registry.round6`` (and turn -0.0 into 0.0)."""
    if not doubles:
        return sql
    rep = ", ".join(f"sign({c}) * floor(abs({c}) * 1e6 + 0.5000001) / 1e6 + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


# --------------------------------------------------------------------------
# Fixture derivation (see FIXTURES.md section 2)
cte("ev", [], """
SELECT event_id, user_id, event_type, value, props,
       make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 180) AS ts
FROM events""")

cte("ev_raw", [], """
SELECT event_id, user_id, event_type, value, props, CAST(ts AS TIMESTAMP) AS ts FROM events""")

cte("fx_points", ["ev"], """
SELECT ts, CASE WHEN event_id % 50 = 0 THEN 'other' ELSE 'server_data' END AS origin,
       concat('t-', CAST(user_id % 2 AS VARCHAR)) AS tenant,
       concat('dev-', CAST(user_id % 2 AS VARCHAR)) AS device_id,
       'service_resource_data' AS location,
       concat('app-', CAST((user_id // 2) % 3 AS VARCHAR)) AS gateway,
       event_type AS measurement, 'value' AS field, CAST(value AS DOUBLE) AS value
FROM ev
UNION ALL
SELECT ts, CASE WHEN event_id % 50 = 0 THEN 'other' ELSE 'server_data' END,
       concat('t-', CAST(user_id % 2 AS VARCHAR)), concat('dev-', CAST(user_id % 2 AS VARCHAR)),
       'server_resource_data',
       CASE event_id % 3 WHEN 0 THEN 'cpu' WHEN 1 THEN 'mem' ELSE 'disk' END,
       CASE WHEN event_id % 3 = 0 THEN 'usage_idle' ELSE 'used_percent' END,
       'value',
       CASE WHEN event_id % 3 = 0 THEN 100.0 - least(value, 100.0) ELSE least(value, 100.0) END
FROM ev""")

cte("app_metrics", ["fx_points"], """
SELECT tenant, device_id, time, application, metric_type, avg(value) AS value FROM (
  SELECT tenant, device_id, gateway AS application, measurement AS metric_type,
         time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute AS time, avg(value) AS value
  FROM fx_points
  WHERE origin = 'server_data' AND location = 'service_resource_data' AND field = 'value'
  GROUP BY tenant, device_id, gateway, measurement, time_bucket(INTERVAL 1 minute, ts)
) GROUP BY tenant, device_id, time, application, metric_type""")

cte("resource_metrics", ["fx_points"], """
SELECT tenant, device_id, time, resource_type, measurement, avg(value) AS value FROM (
  SELECT tenant, device_id, gateway AS resource_type,
         CASE WHEN gateway = 'cpu' THEN 'usage_user' ELSE 'used_percent' END AS measurement,
         time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute AS time,
         CASE WHEN gateway = 'cpu' THEN 100.0 - avg(value) ELSE avg(value) END AS value
  FROM fx_points
  WHERE origin = 'server_data' AND location = 'server_resource_data' AND field = 'value'
    AND ((gateway = 'cpu' AND measurement = 'usage_idle')
      OR (gateway = 'mem' AND measurement = 'used_percent')
      OR (gateway = 'disk' AND measurement = 'used_percent'))
  GROUP BY tenant, device_id, gateway, measurement, time_bucket(INTERVAL 1 minute, ts)
) GROUP BY tenant, device_id, time, resource_type, measurement""")

cte("canon_res", ["resource_metrics"], """
SELECT * FROM resource_metrics
WHERE (resource_type = 'cpu' AND measurement = 'usage_user')
   OR (resource_type = 'mem' AND measurement = 'used_percent')
   OR (resource_type = 'disk' AND measurement = 'used_percent')""")


def _filled(prefix: str, src: str, series: str) -> None:
    """Grid + window interpolation (limit 5), the straightforward form."""
    cte(f"{prefix}_bounds", [src], f"""
SELECT tenant, device_id, min(time) AS g0, max(time) AS g1 FROM {src} GROUP BY tenant, device_id""")
    cte(f"{prefix}_grid", [src, f"{prefix}_bounds"], f"""
SELECT s.*, b.g1, unnest(generate_series(b.g0, b.g1, INTERVAL 1 minute)) AS time
FROM (SELECT DISTINCT tenant, device_id, {series} FROM {src}) s
JOIN {prefix}_bounds b USING (tenant, device_id)""")
    cte(f"{prefix}_g", [f"{prefix}_grid"], f"""
SELECT g.*, a.value FROM {prefix}_grid g LEFT JOIN {src} a USING (tenant, device_id, {series}, time)""")
    part = f"PARTITION BY tenant, device_id, {series} ORDER BY time"
    cte(f"{prefix}_w", [f"{prefix}_g"], f"""
SELECT *,
  last_value(CASE WHEN value IS NOT NULL THEN time END IGNORE NULLS) OVER w1 AS pt,
  last_value(value IGNORE NULLS) OVER w1 AS pv,
  first_value(CASE WHEN value IS NOT NULL THEN time END IGNORE NULLS) OVER w2 AS nt,
  first_value(value IGNORE NULLS) OVER w2 AS nv
FROM {prefix}_g
WINDOW w1 AS ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       w2 AS ({part} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
    cte(f"{prefix}_filled", [f"{prefix}_w"], f"""
SELECT tenant, device_id, {series}, time,
  CASE WHEN value IS NOT NULL THEN value
       WHEN pt IS NULL THEN NULL
       WHEN date_diff('minute', pt, time) > 5 THEN NULL
       WHEN nt IS NULL THEN pv
       ELSE pv + (nv - pv) * date_diff('minute', pt, time) / date_diff('minute', pt, nt) END AS value
FROM {prefix}_w""")


_filled("app", "app_metrics", "application, metric_type")
_filled("res", "canon_res", "resource_type, measurement")

cte("common", ["app_bounds", "res_bounds"], """
SELECT tenant, device_id, greatest(a.g0, r.g0) AS common_start, least(a.g1, r.g1) AS common_end,
       date_diff('minute', greatest(a.g0, r.g0), least(a.g1, r.g1)) + 1 AS n_common
FROM app_bounds a JOIN res_bounds r USING (tenant, device_id)
WHERE greatest(a.g0, r.g0) <= least(a.g1, r.g1)
  AND date_diff('minute', greatest(a.g0, r.g0), least(a.g1, r.g1)) + 1 >= 5""")

cte("pairs", ["app_filled", "res_filled"], """
SELECT a.tenant, a.device_id, a.application, a.metric_type, r.resource_type, a.time, a.value AS x, r.value AS y
FROM app_filled a JOIN res_filled r ON a.tenant = r.tenant AND a.device_id = r.device_id AND a.time = r.time
WHERE a.value IS NOT NULL AND r.value IS NOT NULL""")

cte("corrs", ["pairs", "common"], """
SELECT tenant, device_id, application, metric_type, resource_type,
       CASE WHEN isnan(corr(x, y)) THEN NULL ELSE corr(x, y) END AS correlation,
       count(*) AS n_pairs
FROM pairs WHERE (tenant, device_id) IN (SELECT (tenant, device_id) FROM common)
GROUP BY tenant, device_id, application, metric_type, resource_type""")

cte("scores", ["corrs"], """
SELECT tenant, device_id, application, resource_type, avg(abs(correlation)) AS impact_score,
       count(*) AS n_metrics, 'correlation' AS calculation_method
FROM corrs WHERE correlation IS NOT NULL
GROUP BY tenant, device_id, application, resource_type""")

cte("impacts", ["scores", "common"], """
SELECT s.tenant, s.device_id, unnest(generate_series(c.common_start, c.common_end, INTERVAL 1 minute)) AS time,
       s.application, s.resource_type, s.impact_score, s.calculation_method
FROM scores s JOIN common c USING (tenant, device_id)""")

# --------------------------------------------------------------------------
# Features (P8, W1, W2, A11, U4)
WINDOWS = [5, 15, 30, 60]
STATS = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}
STAT_W = [f"{s}_{w}" for w in WINDOWS for s in STATS]

cte("app_complete", ["app_metrics"], """
SELECT a.* FROM app_metrics a
JOIN (SELECT tenant, device_id, application, time, count(DISTINCT metric_type) AS have
      FROM app_metrics WHERE value IS NOT NULL GROUP BY tenant, device_id, application, time) h
  USING (tenant, device_id, application, time)
JOIN (SELECT tenant, device_id, application, count(DISTINCT metric_type) AS need
      FROM app_metrics GROUP BY tenant, device_id, application) n USING (tenant, device_id, application)
WHERE h.have = n.need AND a.value IS NOT NULL""")

_roll_cols = ",\n  ".join(f"{fn}(value) OVER w{w} AS {s}_{w}" for w in WINDOWS for s, fn in STATS.items())
_roll_wins = ",\n  ".join(
    f"w{w} AS (PARTITION BY tenant, device_id, application, metric_type ORDER BY epoch_us(time) "
    f"RANGE BETWEEN {w * 60_000_000 - 1} PRECEDING AND CURRENT ROW)" for w in WINDOWS)
cte("rolling", ["app_complete"], f"""
SELECT tenant, device_id, application, metric_type, time, value,
  {_roll_cols}
FROM app_complete
WINDOW {_roll_wins}""")

cte("rolling_tall", ["rolling"], f"""
SELECT * FROM (UNPIVOT (SELECT * EXCLUDE (value) FROM rolling) ON {', '.join(STAT_W)} INTO NAME stat_w VALUE value)""")

cte("rolling_last", ["rolling_tall"], """
SELECT tenant, device_id, application, metric_type, stat_w, time_bucket(INTERVAL 5 minute, time) AS bin,
       arg_max(value, time) AS value
FROM rolling_tall WHERE value IS NOT NULL
GROUP BY tenant, device_id, application, metric_type, stat_w, time_bucket(INTERVAL 5 minute, time)""")

cte("features_roll", ["rolling_last"], """
SELECT tenant, device_id, bin AS time, application,
       metric_type || '_' || split_part(stat_w, '_', 1) || '_' || split_part(stat_w, '_', 2) || 'min' AS feature_name,
       value, CAST(split_part(stat_w, '_', 2) AS INTEGER) AS window_size
FROM rolling_last""")

cte("features", ["features_roll", "app_metrics"], """
WITH ft AS (SELECT DISTINCT tenant, device_id, time FROM features_roll),
     ap AS (SELECT DISTINCT tenant, device_id, application FROM app_metrics),
     g AS (SELECT ft.tenant, ft.device_id, ft.time, ap.application FROM ft JOIN ap USING (tenant, device_id))
SELECT * FROM features_roll
UNION ALL SELECT tenant, device_id, time, application, 'hour', CAST(hour(time) AS DOUBLE), 0 FROM g
UNION ALL SELECT tenant, device_id, time, application, 'day_of_week', CAST(isodow(time) - 1 AS DOUBLE), 0 FROM g
UNION ALL SELECT tenant, device_id, time, application, 'is_weekend',
                 CASE WHEN isodow(time) >= 6 THEN 1.0 ELSE 0.0 END, 0 FROM g""")

# --------------------------------------------------------------------------
# Impact statistics (A6) and the system training set (M2)
RES = ["cpu", "mem", "disk"]
_st = []
for r in RES:
    f = f"FILTER (WHERE resource_type = '{r}')"
    _st += [f"coalesce(sum(impact_score) {f}, 0.0) AS {r}_impact_sum",
            f"coalesce(avg(impact_score) {f}, 0.0) AS {r}_impact_mean",
            f"coalesce(max(impact_score) {f}, 0.0) AS {r}_impact_max",
            f"coalesce(stddev_samp(impact_score) {f}, 0.0) AS {r}_impact_std"]
STAT_COLS = [f"{r}_impact_{s}" for r in RES for s in ("sum", "mean", "max", "std")]
cte("impact_stats", ["impacts"], f"""
SELECT tenant, device_id, date_trunc('minute', time) AS time,
  {', '.join(_st)}
FROM impacts GROUP BY tenant, device_id, date_trunc('minute', time)""")

CAL = ["hour", "day_of_week", "is_weekend"]
cte("sys_x", ["impact_stats"], """
SELECT *, CAST(hour(time) AS INTEGER) AS hour, CAST(isodow(time) - 1 AS INTEGER) AS day_of_week,
       CASE WHEN isodow(time) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM impact_stats""")
cte("sys_y", ["canon_res"], f"""
SELECT tenant, device_id, date_trunc('minute', time) AS time,
  {', '.join(f"avg(value) FILTER (WHERE resource_type = '{r}') AS {r}" for r in RES)}
FROM canon_res GROUP BY tenant, device_id, date_trunc('minute', time)""")
cte("sys_slice", ["sys_x", "sys_y"], """
SELECT tenant, device_id, greatest(x0, y0) AS s0, least(x1, y1) AS s1
FROM (SELECT tenant, device_id, min(time) AS x0, max(time) AS x1 FROM sys_x GROUP BY ALL)
JOIN (SELECT tenant, device_id, min(time) AS y0, max(time) AS y1 FROM sys_y GROUP BY ALL) USING (tenant, device_id)
WHERE greatest(x0, y0) < least(x1, y1)""")
_xc = STAT_COLS + CAL
cte("sys_xb", ["sys_x", "sys_slice"], f"""
SELECT x.tenant, x.device_id, time_bucket(INTERVAL 5 minute, x.time) AS time, {', '.join(f'avg({c}) AS {c}' for c in _xc)}
FROM sys_x x JOIN sys_slice s USING (tenant, device_id) WHERE x.time BETWEEN s.s0 AND s.s1
GROUP BY x.tenant, x.device_id, time_bucket(INTERVAL 5 minute, x.time)""")
cte("sys_yb", ["sys_y", "sys_slice"], f"""
SELECT y.tenant, y.device_id, time_bucket(INTERVAL 5 minute, y.time) AS time, {', '.join(f'avg({c}) AS {c}' for c in RES)}
FROM sys_y y JOIN sys_slice s USING (tenant, device_id) WHERE y.time BETWEEN s.s0 AND s.s1
GROUP BY y.tenant, y.device_id, time_bucket(INTERVAL 5 minute, y.time)""")
cte("sys_grid", ["sys_xb", "sys_yb"], """
SELECT tenant, device_id, greatest(x0, y0) AS c0, least(x1, y1) AS c1,
       unnest(generate_series(least(x0, y0), greatest(x1, y1), INTERVAL 5 minute)) AS time
FROM (SELECT tenant, device_id, min(time) AS x0, max(time) AS x1 FROM sys_xb GROUP BY ALL)
JOIN (SELECT tenant, device_id, min(time) AS y0, max(time) AS y1 FROM sys_yb GROUP BY ALL) USING (tenant, device_id)""")
_all = _xc + RES
cte("sys_train", ["sys_grid"], f"""
SELECT * EXCLUDE (n) FROM (
  SELECT tenant, device_id, time, {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in _all)},
         count(*) OVER (PARTITION BY tenant, device_id) AS n
  FROM (
    SELECT g.tenant, g.device_id, g.time, g.c0, g.c1,
      {', '.join(f'CAST(last_value({c} IGNORE NULLS) OVER (PARTITION BY g.tenant, g.device_id ORDER BY g.time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS {c}' for c in _all)}
    FROM sys_grid g LEFT JOIN sys_xb x USING (tenant, device_id, time) LEFT JOIN sys_yb y USING (tenant, device_id, time)
  ) WHERE time BETWEEN c0 AND c1
) WHERE n >= 10""")
