"""Registered model queries.

The data steps have plain DuckDB twins.  Of the fits SQL can say which keys
they must cover, in what encoding, on how many rows, what always saying the
mean would cost, and where defaults stand in; these columns are compared.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import accuracy as ACC
from ..operators import aggregate as AG
from ..operators import alerts as AL
from ..operators import joins as JN
from ..operators import models as MD
from ..operators.features import app_training_set, feature_table, system_training_set
from ..operators.ranking import top_features
from ..session import ensure_checkpoint_dir
from ..sources import tables as TB
from ..sources.fixtures import fx_points
from . import impact as IP
from .catalog import EVENT_TYPES, NOW, NOW_SQL
from .oracle import cte, sql_with
from .registry import _app, _res, register

K = ["tenant", "device_id"]

# The expected model inputs used to exercise the alignment rules
# (windowed names of every fixture metric, calendar, and keyword-only names).
ALIGN_EXPECTED = ([f"{m}_{s}_{w}min" for m in EVENT_TYPES for s in ("mean", "std", "max", "min")
                   for w in (5, 15, 30, 60)] + ["hour", "day_of_week", "is_weekend", "click", "click_rate",
                                                 "heap_used_bytes", "gc_count", "thread_count", "process_cpu",
                                                 "other_metric"])


def _profile(spark, sf):
    prof = AG.latest_profile(_app(spark, sf), NOW, 30)
    return AG.pivot_mean(prof, [*K, "application", *MD.CALENDAR], "metric_type", "value", EVENT_TYPES)


cte("profile_wide", ["app_metrics"], f"""
WITH r AS (SELECT *, max(time) OVER (PARTITION BY tenant, device_id, application) AS newest FROM app_metrics
           WHERE time > {NOW_SQL} - INTERVAL 30 minute AND time <= {NOW_SQL})
SELECT tenant, device_id, application, hour(newest) AS hour, isodow(newest) - 1 AS day_of_week,
       CASE WHEN isodow(newest) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  {', '.join(f"avg(value) FILTER (WHERE metric_type = '{m}') AS {m}" for m in EVENT_TYPES)}
FROM (SELECT tenant, device_id, application, newest, metric_type, avg(value) AS value FROM r
      GROUP BY tenant, device_id, application, newest, metric_type)
GROUP BY tenant, device_id, application, newest""")


# Where each expected input must come from, written out: the fixture metrics have no windowed columns, so their
# windowed names take the metric itself; the calendar is in the profile.
ALIGN_SOURCES = ({f"{m}_{s}_{w}min": m for m in EVENT_TYPES for s in ("mean", "std", "max", "min") for w in (5, 15, 30, 60)}
                 | {"hour": "hour", "day_of_week": "day_of_week", "is_weekend": "is_weekend", "click": "click", "click_rate": "click",
                    "heap_used_bytes": 1000000000.0, "gc_count": 1000.0, "thread_count": 50.0, "process_cpu": 30.0, "other_metric": 0.0})


def _align_sql() -> str:
    parts = [f"coalesce(CAST({src} AS DOUBLE), 0.0) AS \"{name}\"" for name, src in ALIGN_SOURCES.items()]
    return f"SELECT tenant, device_id, application, {', '.join(parts)} FROM profile_wide"


@register("j6_align_features", sql_with(["profile_wide"], _align_sql()), ALIGN_EXPECTED)
def q_j6(spark, sf):
    """Latest profile aligned to a model's expected feature names."""
    return MD.align_features(_profile(spark, sf), ALIGN_EXPECTED, NOW, [*K, "application"])


cte("app_train", ["features", "impacts"], """
WITH ft AS (SELECT DISTINCT tenant, device_id, application, time FROM features),
yt AS (SELECT DISTINCT tenant, device_id, application, time FROM impacts),
b AS (SELECT * FROM ft JOIN yt USING (tenant, device_id, application, time)),
k AS (SELECT tenant, device_id, application FROM b GROUP BY ALL HAVING count(*) >= 10),
keep AS (SELECT b.* FROM b JOIN k USING (tenant, device_id, application))
SELECT keep.tenant, keep.device_id, keep.application, keep.time, f.feature_name, f.value, i.resource_type,
       i.impact_score AS label
FROM keep JOIN features f USING (tenant, device_id, application, time)
JOIN impacts i USING (tenant, device_id, application, time)""")


# one score per hour: the label of a feature time is that of its hour
cte("scores_hourly", ["pairs", "common"], """
SELECT tenant, device_id, period, application, resource_type, avg(abs(correlation)) AS impact_score FROM (
  SELECT tenant, device_id, time_bucket(INTERVAL 1 hour, time) AS period, application, metric_type, resource_type,
         CASE WHEN isnan(corr(x, y)) THEN NULL ELSE corr(x, y) END AS correlation
  FROM pairs WHERE (tenant, device_id) IN (SELECT (tenant, device_id) FROM common)
  GROUP BY tenant, device_id, time_bucket(INTERVAL 1 hour, time), application, metric_type, resource_type)
WHERE correlation IS NOT NULL GROUP BY tenant, device_id, period, application, resource_type""")
cte("app_train_hourly", ["features", "common", "scores_hourly"], """
WITH f AS (SELECT f.*, time_bucket(INTERVAL 1 hour, f.time) AS period FROM features f JOIN common c USING (tenant, device_id)
           WHERE f.time BETWEEN c.common_start AND c.common_end),
b AS (SELECT DISTINCT tenant, device_id, application, time, period FROM f),
k AS (SELECT tenant, device_id, application FROM b SEMI JOIN scores_hourly USING (tenant, device_id, application, period)
      GROUP BY ALL HAVING count(*) >= 10)
SELECT f.tenant, f.device_id, f.application, f.time, f.feature_name, f.value, s.resource_type, s.impact_score AS label
FROM f SEMI JOIN k USING (tenant, device_id, application) JOIN scores_hourly s USING (tenant, device_id, application, period)""")


def _app_train(spark, sf, period=None):
    scores, common = IP.scores_and_spans(fx_points(spark, sf), period)
    return app_training_set(feature_table(_app(spark, sf)), scores, common, period=period)


@register("m1_app_training_set", sql_with(["app_train"], "SELECT * FROM app_train"), ["value", "label"])
def q_m1(spark, sf):
    """M1: features x impact label on common times (>= 10 per application)."""
    return _app_train(spark, sf)


@register("m1_hourly_training_set", sql_with(["app_train_hourly"], "SELECT * FROM app_train_hourly"), ["value", "label"])
def q_m1h(spark, sf):
    """M1 with a label that varies: the impact score of the feature time's hour."""
    return _app_train(spark, sf, "1 hour")


def _raw_sql(scores: str, period: str) -> str:
    """M3 in SQL; ``period`` is the label's period of a time (a constant for one label over all times)."""
    app, key = "tenant, device_id, application", "tenant, device_id, application, period"
    cal = "(VALUES ('hour', 0), ('day_of_week', 1), ('is_weekend', 2)) n(feature_name, which)"
    return f"""
WITH m AS (SELECT {app}, time, metric_type, avg(value) AS value, {period} AS period FROM app_metrics JOIN common USING (tenant, device_id)
           WHERE time BETWEEN common_start AND common_end GROUP BY ALL),
y AS ({scores}),
t0 AS (SELECT DISTINCT {key}, time FROM m SEMI JOIN y USING ({key})),
t AS (SELECT * FROM t0 SEMI JOIN (SELECT {app} FROM t0 GROUP BY ALL HAVING count(*) >= 10) USING ({app})),
k AS (SELECT m.* FROM m SEMI JOIN t USING ({app}, time)),
mm AS (SELECT {app}, metric_type, avg(value) AS mean FROM k GROUP BY ALL),
x AS (SELECT {key}, time, metric_type AS feature_name, coalesce(k.value, mean, 0.0) AS value, k.value IS NULL AS imputed
      FROM t JOIN mm USING ({app}) LEFT JOIN (SELECT * EXCLUDE (period) FROM k) k USING ({app}, time, metric_type)
      UNION ALL
      SELECT {key}, time, feature_name, CASE which WHEN 0 THEN CAST(hour(time) AS DOUBLE) WHEN 1 THEN CAST(isodow(time) - 1 AS DOUBLE)
             ELSE CASE WHEN isodow(time) >= 6 THEN 1.0 ELSE 0.0 END END, false FROM t, {cal}),
l AS (SELECT {app}, time, period, resource_type, avg(y.label) OVER (PARTITION BY {app}, resource_type) AS label_mean, y.label
      FROM t JOIN (SELECT DISTINCT {app}, resource_type FROM y SEMI JOIN t USING ({key})) r USING ({app}) LEFT JOIN y USING ({key}, resource_type))
SELECT {app}, time, x.feature_name, x.value, x.imputed, l.resource_type, coalesce(l.label, l.label_mean, 0.0) AS label,
       l.label IS NULL AS label_imputed
FROM x JOIN l USING ({app}, time)"""


@register("m3_raw_training_set", sql_with(["app_metrics", "common", "scores"], _raw_sql(
    "SELECT tenant, device_id, application, 0 AS period, resource_type, impact_score AS label FROM scores", "0")), ["value", "label"])
def q_m3(spark, sf):
    """M3: raw metric means (mean imputation) and calendar beside the impact label."""
    return MD.raw_training_set(_app(spark, sf), *IP.scores_and_spans(fx_points(spark, sf)))


@register("m3_hourly_training_set", sql_with(["app_metrics", "common", "scores_hourly"], _raw_sql("""
SELECT tenant, device_id, application, period, resource_type, impact_score AS label FROM scores_hourly
WHERE NOT (resource_type = 'cpu' AND hour(period) = 1)""", "time_bucket(INTERVAL 1 hour, time)")), ["value", "label"])
def q_m3h(spark, sf):
    """M3 with hourly labels; those of cpu are missing for an hour and take the mean label."""
    scores, common = IP.scores_and_spans(fx_points(spark, sf), "1 hour")
    gap = (F.col("resource_type") == "cpu") & (F.hour("period") == 1)
    return MD.raw_training_set(_app(spark, sf), scores.where(~gap), common, period="1 hour")


def _sys_train(spark, sf):
    return system_training_set(*IP.scores_and_spans(fx_points(spark, sf)), _res(spark, sf))


# the feature names of W2 and the calendar for the fixture metrics
IMPACT_FEATURES = [f"{m}_{s}_{w}min" for m in EVENT_TYPES for s in ("mean", "std", "max", "min") for w in (5, 15, 30, 60)] + MD.CALENDAR


def _fit(spark, sf, kind: str, cv_splits: int = 5, model: str = MD.PER_KEY):
    if kind == "system":
        return MD.fit_system_models(_sys_train(spark, sf))
    return MD.fit_impact_models(_app_train(spark, sf, "1 hour"), IMPACT_FEATURES, model, cv_splits)


# the rows the fits see, in SQL: what they must report about keys and labels
cte("impact_rows", ["app_train_hourly"], """
SELECT DISTINCT tenant, device_id, application, time, resource_type, label FROM app_train_hourly WHERE label IS NOT NULL""")
cte("system_rows", ["sys_train"], """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY tenant, device_id ORDER BY time) AS i,
                  count(*) OVER (PARTITION BY tenant, device_id) AS n FROM sys_train)
SELECT tenant, device_id, time, i <= floor(n * 0.8) AS is_train, resource_type, label
FROM (SELECT *, unnest(['cpu', 'mem', 'disk']) AS resource_type, unnest([cpu, mem, disk]) AS label FROM r)
WHERE label IS NOT NULL""")
# expanding folds over an application's times: block f + 1 is the test block of fold f; what always saying the training mean costs
cte("fold_costs", ["impact_rows"], """
WITH t AS (SELECT tenant, device_id, application, time, count(*) OVER a AS n, row_number() OVER (a ORDER BY time) - 1 AS i
           FROM (SELECT DISTINCT tenant, device_id, application, time FROM impact_rows) WINDOW a AS (PARTITION BY tenant, device_id, application)),
b AS (SELECT *, CASE WHEN n // 6 = 0 OR i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS block FROM t),
r AS (SELECT r.*, b.block FROM impact_rows r JOIN b USING (tenant, device_id, application, time)),
tr AS (SELECT tenant, device_id, application, resource_type, fold, avg(label) AS mean
       FROM r, (SELECT unnest(generate_series(0, 4)) AS fold) WHERE block <= fold GROUP BY ALL),
te AS (SELECT tenant, device_id, application, resource_type, fold, avg(abs(label - mean)) AS mean_mae
       FROM r JOIN tr USING (tenant, device_id, application, resource_type) WHERE r.block = tr.fold + 1 GROUP BY ALL)
SELECT tenant, device_id, application, resource_type, avg(mean_mae) AS mean_mae, count(*) AS folds FROM te GROUP BY ALL""")


@register("m4_impact_encoding", sql_with(["impact_rows"], """
SELECT tenant, device_id, application, resource_type, count(*) AS n_rows, avg(label) AS label_mean,
       stddev_pop(label) AS label_std
FROM impact_rows GROUP BY tenant, device_id, application, resource_type"""), ["label_mean", "label_std"])
def q_m4e(spark, sf):
    """M4: rows, mean and deviation of the hourly impact labels per key."""
    return MD.label_stats(MD.impact_rows(_app_train(spark, sf, "1 hour"), IMPACT_FEATURES), MD.IMPACT_KEYS)


@register("m4_impact_models", sql_with(["impact_rows", "fold_costs"], """
WITH n AS (SELECT tenant, device_id, application, resource_type, count(*) AS n_rows, stddev_pop(label) AS label_std
           FROM impact_rows GROUP BY tenant, device_id, application, resource_type)
SELECT n.tenant, n.device_id, n.application, n.resource_type, n.n_rows, n.label_std, f.folds, f.mean_mae, 0.0 AS mean_residual, true AS explains,
       CASE WHEN n.label_std > 1e-9 THEN 1.0 ELSE 0.0 END AS importance
FROM n LEFT JOIN fold_costs f USING (tenant, device_id, application, resource_type)"""),
          ["label_std", "mean_mae", "mean_residual", "importance"])
def q_m4(spark, sf):
    """M4: a ridge per (entity, application, resource) with 5 expanding folds.

    Per key its rows, folds and the cost of always saying the mean; on its own
    rows the residuals add up to nothing and are no larger than the label's
    deviation; importances are shares of one.
    """
    train = _app_train(spark, sf, "1 hour")
    fm = MD.fit_impact_models(train, IMPACT_FEATURES)
    rows = MD.score(fm, MD.impact_rows(train, IMPACT_FEATURES))
    rest = F.col("label") - F.col("prediction")
    own = rows.groupBy(*MD.IMPACT_KEYS).agg(F.avg(rest).alias("mean_residual"),
                                            (F.avg(rest * rest) <= F.var_pop("label") + F.lit(1e-12)).alias("explains"))
    shares = MD.importances(fm.metrics, MD.IMPACT_KEYS).groupBy(*MD.IMPACT_KEYS).agg(F.sum("importance").alias("importance"))
    return (fm.metrics.join(own, MD.IMPACT_KEYS).join(shares, MD.IMPACT_KEYS)
            .select(*MD.IMPACT_KEYS, "n_rows", "label_std", "folds", "mean_mae", "mean_residual", "explains", "importance"))


# a model of two inputs has a closed form: ridge on standardised inputs, importances as shares
TWO = [f"{EVENT_TYPES[0]}_mean_60min", "hour"]
cte("two_inputs", ["app_train_hourly"], f"""
WITH w AS (SELECT tenant, device_id, application, time, resource_type, label, coalesce(max(value) FILTER (WHERE feature_name = '{TWO[0]}'), 0.0) AS a,
                  coalesce(max(value) FILTER (WHERE feature_name = '{TWO[1]}'), 0.0) AS b
           FROM app_train_hourly GROUP BY ALL),
m AS (SELECT tenant, device_id, application, resource_type, count(*) AS n_rows, avg(a) AS ma, avg(b) AS mb, avg(label) AS my,
             stddev_pop(a) AS sa, stddev_pop(b) AS sb, stddev_pop(label) AS sy, covar_pop(a, b) AS cab, covar_pop(a, label) AS ca, covar_pop(b, label) AS cb
      FROM w GROUP BY tenant, device_id, application, resource_type),
v AS (SELECT *, sa > 1e-9 AND sy > 1e-9 AS va, sb > 1e-9 AND sy > 1e-9 AS vb FROM m),
r AS (SELECT *, CASE WHEN va THEN ca / (sa * sy) ELSE 0.0 END AS ra, CASE WHEN vb THEN cb / (sb * sy) ELSE 0.0 END AS rb,
             CASE WHEN va AND vb THEN cab / (sa * sb) ELSE 0.0 END AS rab FROM v),
s AS (SELECT *, (1.001 * ra - rab * rb) / (1.001 * 1.001 - rab * rab) AS ba, (1.001 * rb - rab * ra) / (1.001 * 1.001 - rab * rab) AS bb FROM r),
c AS (SELECT *, CASE WHEN va THEN ba * sy / sa ELSE 0.0 END AS coef_a, CASE WHEN vb THEN bb * sy / sb ELSE 0.0 END AS coef_b,
             coalesce(abs(ba) / nullif(abs(ba) + abs(bb), 0.0), 0.0) AS share_a, coalesce(abs(bb) / nullif(abs(ba) + abs(bb), 0.0), 0.0) AS share_b FROM s)
SELECT tenant, device_id, application, resource_type, n_rows, coef_a, coef_b, my - coef_a * ma - coef_b * mb AS intercept, share_a, share_b FROM c""")


@register("m4_ridge_coefficients", sql_with(["two_inputs"], """
SELECT tenant, device_id, application, resource_type, n_rows, coef_a, coef_b, intercept FROM two_inputs"""), ["coef_a", "coef_b", "intercept"])
def q_m4c(spark, sf):
    """M4: coefficients of the ridge per key on two inputs, which have a closed form."""
    fm = MD.fit_impact_models(_app_train(spark, sf, "1 hour"), TWO, cv_splits=1)
    return fm.linear.select(*MD.IMPACT_KEYS, "n_rows", F.col("coef")[0].alias("coef_a"), F.col("coef")[1].alias("coef_b"), "intercept")


@register("t1_model_features", sql_with(["two_inputs"], f"""
SELECT tenant, device_id, application, resource_type, feature_name, importance,
       row_number() OVER (PARTITION BY tenant, device_id, application, resource_type ORDER BY importance DESC, feature_name) AS rank
FROM (SELECT *, unnest(['{TWO[0]}', '{TWO[1]}']) AS feature_name, unnest([share_a, share_b]) AS importance FROM two_inputs)"""), ["importance"])
def q_t1m(spark, sf):
    """T1 on M6's importance JSON: the top features of every impact model."""
    fm = MD.fit_impact_models(_app_train(spark, sf, "1 hour"), TWO, cv_splits=1)
    performance = MD.model_performance_rows(fm, NOW)
    return top_features(MD.importances(performance, MD.IMPACT_KEYS), MD.IMPACT_KEYS, 10)


@register("m5_system_encoding", sql_with(["system_rows"], """
SELECT tenant, device_id, resource_type, count(*) AS n_rows, avg(label) AS label_mean, stddev_pop(label) AS label_std
FROM system_rows WHERE is_train GROUP BY tenant, device_id, resource_type"""), ["label_mean", "label_std"])
def q_m5e(spark, sf):
    """M5: the target encoding of the system models (training rows of the chronological split)."""
    return MD.label_stats(MD.system_rows(_sys_train(spark, sf)).where("is_train"), MD.SYSTEM_KEYS)


@register("m5_system_models", sql_with(["system_rows"], """
WITH m AS (SELECT tenant, device_id, resource_type, count(*) AS n_rows, avg(label) AS label_mean
           FROM system_rows WHERE is_train GROUP BY tenant, device_id, resource_type)
SELECT s.tenant, s.device_id, s.resource_type, any_value(m.n_rows) AS n_rows, avg(abs(s.label - m.label_mean)) AS mean_mae,
       true AS has_error
FROM system_rows s JOIN m USING (tenant, device_id, resource_type) WHERE NOT s.is_train
GROUP BY s.tenant, s.device_id, s.resource_type"""), ["mean_mae"])
def q_m5(spark, sf):
    """M5: utilisation boosting with a chronological hold-out: rows and mean-predictor error per key beside the model's own."""
    m = _fit(spark, sf, "system").metrics
    return m.select(*MD.SYSTEM_KEYS, "n_rows", "mean_mae", (F.col("mae") >= 0).alias("has_error"))


@register("m6_model_performance_rows", sql_with(["system_rows", "impact_rows", "impacts", "features"], f"""
WITH i AS (SELECT tenant, device_id, count(*) AS n, count(DISTINCT application) AS apps FROM impacts GROUP BY ALL),
f AS (SELECT tenant, device_id, count(*) AS n FROM features GROUP BY ALL)
SELECT DISTINCT tenant, device_id, application, resource_type, 'ridge' AS model_type, {NOW_SQL} AS trained_at, true AS scored, NULL AS counts,
       '20240101040000' AS version FROM impact_rows
UNION ALL
SELECT DISTINCT tenant, device_id, 'system', resource_type, 'gradient_boosting', {NOW_SQL}, true, NULL, '20240101040000'
FROM system_rows WHERE is_train
UNION ALL
SELECT tenant, device_id, 'streaming_metadata', 'training_info', 'cache_based', {NOW_SQL}, true,
       concat('{{"cache_key":"fleet","impact_records":', coalesce(i.n, 0), ',"feature_records":', coalesce(f.n, 0), ',"applications":', coalesce(i.apps, 0),
              ',"training_method":"streaming_cache"}}'), 'streaming_fleet_20240101040000'
FROM i FULL JOIN f USING (tenant, device_id)"""))
def q_m6(spark, sf):
    """M6: both kinds of models and the run's own row, appended to a model-performance table and read back."""
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    parts = [MD.model_performance_rows(_fit(spark, sf, kind, 2), NOW) for kind in ("impact", "system")]
    parts.append(MD.run_metadata_rows(IP.impact_table(fx_points(spark, sf)), feature_table(_app(spark, sf)), "fleet", NOW))
    for rows in parts:
        TB.append_table(rows, root, "model_performance", partition_by=["tenant"])
    t = TB.read_table(spark, root, "model_performance")
    counts = F.when(F.col("application") == MD.RUN_APPLICATION, F.col("feature_importance"))
    return t.select(*K, "application", "resource_type", "model_type", "trained_at", F.col("mae").isNotNull().alias("scored"),
                    counts.alias("counts"), "version")


@register("m7_predict_impacts", sql_with(["profile_wide", "impact_rows"], """
WITH k AS (SELECT DISTINCT tenant, device_id, application, resource_type FROM impact_rows),
p AS (SELECT tenant, device_id, application FROM profile_wide
      UNION ALL SELECT DISTINCT tenant, device_id, 'app-new' FROM profile_wide)
SELECT p.tenant, p.device_id, p.application, r.resource_type, k.tenant IS NOT NULL AS trained,
       CASE WHEN k.tenant IS NULL THEN 0.5 END AS default_score
FROM p CROSS JOIN (SELECT unnest(['cpu', 'mem', 'disk']) AS resource_type) r
LEFT JOIN k ON k.tenant = p.tenant AND k.device_id = p.device_id AND k.application = p.application
  AND k.resource_type = r.resource_type"""), ["default_score"])
def q_m7(spark, sf):
    """M7: which profiles are scored by a model and which get 0.5 (each entity has an application never trained)."""
    fm = _fit(spark, sf, "impact", 1)
    prof = _profile(spark, sf)
    new = prof.dropDuplicates(K).withColumn("application", F.lit("app-new"))
    got = MD.predict_impacts(fm, prof.unionByName(new), NOW).join(
        fm.metrics.select(*MD.IMPACT_KEYS, F.lit(True).alias("_t")), MD.IMPACT_KEYS, "left")
    trained = F.coalesce("_t", F.lit(False))
    return got.select(*MD.IMPACT_KEYS, trained.alias("trained"), F.when(~trained, F.col("impact_score")).alias("default_score"))


def _chain(spark, sf, system):
    """M7 -> A7 -> M10: the impact models feed the system models."""
    impacts = MD.predict_impacts(_fit(spark, sf, "impact", 1), _profile(spark, sf), NOW)
    return MD.forecast(system, AG.serving_impact_stats(impacts), AL.forecast_grid(_res(spark, sf), NOW, 24))


cte("chain_grid", ["profile_wide", "canon_res"], f"""
SELECT p.tenant, p.device_id, CAST(i AS INTEGER) AS step_index, {NOW_SQL} + to_minutes(CAST(30 * i AS BIGINT)) AS target_time, resource_type
FROM (SELECT DISTINCT tenant, device_id FROM profile_wide SEMI JOIN canon_res USING (tenant, device_id)) p,
     (SELECT unnest(generate_series(1, 48)) AS i), (SELECT unnest(['cpu', 'mem', 'disk']) AS resource_type)""")


@register("m10_forecast", sql_with(["chain_grid"], """
SELECT tenant, device_id, target_time, resource_type, true AS in_range FROM chain_grid"""))
def q_m10(spark, sf):
    """24 h forecast through the chain M7 -> A7 -> M10: every grid point, with a utilisation near 0..100."""
    f = _chain(spark, sf, _fit(spark, sf, "system"))
    return f.select(*K, "target_time", "resource_type", F.col("predicted_value").between(-50.0, 150.0).alias("in_range"))


@register("m10_forecast_alerts")
def q_m10a(spark, sf):
    """The chain to its end: M10's forecast becomes prediction rows (S6), crossings (W7) and alert rows."""
    f = _chain(spark, sf, _fit(spark, sf, "system"))
    limits = TB.thresholds(spark).withColumn("threshold", F.col("threshold") - F.lit(40.0))
    return TB.to_alert_rows(AL.threshold_crossings(f, limits), NOW)


@register("m6_accuracy_rows", sql_with(["pred_actual"], f"""
WITH a AS (SELECT * FROM pred_actual WHERE actual_value IS NOT NULL),
m AS (SELECT tenant, device_id, resource_type, avg(actual_value) AS mean FROM a GROUP BY ALL),
r AS (SELECT a.*, m.mean FROM a JOIN m USING (tenant, device_id, resource_type) WHERE a.prediction_time >= {NOW_SQL} - INTERVAL 24 hour)
SELECT tenant, device_id, 'system' AS application, resource_type, 'system_performance' AS model_type, avg(error) AS mae,
       sqrt(avg(error * error)) AS rmse,
       1.0 - sum(error * error) / nullif(sum((actual_value - mean) * (actual_value - mean)), 0) AS r2_score,
       CAST(NULL AS VARCHAR) AS feature_importance, {NOW_SQL} AS trained_at, '20240101040000_perf' AS version
FROM r GROUP BY tenant, device_id, resource_type"""), ["mae", "rmse", "r2_score"])
def q_m6a(spark, sf):
    """A16's accuracy as rows of the model-performance table."""
    pred = JN.attach_actuals(TB.fx_predictions(spark, sf), _res(spark, sf), NOW)
    return MD.accuracy_rows(ACC.prediction_performance(pred, NOW), NOW)


@register("m11_save_load_forecast", sql_with(["scores", "canon_res"], f"""
SELECT p.tenant, p.device_id, {NOW_SQL} + to_minutes(CAST(30 * i AS BIGINT)) AS target_time, resource_type, true AS same,
       'dev-0' AS loaded_for, '_generic' AS loaded_else
FROM (SELECT DISTINCT tenant, device_id FROM scores) p,
     (SELECT unnest(generate_series(1, 48)) AS i), (SELECT unnest(['cpu', 'mem', 'disk']) AS resource_type)"""))
def q_m11(spark, sf):
    """A device's model and the generic one, both stored; each is found where it should be and forecasts alike."""
    fm = _fit(spark, sf, "system")
    root = os.path.join(ensure_checkpoint_dir(spark), "models", uuid.uuid4().hex)
    MD.save_models(fm, root)
    MD.save_models(fm, root, "t-0", "dev-0")
    mine, at = MD.load_models(spark, root, fm.purpose, "t-0", "dev-0")
    _, other = MD.load_models(spark, root, fm.purpose, "t-1", "dev-1")
    key = [*K, "target_time", "resource_type"]
    grid, stats = AL.forecast_grid(_res(spark, sf), NOW, 24), AG.serving_impact_stats(IP.impact_score_table(fx_points(spark, sf)))
    a, b = MD.forecast(fm, stats, grid), MD.forecast(mine, stats, grid).withColumnRenamed("predicted_value", "again").drop("step_index")
    return a.join(b, key).select(*key, (F.abs(F.col("predicted_value") - F.col("again")) < 1e-9).alias("same"),
                                 F.lit(os.path.basename(at)).alias("loaded_for"), F.lit(os.path.basename(other)).alias("loaded_else"))
