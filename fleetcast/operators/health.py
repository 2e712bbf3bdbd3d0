"""Health and status tables.

Each component is one aggregation per entity with a ``status`` column
(healthy / warning / critical); H6 takes the worst.  With ``entities`` (the
registry) every registered entity gets a verdict, also one that fell silent:
no recent value is zero, no recent row critical, no model or forecast a
warning, no job a critical job statistic and a healthy job component.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import hours_between, ts_lit
from .clean import canonical_resources

K = ["tenant", "device_id"]
# Status limits.
RESOURCE_LIMITS = {"cpu": 80.0, "mem": 80.0, "disk": 85.0}
JOB_FAILURE_RATE = 0.3
JOB_SLOW_SECONDS = 300.0
SEVERITY = ["healthy", "warning", "critical"]


def _ts(v) -> Column:
    return ts_lit(v) if isinstance(v, (str, _dt.datetime)) else v


def _minutes_ago(now, m: int) -> Column:
    return _ts(now) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m))


def _every(entities: DataFrame | None, df: DataFrame) -> DataFrame:
    """One row per registered entity (all entities of ``df`` when there is no registry)."""
    return df if entities is None else entities.select(*K).distinct().join(df, K, "left")


# W8 ------------------------------------------------------------------------
def latest_resources(res: DataFrame, now, minutes: int = 5, entities: DataFrame | None = None) -> DataFrame:
    """Latest cpu / mem / disk value per entity within the last ``minutes`` (0 when absent; ties take the larger)."""
    r = canonical_resources(res).where((F.col("time") > _minutes_ago(now, minutes)) & (F.col("time") <= _ts(now)))
    own = {k: F.when(F.col("resource_type") == k, F.struct("time", "value")) for k in RESOURCE_LIMITS}
    g = r.groupBy(*K).agg(*[F.max_by("value", own[k]).alias(f"_{k}") for k in RESOURCE_LIMITS])
    return _every(entities, g).select(*K, *[F.coalesce(f"_{k}", F.lit(0.0)).alias(f"{k}_percent") for k in RESOURCE_LIMITS])


# H1 ------------------------------------------------------------------------
def resource_status(latest: DataFrame) -> DataFrame:
    over = [F.when(F.col(f"{k}_percent") > v, F.lit(k)) for k, v in RESOURCE_LIMITS.items()]
    hot = F.concat_ws(",", *over)
    return latest.select("*", hot.alias("over_limit"),
                         F.when(hot != "", "warning").otherwise("healthy").alias("status"))


# H2 ------------------------------------------------------------------------
def collection_status(app: DataFrame, res: DataFrame, now, min_rows: int = 10, entities: DataFrame | None = None) -> DataFrame:
    """Rows in the last hour in both tables; both short -> critical, one short -> warning."""
    recent = (F.col("time") > _minutes_ago(now, 60)) & (F.col("time") <= _ts(now))
    a = app.where(recent).groupBy(*K).agg(F.count(F.lit(1)).alias("app_rows"))
    r = res.where(recent).groupBy(*K).agg(F.count(F.lit(1)).alias("res_rows"))
    j = _every(entities, a.join(r, K, "full"))
    an, rn = F.coalesce("app_rows", F.lit(0)), F.coalesce("res_rows", F.lit(0))
    st = (F.when((an < min_rows) & (rn < min_rows), "critical")
          .when((an < min_rows) | (rn < min_rows), "warning").otherwise("healthy"))
    return j.select(*K, an.alias("app_rows"), rn.alias("res_rows"), st.alias("status"))


# T2 ------------------------------------------------------------------------
def recent_models(perf: DataFrame, k: int = 10, min_r2: float = 0.5, max_mae: float = 20.0) -> DataFrame:
    """Last ``k`` model rows per entity (total order), flagged poor if r2 < 0.5 or mae > 20."""
    w = Window.partitionBy(*K).orderBy(F.col("trained_at").desc(), "application", "resource_type", "model_type")
    top = perf.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.withColumn("poor", (F.col("r2_score") < min_r2) | (F.col("mae") > max_mae))


# H3 ------------------------------------------------------------------------
def model_status(perf: DataFrame, now, max_age_hours: float = 168.0, k: int = 10,
                 entities: DataFrame | None = None) -> DataFrame:
    """Age and poor models among the last ``k`` rows; an entity without a model is a warning."""
    top = recent_models(perf, k)
    poor = F.when(F.col("poor"), F.concat_ws("-", "application", "resource_type"))
    g = top.groupBy(*K).agg(F.count(F.lit(1)).alias("model_count"), F.max("trained_at").alias("latest_training"),
                            F.array_join(F.sort_array(F.collect_list(poor)), ", ").alias("poor_models"),
                            F.count(poor).alias("n_poor"))
    g = _every(entities, g)
    count, bad = F.coalesce("model_count", F.lit(0)), F.coalesce("n_poor", F.lit(0))
    age = hours_between("latest_training", _ts(now))
    st = F.when((count == 0) | (age > max_age_hours) | (bad > 0), "warning").otherwise("healthy")
    return g.select(*K, count.alias("model_count"), "latest_training", age.alias("age_hours"), bad.alias("n_poor"),
                    F.coalesce("poor_models", F.lit("")).alias("poor_models"), st.alias("status"))


# H4 ------------------------------------------------------------------------
def prediction_status(pred: DataFrame, now, interval_minutes: int = 60, max_error: float = 15.0,
                      entities: DataFrame | None = None) -> DataFrame:
    """Forecasts of the last 2 h: latest time, count, mean error; none, few or bad -> warning."""
    ents = (pred if entities is None else entities).select(*K).distinct()
    recent = pred.where((F.col("prediction_time") > _minutes_ago(now, 120)) & (F.col("prediction_time") <= _ts(now))).groupBy(*K).agg(
        F.max("prediction_time").alias("latest_prediction"), F.count(F.lit(1)).alias("prediction_count"),
        F.avg("error").alias("avg_error"))
    j = ents.join(recent, K, "left")
    expected = 120.0 / interval_minutes
    cnt = F.coalesce("prediction_count", F.lit(0))
    st = (F.when(F.col("latest_prediction").isNull(), "warning")
          .when((cnt < expected * 0.5) | (F.coalesce(F.col("avg_error"), F.lit(0.0)) > max_error), "warning")
          .otherwise("healthy"))
    return j.select(*K, "latest_prediction", cnt.alias("prediction_count"), "avg_error", st.alias("status"))


# A21 / H5 ------------------------------------------------------------------
def job_stats(jobs: DataFrame, now, hours: int = 24, entities: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Jobs, success %, mean duration (s) per entity (and ``by``); healthy > 80 %, warning > 50 %, else critical.

    A registered entity without a job is critical: nothing of it succeeded.
    """
    d = jobs.where(F.col("start_time") >= _ts(now) - F.make_dt_interval(F.lit(0), F.lit(hours)))
    dur = (F.unix_micros("end_time") - F.unix_micros("start_time")) / F.lit(1_000_000.0)
    g = d.groupBy(*K, *by).agg(F.count(F.lit(1)).alias("jobs"),
                          F.avg(F.when(F.col("status") == "completed", 1.0).otherwise(0.0)).alias("_ok"),
                          F.avg(dur).alias("avg_duration_s"),
                          F.avg(F.when(F.col("status") == "failed", 1.0).otherwise(0.0)).alias("failure_rate"))
    g = _every(entities, g)
    rate = F.coalesce(F.col("_ok") * F.lit(100.0), F.lit(0.0))
    st = F.when(rate > 80, "healthy").when(rate > 50, "warning").otherwise("critical")
    return g.select(*K, *by, F.coalesce("jobs", F.lit(0)).alias("jobs"), rate.alias("success_pct"),
                    F.coalesce("avg_duration_s", F.lit(0.0)).alias("avg_duration_s"),
                    F.coalesce("failure_rate", F.lit(0.0)).alias("failure_rate"), st.alias("status"))


def job_status(jobs: DataFrame, now, hours: int = 24, entities: DataFrame | None = None) -> DataFrame:
    """Each job type is judged on its own; one bad type makes the entity a warning."""
    s = job_stats(jobs, now, hours, by=("job_type",))
    bad = (F.col("success_pct") < 100.0 - JOB_FAILURE_RATE * 100.0) | (F.col("avg_duration_s") > JOB_SLOW_SECONDS)
    g = s.groupBy(*K).agg(F.sum("jobs").alias("jobs"), F.count(F.when(bad, 1)).alias("bad_types"),
                          F.min("success_pct").alias("worst_success_pct"), F.max("avg_duration_s").alias("slowest_type_s"))
    g = _every(entities, g)
    n = F.coalesce("bad_types", F.lit(0))
    return g.select(*K, F.coalesce("jobs", F.lit(0)).alias("jobs"), n.alias("bad_types"), "worst_success_pct", "slowest_type_s",
                    F.when(n > 0, "warning").otherwise("healthy").alias("status"))


# H6 ------------------------------------------------------------------------
def overall_status(components: dict[str, DataFrame]) -> DataFrame:
    """Worst status per entity over named component tables (K, status)."""
    parts = [df.select(*K, F.lit(name).alias("component"), "status") for name, df in components.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    sev = F.when(F.col("status") == "critical", 2).when(F.col("status") == "warning", 1).otherwise(0)
    g = u.groupBy(*K).agg(F.max(sev).alias("_s"), F.count(F.lit(1)).alias("components"))
    name = F.element_at(F.array(*[F.lit(s) for s in SEVERITY]), (F.col("_s") + 1).cast("int"))
    return g.select(*K, "components", name.alias("overall_status"))


# H7 ------------------------------------------------------------------------
def entity_summary(entities: DataFrame) -> DataFrame:
    """Devices per tenant with the range of their ids (the ids themselves stay rows: see ``discover_entities``)."""
    return entities.groupBy("tenant").agg(F.countDistinct("device_id").alias("devices"),
                                          F.min("device_id").alias("first_device"), F.max("device_id").alias("last_device"))
