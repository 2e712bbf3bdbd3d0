"""Relational tables: fixtures derived from ``events``, schemas, sinks.

Every derived table is a deterministic function of the driver tables, so it
grows with them: predictions from the resource table, model performance from
the metric tables, jobs and configurations from the events.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import version_stamp
from .fixtures import events, fx_points, memo_plan

K = ["tenant", "device_id"]

PREDICTION_COLUMNS = ["tenant", "device_id", "prediction_time", "target_time", "resource_type", "predicted_value",
                      "actual_value", "error", "model_version", "confidence_score", "batch_id"]
PREDICTION_SCHEMA = ("tenant string, device_id string, prediction_time timestamp, target_time timestamp, resource_type string, "
                     "predicted_value double, actual_value double, error double, model_version string, confidence_score double, "
                     "target_date date, batch_id string")
ALERT_COLUMNS = ["tenant", "device_id", "resource_type", "threshold", "crossing_time", "time_to_threshold",
                 "current_value", "predicted_value", "is_notified", "notified_at", "alert_level", "created_at",
                 "batch_id"]

# Alert limits per resource (percent).
THRESHOLDS = [("cpu", 80.0), ("mem", 80.0), ("disk", 85.0)]
# Job types of the fixture job log, by user_id % 5.
JOB_TYPES = ["processing", "training", "prediction", "cleanup", "discovery"]
# Configuration types and roll-up methods of the fixture configurations.
CONFIG_TYPES = ["time_alignment", "collection", "aggregation", "excluded", "model", "alert"]
ROLLUP_METHODS = ["max", "last", "avg", "mean"]


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "resource_type string, threshold double")


@memo_plan
def _canon_res(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.clean import canonical_resources
    from .points import resource_metrics, scan_points
    return canonical_resources(resource_metrics(scan_points(fx_points(spark, sf))))


@memo_plan
def fx_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Two forecast batches per resource minute (lag 1 at -30 min, lag 2 at -60 min) plus ties."""
    res = _canon_res(spark, sf)
    w = Window.partitionBy(*K, "resource_type").orderBy("time")
    base = res.select(*K, "resource_type", F.col("time").alias("target_time"),
                      F.lag("value", 1).over(w).alias("lag1"), F.lag("value", 2).over(w).alias("lag2"))
    half = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    hour = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(60))
    tie = (F.minute("target_time") % 7) == 0
    rows = F.array(
        F.struct((F.col("target_time") - half).alias("prediction_time"), F.col("lag1").alias("predicted_value")),
        F.struct((F.col("target_time") - hour).alias("prediction_time"), F.col("lag2").alias("predicted_value")),
        F.when(tie, F.struct((F.col("target_time") - half).alias("prediction_time"),
                             (F.col("lag1") + F.lit(1.0)).alias("predicted_value"))))
    ex = base.select(*K, "resource_type", "target_time", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r"))
    ex = ex.where(F.col("r.predicted_value").isNotNull())
    return ex.select(*K, F.col("r.prediction_time").alias("prediction_time"), "target_time", "resource_type",
                     F.col("r.predicted_value").alias("predicted_value"),
                     F.lit(None).cast("double").alias("actual_value"), F.lit(None).cast("double").alias("error"),
                     version_stamp("r.prediction_time").alias("model_version"),
                     F.lit(None).cast("double").alias("confidence_score"),
                     version_stamp("r.prediction_time").alias("batch_id"))


@memo_plan
def fx_model_performance(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (entity, application, resource, hour): app metric vs resource error statistics."""
    from ..operators.clean import canonical_resources  # noqa: F401
    from .points import app_metrics, scan_points
    app = app_metrics(scan_points(fx_points(spark, sf)))
    res = _canon_res(spark, sf)
    j = app.select(*K, "time", "application", F.col("value").alias("x")).join(
        res.select(*K, "time", "resource_type", F.col("value").alias("y")), K + ["time"])
    d = F.col("x") - F.col("y")
    g = j.groupBy(*K, "application", "resource_type", F.date_trunc("hour", "time").alias("trained_at")).agg(
        F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"),
        F.coalesce(F.regr_r2("y", "x"), F.lit(0.0)).alias("r2_score"))
    return g.select(*K, "application", "resource_type", F.lit("gradient_boosting").alias("model_type"),
                    "mae", "rmse", "r2_score", F.lit("{}").alias("feature_importance"), "trained_at",
                    version_stamp("trained_at").alias("version"))


@memo_plan
def fx_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """One job per event: type by user, duration = value seconds, failed for error events."""
    ev = events(spark, sf)
    n = F.col("user_id") % 2
    jt = F.element_at(F.array(*[F.lit(x) for x in JOB_TYPES]), (F.col("user_id") % 5 + 1).cast("int"))
    end = F.timestamp_micros(F.unix_micros("ts") + (F.col("value") * F.lit(1_000_000)).cast("long"))
    return ev.select(F.concat(F.lit("t-"), n.cast("string")).alias("tenant"),
                     F.concat(F.lit("dev-"), n.cast("string")).alias("device_id"),
                     jt.alias("job_type"), F.col("ts").alias("start_time"), end.alias("end_time"),
                     F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"))


@memo_plan
def fx_configurations(spark: SparkSession, sf: str) -> DataFrame:
    """One configuration row per event (repeated keys, inactive rows, null server, JSON, CSV)."""
    ev = events(spark, sf)
    eid = F.col("event_id")
    ctype = F.element_at(F.array(*[F.lit(x) for x in CONFIG_TYPES]), (eid % 6 + 1).cast("int"))
    sub = F.floor(eid / 6) % 3
    res = F.element_at(F.array(F.lit("cpu"), F.lit("mem"), F.lit("disk")), (sub + 1).cast("int"))
    key = (F.when(ctype == "aggregation", res)
           .when(ctype == "alert", F.concat(res, F.lit("_threshold")))
           .when(ctype == "excluded", F.when(sub == 2, "gateways").otherwise("devices"))
           .otherwise(F.concat(ctype, F.lit("_"), sub.cast("string"))))
    method = F.element_at(F.array(*[F.lit(x) for x in ROLLUP_METHODS]), (F.col("user_id") % 4 + 1).cast("int"))
    csv = F.element_at(F.array(F.lit(" dev-1 , ,"), F.lit("dev-0 ,app-9"), F.lit(""), F.lit("app-1, app-2")),
                       (F.col("user_id") % 4 + 1).cast("int"))
    val = (F.when(ctype == "aggregation",
                  F.when(eid % 4 == 0, F.concat(F.lit('{"method": "'), method, F.lit('", "reason": "r'),
                                                eid.cast("string"), F.lit('"}'))).otherwise(method))
           .when(ctype == "excluded", csv)
           .otherwise(F.round("value", 0).cast("long").cast("string")))
    n = F.col("user_id") % 2
    return ev.select(eid.alias("id"), F.concat(F.lit("t-"), n.cast("string")).alias("tenant"),
                     F.when(eid % 10 == 0, F.lit(None).cast("long")).otherwise(n).alias("server_no"),
                     ctype.alias("config_type"), key.alias("config_key"), val.alias("config_value"),
                     (eid % 13 != 0).alias("is_active"), F.col("ts").alias("updated_at"))


@memo_plan
def fx_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Registered entities: those of tenant t-0 seen in the points."""
    p = fx_points(spark, sf).where(F.col("tenant") == "t-0")
    return p.select(*K).distinct().select(*K, F.concat(F.lit("srv-"), F.col("device_id")).alias("server_name"),
                                         F.lit(True).alias("is_active"),
                                         F.lit(None).cast("timestamp").alias("registered_at"))


@memo_plan
def fx_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alert rows for newest-batch forecasts at or above their limit."""
    p = fx_predictions(spark, sf)
    half = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    p = p.where(F.col("prediction_time") == F.col("target_time") - half)
    p = p.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*K, "resource_type", "target_time").orderBy("predicted_value"))).where("_rn = 1")
    j = p.join(F.broadcast(thresholds(spark)), "resource_type").where(F.col("predicted_value") >= F.col("threshold"))
    notified = (F.minute("target_time") % 3) == 0
    return j.select(*K, "resource_type", "threshold", F.col("target_time").alias("crossing_time"),
                    F.lit(0.5).alias("time_to_threshold"), F.col("predicted_value").alias("current_value"),
                    "predicted_value", notified.alias("is_notified"),
                    F.when(notified, F.col("target_time")).alias("notified_at"),
                    F.when(F.col("predicted_value") >= F.col("threshold") + 10, "critical").otherwise("warning")
                    .alias("alert_level"),
                    F.col("prediction_time").alias("created_at"), "batch_id")


# S5 ------------------------------------------------------------------------
def new_entities(discovered: DataFrame, registry: DataFrame) -> DataFrame:
    """Entities not yet registered (insert-if-absent), plus whether the tenant is new too."""
    new_dev = discovered.select(*K).distinct().join(registry.select(*K), K, "left_anti")
    known_t = registry.select("tenant").distinct().withColumn("_known", F.lit(True))
    return new_dev.join(known_t, "tenant", "left").select(
        "tenant", "device_id", F.col("_known").isNull().alias("new_tenant"))


# S6 / S7 -------------------------------------------------------------------
def to_prediction_rows(fc: DataFrame, run_time, model_version: str | None = None) -> DataFrame:
    """Forecast (K, resource_type, target_time, predicted_value) -> prediction table rows."""
    from ..functions.time import ts_lit
    rt = ts_lit(run_time) if isinstance(run_time, (str, _dt.datetime)) else run_time
    stamp = version_stamp(rt)
    mv = F.lit(model_version) if model_version else stamp
    return fc.select(*K, rt.alias("prediction_time"), "target_time", "resource_type",
                     F.col("predicted_value").cast("double").alias("predicted_value"),
                     F.lit(None).cast("double").alias("actual_value"), F.lit(None).cast("double").alias("error"),
                     mv.alias("model_version"), F.lit(None).cast("double").alias("confidence_score"),
                     stamp.alias("batch_id"))


def store_predictions(rows: DataFrame, path: str) -> None:
    """S6 sink: prediction rows by target date and run; see ``write_batches``."""
    write_batches(rows.withColumn("target_date", F.to_date("target_time")), path, ["target_date"])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored prediction rows; the schema keeps batch ids, which are folder names, from being read as numbers."""
    return spark.read.schema(PREDICTION_SCHEMA).parquet(path)


def write_batches(rows: DataFrame, path: str, partition_by: Sequence[str] = (), batch: str = "batch_id") -> None:
    """Append the batches in ``rows``, each in folders of its own, which are overwritten if they are there.

    A run that is repeated with its batch id, after a failure or by mistake,
    leaves its rows once.  Folders of other batches are not touched.
    """
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by, batch).parquet(path))


def to_alert_rows(alerts: DataFrame, run_time) -> DataFrame:
    """Threshold crossings -> alert table rows (not yet notified)."""
    from ..functions.time import ts_lit
    rt = ts_lit(run_time) if isinstance(run_time, (str, _dt.datetime)) else run_time
    level = F.when(F.col("predicted_value") >= F.col("threshold") + 10, "critical").otherwise("warning")
    return alerts.select(*K, "resource_type", "threshold", "crossing_time", "time_to_threshold", "current_value",
                         "predicted_value", F.lit(False).alias("is_notified"),
                         F.lit(None).cast("timestamp").alias("notified_at"), level.alias("alert_level"),
                         rt.alias("created_at"), version_stamp(rt).alias("batch_id"))


# S8 ------------------------------------------------------------------------
def profile(df: DataFrame, keys: list[str], counts: list[str], value: str) -> DataFrame:
    """Snapshot profile per key: rows, distinct counts, min / max / mean of ``value``."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.countDistinct(c).alias(f"n_{c}") for c in counts],
        F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.avg(value).alias("mean_value"))


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a snapshot (parquet, overwrite) and read it back, cutting the lineage."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass
class Snapshot:
    """A stored table with what was written about it, and whether it was there already."""
    rows: DataFrame
    meta: dict
    reused: bool


def snapshot(spark: SparkSession, path: str, build: Callable[[], DataFrame], now, counts: list[str], ttl_hours: float = 6.0,
             partition_by: list[str] | None = None) -> Snapshot:
    """The newest snapshot under ``path`` if it is younger than the TTL, else a new one from ``build``.

    Each snapshot has a folder of its own; beside them a metadata table holds
    one row a snapshot (creation time, folder, rows, distinct counts).  The
    metadata row is written last, so a half-written snapshot is never used.
    """
    meta_path = f"{path}/metadata"
    p = spark._jvm.org.apache.hadoop.fs.Path(meta_path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        meta = spark.read.parquet(meta_path).withColumn("age_ok", F.unix_micros(_ts_of(now)) - F.unix_micros("created_at") < int(ttl_hours * 3.6e9))
        last = meta.where("age_ok").orderBy(F.desc("created_at")).limit(1).select(
            "*", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_text")).collect()
        if last:
            m = last[0].asDict()
            return Snapshot(spark.read.parquet(m["folder"]), m | {"created_at": m["created_text"]}, True)
    folder = f"{path}/rows-{uuid.uuid4().hex}"
    rows = materialize(build(), folder, partition_by)
    found = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.countDistinct(c).alias(f"n_{c}") for c in counts])
    found.select(_ts_of(now).alias("created_at"), F.lit(folder).alias("folder"), "*").coalesce(1).write.mode("append").parquet(meta_path)
    m = (spark.read.parquet(meta_path).where(F.col("folder") == folder)
         .select("*", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_text")).first().asDict())
    return Snapshot(rows, m | {"created_at": m["created_text"]}, False)


def _ts_of(v):
    from ..functions.time import ts_lit
    return ts_lit(v) if isinstance(v, (str, _dt.datetime)) else v


def is_fresh(meta: DataFrame, now, ttl_hours: float = 6.0, created: str = "created_at") -> DataFrame:
    """Flag snapshot metadata rows younger than the TTL."""
    from ..functions.time import ts_lit
    now_c = ts_lit(now) if isinstance(now, (str, _dt.datetime)) else now
    age_h = (F.unix_micros(now_c) - F.unix_micros(F.col(created))) / F.lit(3_600_000_000.0)
    return meta.withColumn("is_fresh", age_h < F.lit(ttl_hours))


# S9 ------------------------------------------------------------------------
def read_table(spark: SparkSession, root: str, name: str, jdbc: dict | None = None) -> DataFrame:
    """Parquet table under ``root``; with ``jdbc`` options the same call reads over JDBC."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.read.parquet(os.path.join(root, name))


def append_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
                 jdbc: dict | None = None) -> None:
    if jdbc:
        df.write.format("jdbc").options(dbtable=name, **jdbc).mode("append").save()
        return
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(os.path.join(root, name))
