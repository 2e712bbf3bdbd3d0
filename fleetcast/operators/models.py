"""Model operators on Spark.

Re-aimed for a cluster: one estimator per (device, application, resource) is not
fitted in a driver loop.  Impact models are a ridge regression per key, all of
them at once from grouped sufficient statistics (``gram``).  Tree models are one
distributed fit for the whole fleet, so the number of fits does not grow with it.
What sets the keys apart
is not an id column in the trees but a target encoding: the label's mean and
deviation per key, a grouped table of the training rows, and the fit learns the
label in units of its key.  Scoring joins the table back; a key that was never
trained has no row there and gets the default.  Training inputs are
checkpointed first (iterative fits re-read their input many times).  Tree
models need no feature scaling (splits are invariant to it).
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_lit, version_stamp
from . import gram
from .aggregate import STAT_COLUMNS, bin_start, regression_metrics
from .series import chrono_split, ts_folds

K = ["tenant", "device_id"]
RESOURCES = ["cpu", "mem", "disk"]
CALENDAR = ["hour", "day_of_week", "is_weekend"]

# Feature alignment.
STAT_TOKENS = ["mean", "std", "max", "min"]
WINDOW_TOKENS = ["5min", "15min", "30min", "60min"]
# keyword -> default value when no input column can stand in (checked in this order)
KEYWORD_DEFAULTS = [("cpu", 30.0), ("memory", 1000000000.0), ("heap", 1000000000.0), ("gc", 1000.0),
                    ("thread", 50.0), ("process", 400.0)]
# model settings
FOREST = {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "all", "maxBins": 128, "seed": 42}
BOOSTING = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "seed": 42}
NO_MODEL_IMPACT = 0.5
NO_MODEL_FORECAST = 50.0


# J6 ------------------------------------------------------------------------
def base_feature(name: str) -> str:
    """Drop statistic and window tokens: 'heap_used_mean_5min' -> 'heap_used'."""
    return "_".join(p for p in name.split("_") if p not in STAT_TOKENS and p not in WINDOW_TOKENS)


def calendar_values(now: _dt.datetime) -> dict[str, float]:
    return {"hour": float(now.hour), "day_of_week": float(now.weekday()), "is_weekend": float(now.weekday() >= 5)}


def resolve_feature(name: str, columns: Sequence[str], now: _dt.datetime) -> tuple[str, object]:
    """Where an expected feature comes from: ('col', name) or ('lit', value).

    The first source that applies, in this order: the column itself; the
    calendar; for compound names the column of the base name, then one whose
    name contains the base name or lies in it; a keyword's default; a calendar
    word inside the name; zero.
    """
    base = base_feature(name) if "_" in name else None
    calendar = calendar_values(now)
    alike = [] if base is None else ([base] if base in columns else []) + [c for c in columns if base in c or c in base]
    words = [v for w, v in KEYWORD_DEFAULTS if w in name.lower()] + [calendar[w] for w in CALENDAR if w in name]
    sources = ([("col", c) for c in columns if c == name] + [("lit", calendar[n]) for n in CALENDAR if n == name]
               + [("col", c) for c in alike] + [("lit", v) for v in words] + [("lit", 0.0)])
    return sources[0]


def align_features(df: DataFrame, expected: Sequence[str], now, keep: Sequence[str] = ()) -> DataFrame:
    """One ``select`` giving exactly the model's expected columns; nulls -> 0.

    Names are resolved once on the driver from the schema (metadata only),
    then every row is computed by column expressions.
    """
    if isinstance(now, str):
        now = _dt.datetime.fromisoformat(now)
    cols = [c for c in df.columns if c not in keep]
    out: list[Column] = []
    for name in expected:
        kind, src = resolve_feature(name, cols, now)
        e = F.col(f"`{src}`").cast("double") if kind == "col" else F.lit(float(src))
        out.append(F.coalesce(e, F.lit(0.0)).alias(name))
    return df.select(*keep, *out)


def wide(df: DataFrame, index: Sequence[str], names: Sequence[str], col: str = "feature_name",
         value: str = "value") -> DataFrame:
    """Tall -> wide with explicit names; absent cells 0."""
    return df.groupBy(*index).pivot(col, list(names)).agg(F.first(value)).na.fill(0.0, list(names))


# M3 ------------------------------------------------------------------------
def raw_training_set(app: DataFrame, scores: DataFrame, common: DataFrame, min_common: int = 10, period: str | None = None) -> DataFrame:
    """Raw metric means and calendar per (entity, application, minute) beside the impact labels, typed imputation.

    Wide in what is fixed, tall in what is not: one row for every (K,
    application, time, feature_name, resource_type).  Times are those where the
    application has metrics and a label for some resource, at least
    ``min_common`` of them.  A metric missing at a time takes its mean over the
    application's times, a calendar column its mode (the smallest of several),
    a label missing for a resource that the application has elsewhere the mean
    label of that resource; 0 for what is still missing.  ``imputed`` and
    ``label_imputed`` tell which.

    ``scores`` has one row per (K, application, resource_type), with ``period``
    per period too.  Metrics and labels of a time travel as maps in one row per
    (application, time), so time is in every shuffle key; what fills the gaps is
    a row per application, and columns become rows in the last step.
    """
    at = [bin_start("time", period).alias("period")] if period else []
    key = [*K, "application", *(["period"] if period else [])]
    per_app = [*K, "application"]
    span = common.select(*K, "common_start", "common_end")
    minute = app.join(span, K).where(F.col("time").between(F.col("common_start"), F.col("common_end")))
    minute = minute.groupBy(*per_app, "time", "metric_type").agg(F.avg("value").alias("value"))
    pairs = lambda name, value: F.map_from_entries(F.collect_list(F.struct(name, value)))
    labels = scores.groupBy(*key, "resource_type").agg(F.avg("impact_score").alias("label")).groupBy(*key).agg(pairs("resource_type", "label").alias("_y"))
    rows = minute.groupBy(*per_app, "time").agg(pairs("metric_type", "value").alias("_x")).select("*", *at).join(labels, key)
    # what a gap becomes, a row per application: means of metrics and labels, modes of the calendar
    tagged = lambda kind, entries: F.transform(
        entries, lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("name"), e["value"].alias("value")))
    calendar = F.transform(calendar_columns("time"), lambda e: F.struct(F.lit("calendar").alias("kind"), e["feature_name"].alias("name"), e["value"].alias("value")))
    cells = rows.select(*per_app, F.inline(F.concat(tagged("metric", F.map_entries("_x")), tagged("label", F.map_entries("_y")), calendar)))
    fills = cells.groupBy(*per_app, "kind", "name").agg(F.avg("value").alias("mean"), F.mode("value", deterministic=True).alias("mode"), F.count("*").alias("n"))
    of = lambda kind, value: F.map_from_entries(F.collect_list(F.when(F.col("kind") == kind, F.struct("name", value))))
    fills = fills.groupBy(*per_app).agg(of("metric", "mean").alias("_xm"), of("label", "mean").alias("_ym"), of("calendar", "mode").alias("_cm"),
                                        F.max(F.when(F.col("kind") == "calendar", F.col("n"))).alias("_n"))
    full = rows.join(fills.where(F.col("_n") >= min_common).drop("_n"), per_app)
    filled = lambda name, have, mean: F.struct(name.alias("name"), F.coalesce(have, mean, F.lit(0.0)).alias("value"), have.isNull().alias("gap"))
    x = F.transform(F.map_entries("_xm"), lambda e: filled(e["key"], F.col("_x")[e["key"]], e["value"]))
    c = F.transform(calendar_columns("time"), lambda e: filled(e["feature_name"], e["value"], F.col("_cm")[e["feature_name"]]))
    y = F.transform(F.map_entries("_ym"), lambda e: filled(e["key"], F.col("_y")[e["key"]], e["value"]))
    out = full.select(*per_app, "time", y.alias("_labels"), F.inline(F.concat(x, c)).alias("feature_name", "value", "imputed"))
    return out.select(*per_app, "time", "feature_name", "value", "imputed", F.inline("_labels").alias("resource_type", "label", "label_imputed"))


def calendar_columns(ts: str) -> Column:
    """Calendar features of a time as (feature_name, value) structs."""
    from ..functions.time import day_of_week, hour_of_day, is_weekend
    parts = zip(CALENDAR, (hour_of_day(ts), day_of_week(ts), is_weekend(ts)))
    return F.array(*[F.struct(F.lit(n).alias("feature_name"), c.cast("double").alias("value")) for n, c in parts])


# M4 / M5 -------------------------------------------------------------------
IMPACT_KEYS = [*K, "application", "resource_type"]
SYSTEM_KEYS = [*K, "resource_type"]
# what a model is for decides its keys and its default, not which estimator it is
KEYS = {"impact": IMPACT_KEYS, "system": SYSTEM_KEYS}
DEFAULTS = {"impact": NO_MODEL_IMPACT, "system": NO_MODEL_FORECAST}
PER_KEY = "ridge"


@dataclass
class FittedModels:
    """The fitted models of a purpose and their metrics: a pipeline over all keys with their encoding, or a model per key in ``linear``."""
    kind: str
    features: list[str]
    purpose: str
    model: PipelineModel | None = None
    stats: DataFrame | None = None
    metrics: DataFrame | None = None
    linear: DataFrame | None = None


def label_stats(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target encoding: rows, mean and population deviation of the label per key."""
    return rows.where(F.col("label").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("label").alias("label_mean"), F.stddev_pop("label").alias("label_std"))


def _unit() -> Column:
    """A key's unit: its deviation, or 1 where the label does not vary."""
    return F.when(F.col("label_std") > 0, F.col("label_std")).otherwise(F.lit(1.0))


def in_units(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``target``: the label in units of its key."""
    j = rows.join(stats.drop("n_rows"), list(keys))
    return j.withColumn("target", (F.col("label") - F.col("label_mean")) / _unit()).drop("label_mean", "label_std")


def _estimator(kind: str):
    args = {"featuresCol": "features", "labelCol": "target", "predictionCol": "unit_prediction"}
    return RandomForestRegressor(**args, **FOREST) if kind == "random_forest" else GBTRegressor(**args, **BOOSTING)


def _pipeline(kind: str, features: list[str]) -> Pipeline:
    # the resource is the one bounded category (three levels); no entity or application id enters the trees
    return Pipeline(stages=[StringIndexer(inputCol="resource_type", outputCol="resource_idx", handleInvalid="keep"),
                            VectorAssembler(inputCols=["resource_idx", *features], outputCol="features", handleInvalid="keep"),
                            _estimator(kind)])


def score(fm: FittedModels, rows: DataFrame) -> DataFrame:
    """Adds ``prediction``: the key's own model, or the fleet's back from units, or the default where the key was never trained."""
    default = F.lit(DEFAULTS[fm.purpose])
    if fm.linear is not None:
        own = fm.linear.where(F.col("fold") == gram.FINAL).select(*KEYS[fm.purpose], "intercept", "coef")
        j = rows.join(own, KEYS[fm.purpose], "left")
        return j.withColumn("prediction", F.coalesce(gram.linear(fm.features), default)).drop("intercept", "coef")
    if fm.model is None or fm.stats is None:
        return rows.withColumn("prediction", default)
    j = fm.model.transform(rows).join(fm.stats.drop("n_rows"), KEYS[fm.purpose], "left")
    value = F.coalesce(F.col("label_mean") + F.col("unit_prediction") * _unit(), default)
    return j.withColumn("prediction", value).drop("label_mean", "label_std", "features", "resource_idx", "unit_prediction")


def _materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage before iterative fitting: a reliable checkpoint in the shared folder."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _importance(model: PipelineModel, features: list[str]) -> str:
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return json.dumps(dict(zip(["resource_idx", *features], imp)), sort_keys=True)


def _fit(fm: FittedModels, rows: DataFrame) -> FittedModels:
    """A pipeline on rows (keys, features, label) and the encoding it was fitted in."""
    stats = _materialize(label_stats(rows, KEYS[fm.purpose]))
    model = _pipeline(fm.kind, fm.features).fit(in_units(rows, stats, KEYS[fm.purpose]))
    return FittedModels(fm.kind, fm.features, fm.purpose, model, stats)


def _key_metrics(fm: FittedModels, rows: DataFrame) -> DataFrame:
    """M12 per key beside the error of always saying the key's training mean."""
    keys = KEYS[fm.purpose]
    scored = score(fm, rows)
    m = regression_metrics(scored, keys, "label", "prediction")
    base = scored.join(fm.stats.drop("n_rows", "label_std"), keys).groupBy(*keys).agg(
        F.avg(F.abs(F.col("label") - F.col("label_mean"))).alias("mean_mae"))
    return m.join(base, keys, "left")


def _no_metrics(rows: DataFrame) -> DataFrame:
    """Metrics of no model: no rows."""
    keys = [c for c in IMPACT_KEYS if c in rows.columns]
    return rows.where("false").select(*keys, F.lit(0).cast("long").alias("n_rows"), *[
        F.lit(None).cast("double").alias(c) for c in ("label_mean", "label_std", "mae", "rmse", "r2", "mean_mae")], F.lit(0).cast("long").alias("folds"),
        F.lit(None).cast("string").alias("feature_importance"))


MEANS = ["mae", "rmse", "r2", "mean_mae"]


def impact_rows(train: DataFrame, names: Sequence[str]) -> DataFrame:
    """M1's tall set as one row per (entity, application, time, resource) with a column for each feature name."""
    return wide(train, [*K, "application", "time", "resource_type", "label"], list(names))


def fit_impact_models(train: DataFrame, names: Sequence[str], model: str = PER_KEY, cv_splits: int = 5) -> FittedModels:
    """M4: features -> impact, expanding time folds per (entity, application), then a fit on all rows.

    ``train`` is the tall M1 set.  ``model`` 'ridge' is a model for every
    (entity, application, resource), from grouped sufficient statistics
    (``gram``); 'random_forest' and 'gradient_boosting' are one fit for the
    fleet in units of each key.  Metrics per key are means over the folds that
    could be run, whose number stands beside them.
    """
    fm = FittedModels(model, list(names), "impact")
    d = _materialize(impact_rows(train, names))
    if model == PER_KEY:
        return _fit_per_key(fm, d, cv_splits)
    if d.isEmpty():
        fm.metrics = _no_metrics(d)
        return fm
    return _fit_fleet(fm, d, cv_splits)


def _fit_per_key(fm: FittedModels, d: DataFrame, cv_splits: int) -> FittedModels:
    keys = [*K, "application", "time"]
    if cv_splits > 1:
        blocks = gram.time_blocks(d.select(*keys).distinct(), [*K, "application"], "time", cv_splits)
        d = _materialize(d.join(blocks, keys))
    else:
        d = d.withColumn("block", F.lit(0))
    fm.linear = _materialize(gram.fit_per_key(d, IMPACT_KEYS, fm.features))
    final = fm.linear.where(F.col("fold") == gram.FINAL)
    # the rows of a block are tested by the model of the blocks before
    tested = d.where("block > 0").withColumn("fold", F.col("block") - 1).join(fm.linear, [*IMPACT_KEYS, "fold"])
    tested = tested.withColumn("prediction", gram.linear(fm.features))
    per_fold = regression_metrics(tested, [*IMPACT_KEYS, "fold"], "label", "prediction")
    base = tested.groupBy(*IMPACT_KEYS, "fold").agg(F.avg(F.abs(F.col("label") - F.col("label_mean"))).alias("mean_mae"))
    m = per_fold.join(base, [*IMPACT_KEYS, "fold"]).groupBy(*IMPACT_KEYS).agg(
        *[F.avg(c).alias(c) for c in MEANS], F.count(F.lit(1)).alias("folds"))
    names = F.array(*map(F.lit, fm.features))
    got = final.select(*IMPACT_KEYS, "n_rows", "label_mean", "label_std",
                       F.to_json(F.map_from_arrays(names, "importance")).alias("feature_importance"))
    fm.metrics = _materialize(got.join(m, IMPACT_KEYS, "left").withColumn("folds", F.coalesce("folds", F.lit(0))))
    return fm


def _fit_fleet(fm: FittedModels, d: DataFrame, cv_splits: int) -> FittedModels:
    per_fold = []
    if cv_splits > 1:
        keys = [*K, "application", "time"]
        folds = _materialize(ts_folds(d.select(*keys).distinct(), [*K, "application"], "time", cv_splits))
        for f in range(cv_splits):
            fr = folds.where(F.col("fold") == f)
            tr = d.join(fr.where(F.col("role") == "train").select(*keys), keys, "left_semi")
            te = d.join(fr.where(F.col("role") == "test").select(*keys), keys, "left_semi")
            if tr.isEmpty() or te.isEmpty():
                continue  # counted: the result says over how many folds its means go
            per_fold.append(_key_metrics(_fit(fm, tr), te))
    fitted = _fit(fm, d)
    got = fitted.stats.select(*IMPACT_KEYS, "n_rows", "label_mean", "label_std")
    if per_fold:
        u = per_fold[0]
        for x in per_fold[1:]:
            u = u.unionByName(x)
        m = u.groupBy(*IMPACT_KEYS).agg(*[F.avg(c).alias(c) for c in MEANS], F.count(F.lit(1)).alias("folds"))
        got = got.join(m, IMPACT_KEYS, "left")
    else:
        got = got.select("*", *[F.lit(None).cast("double").alias(c) for c in MEANS], F.lit(0).cast("long").alias("folds"))
    fitted.metrics = _materialize(got.withColumn("folds", F.coalesce("folds", F.lit(0)))
                                  .withColumn("feature_importance", F.lit(_importance(fitted.model, fm.features))))
    return fitted


def stack_resources(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Wide (cpu, mem, disk) labels -> one row per resource with ``label``."""
    pairs = F.array(*[F.struct(F.lit(r).alias("resource_type"), F.col(r).cast("double").alias("label")) for r in RESOURCES])
    return df.select(*keep, F.inline(pairs))


def system_rows(train: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """M5's rows: one per (entity, time, resource), split by time per entity."""
    return stack_resources(chrono_split(train, K, "time", train_fraction), [*K, "time", "is_train", *STAT_COLUMNS, *CALENDAR])


def fit_system_models(train: DataFrame, train_fraction: float = 0.8) -> FittedModels:
    """M5: impact statistics + calendar -> utilisation, chronological hold-out per entity, metrics per (entity, resource)."""
    fm = FittedModels("gradient_boosting", [*STAT_COLUMNS, *CALENDAR], "system")
    rows = _materialize(system_rows(train, train_fraction).where(F.col("label").isNotNull()))
    tr, te = rows.where(F.col("is_train")), rows.where(~F.col("is_train"))
    if tr.isEmpty():
        fm.metrics = _no_metrics(rows)
        return fm
    fm = _fit(fm, tr)
    met = _key_metrics(fm, te).drop("n")
    fm.metrics = _materialize(fm.stats.select(*SYSTEM_KEYS, "n_rows").join(met, SYSTEM_KEYS, "left")
                              .withColumn("folds", F.lit(1).cast("long"))
                              .withColumn("feature_importance", F.lit(_importance(fm.model, fm.features))))
    return fm


# M6 ------------------------------------------------------------------------
# What stands for the application in rows of system models and of forecast accuracy.
SYSTEM_APPLICATION = "system"
ACCURACY_APPLICATION, ACCURACY_TYPE = "system", "system_performance"


def model_performance_rows(fm: FittedModels, trained_at) -> DataFrame:
    """Rows of the model-performance table, one per (entity, application, resource) model."""
    t = ts_lit(trained_at) if isinstance(trained_at, (str, _dt.datetime)) else trained_at
    application = F.col("application") if "application" in fm.metrics.columns else F.lit(SYSTEM_APPLICATION)
    return fm.metrics.select(*K, application.alias("application"), "resource_type", F.lit(fm.kind).alias("model_type"),
                             "mae", "rmse", F.col("r2").alias("r2_score"), "feature_importance", t.alias("trained_at"),
                             version_stamp(t).alias("version"))


# What stands for the application, resource and model type in the row of a training run.
RUN_APPLICATION, RUN_RESOURCE, RUN_TYPE, RUN_METHOD = "streaming_metadata", "training_info", "cache_based", "streaming_cache"


def run_metadata_rows(impacts: DataFrame, features: DataFrame, cache_key: str, trained_at) -> DataFrame:
    """One model-performance row per entity and training run: its counts as JSON in ``feature_importance``.

    ``impact_records`` and ``feature_records`` are the rows of the two tables,
    ``applications`` the distinct applications of the impacts; entities of either
    table have a row.
    """
    t = ts_lit(trained_at) if isinstance(trained_at, (str, _dt.datetime)) else trained_at
    # distinct applications in two steps, so that the second counts a row per application
    n = impacts.groupBy(*K, "application").agg(F.count(F.lit(1)).alias("_r")).groupBy(*K).agg(
        F.sum("_r").alias("impact_records"), F.count("application").alias("applications"))
    m = features.groupBy(*K).agg(F.count(F.lit(1)).alias("feature_records"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    counts = F.to_json(F.struct(F.lit(cache_key).alias("cache_key"), zero("impact_records"), zero("feature_records"), zero("applications"),
                                F.lit(RUN_METHOD).alias("training_method")))
    none = F.lit(0.0)
    return n.join(m, K, "full").select(
        *K, F.lit(RUN_APPLICATION).alias("application"), F.lit(RUN_RESOURCE).alias("resource_type"), F.lit(RUN_TYPE).alias("model_type"),
        none.alias("mae"), none.alias("rmse"), none.alias("r2_score"), counts.alias("feature_importance"), t.alias("trained_at"),
        F.concat(F.lit(f"streaming_{cache_key}_"), version_stamp(t)).alias("version"))


def importances(performance: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, feature_name, importance) out of the importance JSON of model-performance rows (T1's input)."""
    parsed = F.from_json("feature_importance", "map<string,double>")
    return performance.select(*keys, F.explode(parsed).alias("feature_name", "importance"))


def accuracy_rows(performance: DataFrame, checked_at) -> DataFrame:
    """A16's forecast accuracy as rows of the model-performance table (version with a '_perf' suffix)."""
    t = ts_lit(checked_at) if isinstance(checked_at, (str, _dt.datetime)) else checked_at
    return performance.select(*K, F.lit(ACCURACY_APPLICATION).alias("application"), "resource_type",
                              F.lit(ACCURACY_TYPE).alias("model_type"), "mae", "rmse", F.col("r2").alias("r2_score"),
                              F.lit(None).cast("string").alias("feature_importance"), t.alias("trained_at"),
                              F.concat(version_stamp(t), F.lit("_perf")).alias("version"))


# M7 ------------------------------------------------------------------------
def _per_resource(x: DataFrame) -> DataFrame:
    return x.withColumn("resource_type", F.explode(F.array(*[F.lit(r) for r in RESOURCES])))


def predict_impacts(fm: FittedModels, profile: DataFrame, now) -> DataFrame:
    """Impact per (entity, application, resource) from the latest profile; 0.5 for a key without a trained model.

    ``profile`` is wide: (tenant, device_id, application, <metric columns>).
    """
    keep = [*K, "application"]
    x = _per_resource(align_features(profile, fm.features, now, keep))
    return score(fm, x).select(*keep, "resource_type", F.col("prediction").alias("impact_score"))


# M10 -----------------------------------------------------------------------
def forecast(fm: FittedModels, serving_stats: DataFrame, grid: DataFrame) -> DataFrame:
    """Utilisation forecast on the grid: A7 statistics x calendar of each target time.

    One ``transform`` over the whole grid x resources (no per-point loop);
    50.0 for an (entity, resource) without a trained model.
    """
    from ..functions.time import day_of_week, hour_of_day, is_weekend
    x = grid.join(serving_stats, K).select(
        *K, "step_index", "target_time", *STAT_COLUMNS, hour_of_day("target_time").alias("hour"),
        day_of_week("target_time").alias("day_of_week"), is_weekend("target_time").alias("is_weekend"))
    return score(fm, _per_resource(x)).select(
        *K, "step_index", "target_time", "resource_type", F.col("prediction").alias("predicted_value"))


# M11 -----------------------------------------------------------------------
def model_path(root: str, purpose: str, tenant: str | None = None, device: str | None = None) -> str:
    return os.path.join(root, purpose, tenant or "_generic", device or "_generic")


def save_models(fm: FittedModels, root: str, tenant: str | None = None, device: str | None = None) -> str | None:
    """Write the fitted models and their feature list (overwrite) for a device, a tenant or everyone."""
    if fm.model is None and fm.linear is None:
        return None
    p = model_path(root, fm.purpose, tenant, device)
    if fm.linear is not None:
        spark = fm.linear.sparkSession
        fm.linear.write.mode("overwrite").parquet(f"{p}/linear")
    else:
        spark = fm.stats.sparkSession
        fm.model.write().overwrite().save(f"{p}/pipeline")
        fm.stats.write.mode("overwrite").parquet(f"{p}/encoding")
    # written last: a model is there once its feature list is
    (spark.createDataFrame([(i, f, fm.kind) for i, f in enumerate(fm.features)], "position int, feature string, kind string")
     .coalesce(1).write.mode("overwrite").parquet(f"{p}/features"))
    return p


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_models(spark, root: str, purpose: str, tenant: str | None = None, device: str | None = None) -> tuple[FittedModels, str | None]:
    """The device's model, else the tenant's, else the generic one, and where it was; none stored -> defaults at scoring.

    Only a path that does not exist passes on to the next candidate; any
    other failure to read a stored model is raised.
    """
    for t, d in dict.fromkeys([(tenant, device), (tenant, None), (None, None)]):
        p = model_path(root, purpose, t, d)
        if _exists(spark, f"{p}/features"):
            listed = spark.read.parquet(f"{p}/features").orderBy("position").collect()
            names, kind = [r.feature for r in listed], listed[0].kind
            if kind == PER_KEY:
                return FittedModels(kind, names, purpose, linear=spark.read.parquet(f"{p}/linear")), p
            return FittedModels(kind, names, purpose, PipelineModel.load(f"{p}/pipeline"), spark.read.parquet(f"{p}/encoding")), p
    return FittedModels(PER_KEY if purpose == "impact" else "gradient_boosting", [], purpose), None
