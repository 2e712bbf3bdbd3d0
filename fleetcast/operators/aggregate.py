"""Aggregations.

All groupings lead with the entity key ``K = (tenant, device_id)``; Spark
does the partial aggregation map-side before the shuffle on the group key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = ["tenant", "device_id"]
RESOURCES = ["cpu", "mem", "disk"]


def pearson(x: Column | str, y: Column | str) -> Column:
    """Guarded Pearson correlation: null for a constant side or a single pair.

    ``corr`` raises under ANSI on zero variance; ``covar_pop / (sd*sd)`` with
    ``try_divide`` yields null instead.
    """
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


# A1 ------------------------------------------------------------------------
def every_micros(every: str | int) -> int:
    """'1 minute', '30 seconds', '1 hour', '1 day', '2 weeks' or an int of minutes -> micros."""
    if isinstance(every, int):
        return every * 60_000_000
    n, unit = every.split()
    mult = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}[unit.rstrip("s")]
    return int(n) * mult


def bin_start(ts: Column | str, every: str | int, end: bool = False) -> Column:
    """Epoch-aligned tumbling bin start (or end) - the bins of ``window(ts, every)``."""
    n = every_micros(every)
    c = F.col(ts) if isinstance(ts, str) else ts
    start = F.floor(F.unix_micros(c) / F.lit(n)).cast("long") * F.lit(n)
    return F.timestamp_micros(start + F.lit(n) if end else start)


def window_mean(df: DataFrame, every: str | int, keys: Sequence[str], ts: str = "ts", value: str = "value",
                label: str = "end") -> DataFrame:
    """Tumbling mean per series; empty windows are simply absent.

    ``label='end'`` names a window by its end (the points source's
    convention), ``'start'`` by its start (resample convention).  The label
    is plain arithmetic on the timestamp, so the grouping key is a flat
    column that later groupings on the same key (A2) can reuse without a
    second shuffle.
    """
    t = bin_start(ts, every, end=(label == "end"))
    return df.groupBy(*keys, t.alias("time")).agg(F.avg(value).alias(value)).select(*keys, "time", value)


# A2 ------------------------------------------------------------------------
def mean_by_key(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Unweighted mean of per-series means after re-keying."""
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


# A3 ------------------------------------------------------------------------
def resource_rollup(res: DataFrame, every: str, methods: DataFrame | None = None, ts: str = "ts") -> DataFrame:
    """Per-resource roll-up with a configurable method: max, last or avg.

    ``methods`` has (resource_type, method) and optionally ``tenant``; a
    resource without a configured method falls back to the default (cpu
    max, mem last, disk last), anything else to avg.
    """
    from .config import DEFAULT_ROLLUP
    agg = res.groupBy(*K, "resource_type", bin_start(ts, every, end=True).alias("time")).agg(
        F.max("value").alias("v_max"), F.max_by("value", F.struct(F.col(ts), F.col("value"))).alias("v_last"), F.avg("value").alias("v_avg"))
    default = None
    for r, m in DEFAULT_ROLLUP:
        default = (F.when(F.col("resource_type") == r, F.lit(m)) if default is None
                   else default.when(F.col("resource_type") == r, F.lit(m)))
    method = default
    j = agg
    if methods is not None:
        on = [c for c in ("tenant", "resource_type") if c in methods.columns]
        j = agg.join(methods.select(*on, F.col("method").alias("_cfg")), on, "left")
        method = F.coalesce(F.col("_cfg"), default)
    method = F.coalesce(method, F.lit("avg"))
    value = (F.when(method == "max", F.col("v_max")).when(method == "last", F.col("v_last"))
             .otherwise(F.col("v_avg")))
    return j.select(*K, "resource_type", "time", method.alias("method"), value.alias("value"))


# A4 ------------------------------------------------------------------------
def pivot_mean(df: DataFrame, index: Sequence[str], col: str, value: str, values: Sequence) -> DataFrame:
    """Wide mean table; ``values`` must be given so no extra job collects them."""
    return df.groupBy(*index).pivot(col, list(values)).agg(F.avg(value))


# A5 ------------------------------------------------------------------------
def metric_correlations(app_grid: DataFrame, res_grid: DataFrame, bucket: str | None = None) -> DataFrame:
    """Pearson r per (K, application, metric_type, resource_type) on shared minutes.

    Inputs are tall and non-null: app (K, time, application, metric_type,
    value) and resources (K, time, resource_type, value).  The join key
    (K, time) spreads a hot entity over its minutes; aggregation is partial
    before the shuffle on the 5-column group key.  With ``bucket`` (e.g.
    '1 hour') there is one r per period (``period`` column, bin start).
    """
    a = app_grid.where(F.col("value").isNotNull()).select(*K, "time", "application", "metric_type",
                                                           F.col("value").alias("x"))
    r = res_grid.where(F.col("value").isNotNull()).select(*K, "time", "resource_type", F.col("value").alias("y"))
    pairs = a.join(r, K + ["time"])
    period = [bin_start("time", bucket).alias("period")] if bucket else []
    return pairs.groupBy(*K, *period, "application", "metric_type", "resource_type").agg(
        pearson("x", "y").alias("correlation"), F.count(F.lit(1)).alias("n_pairs"))


def impact_scores(app_grid: DataFrame, res_grid: DataFrame, bucket: str | None = None) -> DataFrame:
    """Mean |r| over the application's metrics; no row if no r is defined (per period with ``bucket``)."""
    corr = metric_correlations(app_grid, res_grid, bucket)
    period = ["period"] if bucket else []
    return (corr.where(F.col("correlation").isNotNull())
            .groupBy(*K, *period, "application", "resource_type")
            .agg(F.avg(F.abs("correlation")).alias("impact_score"),
                 F.count(F.lit(1)).alias("n_metrics"))
            .withColumn("calculation_method", F.lit("correlation")))


# A6 ------------------------------------------------------------------------
def _impact_aggs() -> list[Column]:
    """Sum, mean, max, sample std (0 for one row) per resource; zeros when absent."""
    aggs = []
    for r in RESOURCES:
        v = F.when(F.col("resource_type") == r, F.col("impact_score"))
        aggs += [F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{r}_impact_sum"),
                 F.coalesce(F.avg(v), F.lit(0.0)).alias(f"{r}_impact_mean"),
                 F.coalesce(F.max(v), F.lit(0.0)).alias(f"{r}_impact_max"),
                 F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias(f"{r}_impact_std")]
    return aggs


def impact_stats(impacts: DataFrame, time_col: str = "time") -> DataFrame:
    """Statistics per minute of an impacts table, whose scores may differ from minute to minute."""
    return impacts.groupBy(*K, F.date_trunc("minute", F.col(time_col)).alias("time")).agg(*_impact_aggs())


def entity_impact_stats(scores: DataFrame) -> DataFrame:
    """The statistics of constant scores: one row per entity, the same at each of its minutes."""
    return scores.groupBy(*K).agg(*_impact_aggs())


def impact_stats_over(scores: DataFrame, common: DataFrame) -> DataFrame:
    """``impact_stats`` of the impacts table made of ``scores`` and spans: a row per entity first, repeated over its minutes last."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    minutes = F.explode(F.sequence("common_start", "common_end", step)).alias("time")
    return entity_impact_stats(scores).join(common, K).select(*K, minutes, *STAT_COLUMNS)


STAT_COLUMNS = [f"{r}_impact_{s}" for r in RESOURCES for s in ("sum", "mean", "max", "std")]


# A7 ------------------------------------------------------------------------
def serving_impact_stats(scores: DataFrame) -> DataFrame:
    """Per K over current app scores: population std; an absent resource counts as [0.5]."""
    aggs = []
    for r in RESOURCES:
        v = F.when(F.col("resource_type") == r, F.col("impact_score"))
        present = F.count(v) > 0
        aggs += [F.when(present, F.sum(v)).otherwise(F.lit(0.5)).alias(f"{r}_impact_sum"),
                 F.when(present, F.avg(v)).otherwise(F.lit(0.5)).alias(f"{r}_impact_mean"),
                 F.when(present, F.max(v)).otherwise(F.lit(0.5)).alias(f"{r}_impact_max"),
                 F.when(present, F.stddev_pop(v)).otherwise(F.lit(0.0)).alias(f"{r}_impact_std")]
    return scores.groupBy(*K).agg(*aggs)


# A8 ------------------------------------------------------------------------
def latest_profile(app: DataFrame, now, lookback_minutes: int = 30) -> DataFrame:
    """Mean per (K, application, metric_type) over the lookback, with the calendar of the application's newest time.

    The calendar (hour, day_of_week, is_weekend) is that of the newest row of
    any metric of the application.  Newest times are one row per application, from
    the same aggregation as the means.
    """
    from ..functions.time import day_of_week, hour_of_day, is_weekend, ts_lit
    now_c = ts_lit(now) if isinstance(now, str) else now
    lo = now_c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(lookback_minutes))
    # points in [now - m, now) carry end labels in (now - m, now]
    recent = app.where((F.col("time") > lo) & (F.col("time") <= now_c))
    per = recent.groupBy(*K, "application", "metric_type").agg(F.avg("value").alias("value"), F.max("time").alias("latest_time"))
    newest = F.max("latest_time").over(Window.partitionBy(*K, "application"))  # a row per metric
    return per.withColumn("_newest", newest).select(
        *K, "application", "metric_type", "value", "latest_time", hour_of_day("_newest").alias("hour"),
        day_of_week("_newest").alias("day_of_week"), is_weekend("_newest").alias("is_weekend"))


# A9 ------------------------------------------------------------------------
def last_profile(app: DataFrame) -> DataFrame:
    """Last value per (K, application, metric_type), ties broken by the larger value."""
    return app.groupBy(*K, "application", "metric_type").agg(
        F.max_by("value", F.struct("time", "value")).alias("value"), F.max("time").alias("latest_time"))


# A10 / A11 -----------------------------------------------------------------
def resample_mean(df: DataFrame, every: str, keys: Sequence[str], ts: str = "time", value: str = "value") -> DataFrame:
    """Mean per bin, labelled by bin start."""
    return window_mean(df, every, keys, ts=ts, value=value, label="start")


def resample_last(df: DataFrame, every: str, keys: Sequence[str], ts: str = "time", value: str = "value") -> DataFrame:
    """Last non-null value per bin (bin start label); null-only bins dropped."""
    return (df.where(F.col(value).isNotNull()).groupBy(*keys, bin_start(ts, every).alias("_bin"))
            .agg(F.max_by(value, F.col(ts)).alias(value)).select(*keys, F.col("_bin").alias(ts), value))


# A12 / A13 -----------------------------------------------------------------
def training_gate(app: DataFrame, res: DataFrame, min_app_rows: int = 50, min_apps: int = 2,
                  min_metrics: int = 3, min_res_rows: int = 30) -> DataFrame:
    """Input quality verdict per K (one row per K seen in either table)."""
    a = app.groupBy(*K).agg(F.count(F.lit(1)).alias("app_rows"),
                            F.countDistinct("application").alias("n_apps"),
                            F.countDistinct("metric_type").alias("n_metrics"),
                            F.count("value").alias("app_values"))
    r = res.groupBy(*K).agg(F.count(F.lit(1)).alias("res_rows"),
                            F.sort_array(F.collect_set("resource_type")).alias("resources"),
                            F.count("value").alias("res_values"))
    j = a.join(r, K, "full")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    missing = F.array_except(F.array(*[F.lit(x) for x in RESOURCES]),
                             F.coalesce(F.col("resources"), F.array().cast("array<string>")))
    ok = ((z("app_rows") >= min_app_rows) & (z("n_apps") >= min_apps) & (z("n_metrics") >= min_metrics)
          & (z("res_rows") >= min_res_rows) & (F.size(missing) == 0)
          & (z("app_values") > 0) & (z("res_values") > 0))
    return j.select(*K, z("app_rows").alias("app_rows"), z("n_apps").alias("n_apps"),
                    z("n_metrics").alias("n_metrics"), z("res_rows").alias("res_rows"),
                    F.array_join(missing, ",").alias("missing_resources"), ok.alias("is_valid"))


def input_gate(app: DataFrame, res: DataFrame) -> DataFrame:
    """A13 input stage: >=20 app rows, >=1 app, >=2 metrics, >=10 resource rows (of any resource, values or not)."""
    a = app.groupBy(*K).agg(F.count(F.lit(1)).alias("app_rows"), F.countDistinct("application").alias("n_apps"),
                            F.countDistinct("metric_type").alias("n_metrics"))
    r = res.groupBy(*K).agg(F.count(F.lit(1)).alias("res_rows"))
    j = a.join(r, K, "full").na.fill(0, ["app_rows", "n_apps", "n_metrics", "res_rows"])
    ok = (F.col("app_rows") >= 20) & (F.col("n_apps") >= 1) & (F.col("n_metrics") >= 2) & (F.col("res_rows") >= 10)
    return j.withColumn("input_ok", ok)


def impact_gate(impacts: DataFrame) -> DataFrame:
    """A13 impact stage: >=1 app, >=2 resources, not all null; warn outside 0..2."""
    g = impacts.groupBy(*K).agg(
        F.countDistinct("application").alias("n_apps"),
        F.countDistinct("resource_type").alias("n_resources"),
        F.count("impact_score").alias("n_scores"),
        F.min("impact_score").alias("min_score"), F.max("impact_score").alias("max_score"))
    return g.select(*K, "n_apps", "n_resources",
                    ((F.col("n_apps") >= 1) & (F.col("n_resources") >= 2) & (F.col("n_scores") > 0)).alias("impact_ok"),
                    ((F.col("min_score") < 0) | (F.col("max_score") > 2)).alias("range_warning"))


def feature_gate(features: DataFrame, min_features: int = 5) -> DataFrame:
    """A13 feature stage: >=5 distinct names, not all null."""
    g = features.groupBy(*K).agg(F.countDistinct("feature_name").alias("n_features"),
                                 F.count("value").alias("n_values"))
    return g.select(*K, "n_features", ((F.col("n_features") >= min_features) & (F.col("n_values") > 0)).alias("feature_ok"))


# A14 -----------------------------------------------------------------------
def feature_variability(features: DataFrame, warn_fraction: float = 0.8) -> DataFrame:
    """Per K: features with zero std among all; warning above ``warn_fraction``."""
    per = features.groupBy(*K, "feature_name").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    g = per.groupBy(*K).agg(F.count(F.lit(1)).alias("n_features"),
                            F.count(F.when(F.col("std") == 0, 1)).alias("n_constant"))
    frac = F.col("n_constant") / F.col("n_features")
    return g.select(*K, "n_features", "n_constant", (frac > warn_fraction).alias("low_variability"))


# A20 -----------------------------------------------------------------------
def applications(app: DataFrame) -> DataFrame:
    return app.select(*K, "application").distinct()


# M12 -----------------------------------------------------------------------
def regression_metrics(df: DataFrame, keys: Sequence[str], y: str, yhat: str) -> DataFrame:
    """MAE, RMSE, R^2 per key in one aggregation (R^2 null when y is constant)."""
    err = F.col(yhat) - F.col(y)
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("sse"), F.var_pop(y).alias("var_y"))
    r2 = F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var_y") * F.col("n"))
    return g.select(*keys, "n", "mae", "rmse", r2.alias("r2"))


# M14 -----------------------------------------------------------------------
def linear_baseline(app_grid: DataFrame, res_grid: DataFrame) -> DataFrame:
    """Closed-form least squares resource ~ app metric per (K, app, metric, resource)."""
    a = app_grid.where(F.col("value").isNotNull()).select(*K, "time", "application", "metric_type", F.col("value").alias("x"))
    r = res_grid.where(F.col("value").isNotNull()).select(*K, "time", "resource_type", F.col("value").alias("y"))
    pairs = a.join(r, K + ["time"])
    cov = F.covar_pop("x", "y")
    vx = F.var_pop("x")
    vy = F.var_pop("y")
    g = pairs.groupBy(*K, "application", "metric_type", "resource_type").agg(
        F.count(F.lit(1)).alias("n"), cov.alias("cov"), vx.alias("vx"), vy.alias("vy"),
        F.avg("x").alias("mx"), F.avg("y").alias("my"))
    slope = F.try_divide(F.col("cov"), F.col("vx"))
    r2 = F.when(F.col("vy") == 0, F.lit(None).cast("double")).otherwise(
        F.try_divide(F.col("cov") * F.col("cov"), F.col("vx") * F.col("vy")))
    return g.select(*K, "application", "metric_type", "resource_type", "n",
                    slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"), r2.alias("r2"))
