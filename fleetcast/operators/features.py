"""Feature tables (W2, U4) and training sets (M1, M2).

Features are kept tall - (K, time, application, feature_name, value,
window_size) - until model input, so the plan does not grow with the
number of applications x metrics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import day_of_week, floor_minutes, hour_of_day, is_weekend
from . import segments
from .aggregate import STAT_COLUMNS, bin_start, entity_impact_stats
from .clean import canonical_resources, in_all_shares, series_counts, share_of, where_complete
from .series import DEFAULT_STATS, DEFAULT_WINDOWS, MINUTE_US, rolling_columns

K = ["tenant", "device_id"]
FEATURE_COLUMNS = [*K, "time", "application", "feature_name", "value", "window_size"]
CALENDAR = ["hour", "day_of_week", "is_weekend"]


# W2 ------------------------------------------------------------------------
def rolling_features(app: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS,
                     stats: Sequence[str] = DEFAULT_STATS, every: str = "5 minutes", chunk_us: int = segments.DAY_US) -> DataFrame:
    """Complete-case rows -> rolling stats -> last per 5-min bin -> ``{metric}_{stat}_{w}min``.

    One shuffle of minute rows, by (application, chunk of time): an
    application's minutes, its series' frames and the bins all lie inside a chunk
    (with the rows its frames reach back to), so P8, W1 and A11 follow without
    another.  Chunks are whole multiples of a bin.
    """
    group = [*K, "application"]
    v = app.where(F.col("value").isNotNull())
    chunks = segments.with_halo(v.select(*group, "metric_type", "time", "value"), "time", max(windows) * MINUTE_US, chunk_us)
    chunks = chunks.repartition(*group, "_chunk")
    present = F.size(F.collect_set("metric_type").over(Window.partitionBy(*group, "_chunk", "time")))
    full = where_complete(chunks.withColumn("_have", present), group, series_counts(v, group, "metric_type"))
    wide = full.select("*", *rolling_columns([*group, "_chunk", "metric_type"], windows, stats, "time", "value")).where("_own")
    names = [f"{s}_{w}" for w in windows for s in stats]
    # A11 on the wide rows (last non-null per column and bin), unpivot after
    bins = wide.groupBy(*group, "_chunk", "metric_type", bin_start("time", every).alias("time")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("time"))).alias(c) for c in names])
    tall = bins.unpivot([*group, "metric_type", "time"], names, "stat_w", "value").where(F.col("value").isNotNull())
    stat = F.split("stat_w", "_").getItem(0)
    w = F.split("stat_w", "_").getItem(1)
    return tall.select(*K, "time", "application",
                       F.concat_ws("_", "metric_type", stat, F.concat(w, F.lit("min"))).alias("feature_name"),
                       "value", w.cast("int").alias("window_size"))


# U4 ------------------------------------------------------------------------
def with_time_features(features: DataFrame, app: DataFrame) -> DataFrame:
    """Calendar features for every application x every feature time of the entity.

    Applications come from the metric table, so an application without any
    rolling feature still receives calendar rows.  Both sides are distinct
    lists per entity; the product is the output itself.  The join key holds a
    share of the times (their hash), for which the short list of applications
    is repeated, so an entity is not one task.
    """
    times = features.select(*K, "time").distinct().withColumn("_share", share_of("time"))
    apps = in_all_shares(app.select(*K, "application").distinct())
    grid = times.join(apps, [*K, "_share"])
    cal = grid.select(*K, "time", "application",
                      F.inline(F.array(
                          F.struct(F.lit("hour").alias("feature_name"), hour_of_day("time").cast("double").alias("value")),
                          F.struct(F.lit("day_of_week").alias("feature_name"), day_of_week("time").cast("double").alias("value")),
                          F.struct(F.lit("is_weekend").alias("feature_name"), is_weekend("time").cast("double").alias("value")))),
                      F.lit(0).alias("window_size"))
    return features.select(*FEATURE_COLUMNS).unionByName(cal)


def feature_table(app: DataFrame, **kw) -> DataFrame:
    """W2 + U4: the public feature table (keys are unique by construction)."""
    return with_time_features(rolling_features(app, **kw), app)


# M1 ------------------------------------------------------------------------
def app_training_set(features: DataFrame, scores: DataFrame, common: DataFrame, min_common: int = 10,
                     period: str | None = None) -> DataFrame:
    """Tall training rows: features x impact label on common times, >= ``min_common`` times per app.

    Output (K, application, time, feature_name, value, resource_type, label).
    Nulls of the wide form become 0 at model input (``pivot`` + ``na.fill``).

    The impacts table holds a score at every common minute of its entity, so a
    feature time has a label if it lies in the entity's span and the application
    has a score: the scores are joined as they are, one row per key, and last.
    With ``period`` (e.g. '1 hour') ``scores`` has one row per period and a
    feature time takes the label of its own, so labels vary in time.
    """
    at = [bin_start("time", period).alias("period")] if period else []
    key = [*K, "application", *(["period"] if period else [])]
    span = common.select(*K, "common_start", "common_end")
    f = (features.select(*K, "application", "time", "feature_name", "value", *at).join(span, K)
         .where(F.col("time").between(F.col("common_start"), F.col("common_end"))).drop("common_start", "common_end"))
    y = scores.select(*key, "resource_type", F.col("impact_score").alias("label"))
    times = f.select(*K, "application", "time", *(["period"] if period else [])).distinct().join(y.select(*key).distinct(), key, "left_semi")
    enough = times.groupBy(*K, "application").agg(F.count(F.lit(1)).alias("n_times")).where(F.col("n_times") >= min_common)
    kept = f.join(enough.select(*K, "application"), [*K, "application"], "left_semi")
    return kept.join(y, key).select(*K, "application", "time", "feature_name", "value", "resource_type", "label")


# M2 ------------------------------------------------------------------------
RESOURCE_NAMES = ["cpu", "mem", "disk"]


def system_training_set(scores: DataFrame, common: DataFrame, res: DataFrame, every_minutes: int = 5,
                        min_common: int = 10) -> DataFrame:
    """Wide model rows: impact statistics + calendar (X) beside cpu / mem / disk (y).

    The impacts table repeats an entity's scores over its common span, so X is
    one row of statistics (A6) per entity and a span.  y is the canonical
    resources per minute.  Both are cut to the overlap of their spans (W6) and
    averaged per 5-minute bin (A10); X covers every bin of the overlap, so the
    common bins (J1) run from y's first to its last.  y is forward filled over
    the bins it misses (W5), 0 for what stays empty; entities with fewer than
    ``min_common`` bins go.

    Spans, bounds and statistics are small aggregates, a row per entity; the
    bins are exploded once; rows of y meet them on (entity, bin).  ``common`` may
    bring the resource minutes' own bounds (``res_start``, ``res_end``).
    """
    minute = canonical_resources(res).groupBy(*K, F.date_trunc("minute", "time").alias("time"), "resource_type").agg(F.avg("value").alias("value"))
    spans = common
    if not {"res_start", "res_end"} <= set(common.columns):
        spans = common.join(minute.groupBy(*K).agg(F.min("time").alias("res_start"), F.max("time").alias("res_end")), K)
    spans = spans.select(*K, F.greatest("common_start", "res_start").alias("s0"), F.least("common_end", "res_end").alias("s1")).where("s0 < s1")
    y = minute.join(spans, K).where(F.col("time").between(F.col("s0"), F.col("s1")))
    bins = y.groupBy(*K, floor_minutes("time", every_minutes).alias("time")).agg(
        *[F.avg(F.when(F.col("resource_type") == r, F.col("value"))).alias(r) for r in RESOURCE_NAMES])
    bounds = bins.groupBy(*K).agg(F.min("time").alias("c0"), F.max("time").alias("c1"))
    step = every_minutes * 60_000_000
    enough = (F.unix_micros("c1") - F.unix_micros("c0")) / F.lit(step) + 1 >= min_common
    grid = spans.join(bounds.where(enough), K).join(entity_impact_stats(scores), K).select(
        *K, "s0", "s1", *STAT_COLUMNS, F.explode(F.sequence("c0", "c1", F.make_dt_interval(F.lit(0), F.lit(0), F.lit(every_minutes)))).alias("time"))
    filled = segments.carried(grid.join(bins, [*K, "time"], "left"), K, "time", RESOURCE_NAMES)
    # the calendar of a bin is the mean over its minutes inside the overlap
    last = F.least(F.timestamp_micros(F.unix_micros("time") + F.lit(step - MINUTE_US)), F.col("s1"))
    minutes = F.sequence(F.greatest("time", "s0"), last, F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1)))
    mean = lambda of: F.aggregate(minutes, F.lit(0.0), lambda a, t: a + of(t).cast("double")) / F.size(minutes)
    return filled.select(*K, "time", *STAT_COLUMNS, *[mean(of).alias(c) for c, of in zip(CALENDAR, (hour_of_day, day_of_week, is_weekend))],
                         *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in RESOURCE_NAMES])
