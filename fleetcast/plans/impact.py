"""Impact-score plan: points -> minute metrics -> gap-filled grids -> |r| per app and resource.

One DataFrame plan for all tenants and devices; the entity key leads every
grouping, join and window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import bin_start, impact_scores, linear_baseline, metric_correlations
from ..operators.clean import canonical_resources
from ..operators.joins import expand_scores
from ..operators.series import MINUTE_US, interpolate_linear
from ..sources.points import app_metrics, is_app_metric, is_resource_metric, resource_metrics, scan_points

K = ["tenant", "device_id"]
APP_SERIES = ["application", "metric_type"]
RES_SERIES = ["resource_type", "measurement"]


@dataclass
class ImpactFrames:
    app: DataFrame          # minute app metrics
    res: DataFrame          # minute canonical resources
    app_filled: DataFrame   # interpolated, non-null, of entities with a common span
    res_filled: DataFrame
    spans: DataFrame        # per entity common span, gated, and the bounds of both tables

    @property
    def common(self) -> DataFrame:
        return self.spans.select(*K, "common_start", "common_end", "n_common")


def entity_spans(pts: DataFrame, min_common: int = 5) -> DataFrame:
    """(K, common_start, common_end, n_common, app_end, res_start, res_end): bounds of both minute tables and J1's gate from one conditional aggregate.

    The first and last minute of a minute table are those of its points, so
    the points are read once, with a row per entity from every task.
    """
    end = bin_start("ts", "1 minute", end=True)
    a, r = F.when(is_app_metric(), end), F.when(is_resource_metric(), end)
    b = pts.groupBy(*K).agg(F.min(a).alias("a0"), F.max(a).alias("app_end"), F.min(r).alias("r0"), F.max(r).alias("res_end"))
    start, stop = F.greatest("a0", "r0"), F.least("app_end", "res_end")
    n = ((F.unix_micros(stop) - F.unix_micros(start)) / F.lit(MINUTE_US)).cast("long") + 1
    both = F.col("app_end").isNotNull() & F.col("res_end").isNotNull()
    return b.select(*K, start.alias("common_start"), stop.alias("common_end"), n.alias("n_common"), "app_end", F.col("r0").alias("res_start"), "res_end").where(
        both & (F.col("common_start") <= F.col("common_end")) & (F.col("n_common") >= min_common))


def impact_frames(points: DataFrame, limit: int = 5, min_common: int = 5,
                  tenant: str | None = None, start=None, stop=None) -> ImpactFrames:
    """Both filled minute tables and the common spans, from three reads of the points.

    Filled values exist only inside each side's own grid, so every pair lies in
    the common span; only the entity gate is left, and the join with the spans
    (for the end of the grid) applies it.  Both sides ask for the same columns
    of the spans, so the engine computes them once (exchange reuse).
    """
    pts = scan_points(points, tenant=tenant, start=start, stop=stop)
    app = app_metrics(pts)
    res = canonical_resources(resource_metrics(pts))
    spans = entity_spans(pts, min_common)
    ends = spans.select(*K, "app_end", "res_end")

    def ending(mine: str, other: str) -> DataFrame:
        # equals ``mine``; naming the other end too keeps both sides' spans alike
        return ends.withColumn("grid_end", F.greatest(mine, F.least(mine, other)))

    return ImpactFrames(app, res, interpolate_linear(app, APP_SERIES, limit=limit, bounds=ending("app_end", "res_end")),
                        interpolate_linear(res, RES_SERIES, limit=limit, bounds=ending("res_end", "app_end")),
                        spans)


def impact_score_table(points: DataFrame, **kw) -> DataFrame:
    """(K, application, resource_type, impact_score, n_metrics, calculation_method)."""
    f = impact_frames(points, **kw)
    return impact_scores(f.app_filled, f.res_filled)


def periodic_impact_scores(points: DataFrame, bucket: str = "1 hour", **kw) -> DataFrame:
    """Impact scores per period (the constant score re-computed per ``bucket``)."""
    f = impact_frames(points, **kw)
    return impact_scores(f.app_filled, f.res_filled, bucket)


def scores_and_spans(points: DataFrame, bucket: str | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """What the impacts table is made of: scores (per period with ``bucket``) and each entity's spans (``entity_spans``)."""
    f = impact_frames(points, **kw)
    return impact_scores(f.app_filled, f.res_filled, bucket), f.spans


def impact_table(points: DataFrame, **kw) -> DataFrame:
    """The public impacts table: each score repeated at every common minute."""
    f = impact_frames(points, **kw)
    scores = impact_scores(f.app_filled, f.res_filled)
    return expand_scores(scores, f.common).select(*K, "time", "application", "resource_type",
                                                  "impact_score", "calculation_method")


def correlation_table(points: DataFrame, **kw) -> DataFrame:
    f = impact_frames(points, **kw)
    return metric_correlations(f.app_filled, f.res_filled)


def baseline_table(points: DataFrame, **kw) -> DataFrame:
    f = impact_frames(points, **kw)
    return linear_baseline(f.app_filled, f.res_filled)
