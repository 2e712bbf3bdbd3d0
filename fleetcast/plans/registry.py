"""Registered queries: one Spark plan and one DuckDB twin per operator.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the driver tables;
``ORACLE[name]`` is the equivalent SQL over the same raw views.  Output
doubles are rounded to 6 places and times returned as ``timestamp_ntz`` so
that both sides hash alike whatever the session zone of the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_utc
from ..sources.fixtures import fx_points, memo_plan
from . import impact as IP
from .oracle import rounded, sql_with

@memo_plan
def server_points(spark: SparkSession, sf: str) -> DataFrame:
    """S1 over the fixture points: origin = server_data, whole range."""
    from ..sources.points import scan_points
    return scan_points(fx_points(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def round6(c):
    """Round to 6 places with the half point nudged up by 1e-7 of a unit.

    Means of 2-decimal data often sit exactly on a half; the engines then
    differ by an ulp on either side of it.  The nudge moves the boundary off
    those exact decimal halves, so both engines round the same way.  The
    DuckDB twin applies the same steps (``oracle.rounded``).
    """
    return F.signum(c) * F.floor(F.abs(c) * F.lit(1e6) + F.lit(0.5000001)) / F.lit(1e6) + F.lit(0.0)


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType | T.FloatType):
            c = round6(c.cast("double"))
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, doubles: list[str] | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return finalize(fn(spark, sf_dir))
        run.__name__ = name
        run.__qualname__ = f"query.{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = rounded(sql, doubles or [])
        return run
    return deco


# ---------------------------------------------------------------- sources
@register("s2_app_metrics", sql_with(["app_metrics"], "SELECT * FROM app_metrics"), ["value"])
def q_app_metrics(spark, sf):
    """S2 + A1 + A2: per-minute application metrics."""
    from ..sources.points import app_metrics
    return app_metrics(server_points(spark, sf))


@register("s3_resource_metrics", sql_with(["resource_metrics"], "SELECT * FROM resource_metrics"), ["value"])
def q_resource_metrics(spark, sf):
    """S3 + U1: cpu/mem/disk per minute from one scan."""
    from ..sources.points import resource_metrics
    return resource_metrics(server_points(spark, sf))


# ---------------------------------------------------------------- flagship slice
@register("w4_interpolate_app", sql_with(["app_filled"], "SELECT * FROM app_filled WHERE value IS NOT NULL"), ["value"])
def q_interp(spark, sf):
    """W3 + W4: gap-filled minute grid of application metrics (non-null cells)."""
    from ..sources.points import app_metrics
    from ..operators.series import interpolate_linear
    return interpolate_linear(app_metrics(server_points(spark, sf)), IP.APP_SERIES)


@register("a5_metric_correlations", sql_with(["corrs"], "SELECT * FROM corrs"), ["correlation"])
def q_corr(spark, sf):
    """A5 inner step: guarded Pearson r per app metric and resource."""
    return IP.correlation_table(fx_points(spark, sf))


@register("a5_impact_scores", sql_with(["scores"], "SELECT * FROM scores"), ["impact_score"])
def q_scores(spark, sf):
    """A5: impact score per (entity, application, resource)."""
    return IP.impact_score_table(fx_points(spark, sf))


@register("j2_impacts", sql_with(["impacts"], "SELECT * FROM impacts"), ["impact_score"])
def q_impacts(spark, sf):
    """J1 + J2: impact scores repeated over the entity's common minutes."""
    return IP.impact_table(fx_points(spark, sf))


@register("j1_common_times", sql_with(["common"], "SELECT * FROM common"))
def q_common(spark, sf):
    """Shared minute span per entity, gated at 5."""
    return IP.impact_frames(fx_points(spark, sf)).common


# ---------------------------------------------------------------- features
@memo_plan
def _app(spark, sf):
    from ..sources.points import app_metrics
    return app_metrics(server_points(spark, sf))


@memo_plan
def _res(spark, sf):
    from ..sources.points import resource_metrics
    return resource_metrics(server_points(spark, sf))


@register("p8_complete_rows", sql_with(["app_complete"], "SELECT * FROM app_complete"), ["value"])
def q_complete(spark, sf):
    """App-minutes where every metric of the application is present."""
    from ..operators.clean import complete_rows
    return complete_rows(_app(spark, sf), ["tenant", "device_id", "application"], "metric_type")


@register("w1_rolling_stats", sql_with(["rolling"], "SELECT * FROM rolling"),
          ["value"] + [f"{s}_{w}" for w in (5, 15, 30, 60) for s in ("mean", "std", "max", "min")])
def q_rolling(spark, sf):
    """Time-based rolling mean/std/max/min over (t-w, t] for w = 5, 15, 30, 60 min."""
    from ..operators.clean import complete_rows
    from ..operators.series import rolling_stats
    full = complete_rows(_app(spark, sf), ["tenant", "device_id", "application"], "metric_type")
    return rolling_stats(full, ["application", "metric_type"])


@register("w2_rolling_features", sql_with(["features_roll"], "SELECT * FROM features_roll"), ["value"])
def q_roll_features(spark, sf):
    """W2 + A11: rolling statistics, last per 5-min bin, tall with feature names."""
    from ..operators.features import rolling_features
    return rolling_features(_app(spark, sf))


@register("u4_feature_table", sql_with(["features"], "SELECT * FROM features"), ["value"])
def q_features(spark, sf):
    """U4: rolling features plus calendar features for every application and feature time."""
    from ..operators.features import feature_table
    return feature_table(_app(spark, sf))


@register("a6_impact_stats", sql_with(["impact_stats"], "SELECT * FROM impact_stats"),
          [f"{r}_impact_{s}" for r in ("cpu", "mem", "disk") for s in ("sum", "mean", "max", "std")])
def q_impact_stats(spark, sf):
    """Per-minute sum/mean/max/std of impact per resource (zeros when absent)."""
    from ..operators.aggregate import impact_stats_over
    return impact_stats_over(*IP.scores_and_spans(fx_points(spark, sf)))


@register("m2_system_training_set", sql_with(["sys_train"], "SELECT * FROM sys_train"),
          [f"{r}_impact_{s}" for r in ("cpu", "mem", "disk") for s in ("sum", "mean", "max", "std")]
          + ["hour", "day_of_week", "is_weekend", "cpu", "mem", "disk"])
def q_sys_train(spark, sf):
    """M2: 5-min impact statistics + calendar beside utilisation, forward filled."""
    from ..operators.features import system_training_set
    return system_training_set(*IP.scores_and_spans(fx_points(spark, sf)), _res(spark, sf))


from . import catalog  # noqa: E402,F401  (registers the remaining queries)
from . import streams  # noqa: E402,F401  (streaming queries)
from . import model_queries  # noqa: E402,F401  (model queries)
from . import wide  # noqa: E402,F401  (the same queries over more devices)
