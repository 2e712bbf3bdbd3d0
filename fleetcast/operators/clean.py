"""Filters and predicates.

List-valued configuration is exploded to rows and applied with an anti or
semi join, never collected to the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import parse_period, ts_lit

K = ["tenant", "device_id"]

# Canonical (resource_type, measurement) pairs.
CANONICAL_RESOURCES = [("cpu", "usage_user"), ("mem", "used_percent"), ("disk", "used_percent")]


def _now(now) -> Column:
    return ts_lit(now) if isinstance(now, (str, _dt.datetime)) else now


# P4 ------------------------------------------------------------------------
def canonical_resources(df: DataFrame) -> DataFrame:
    cond = None
    for r, m in CANONICAL_RESOURCES:
        c = (F.col("resource_type") == r) & (F.col("measurement") == m)
        cond = c if cond is None else (cond | c)
    return df.where(cond)


# P5 / P6 -------------------------------------------------------------------
def csv_items(text: Column, trim: bool = True) -> Column:
    """CSV text -> array of items; empty items dropped (trimmed first if asked)."""
    parts = F.split(F.coalesce(text, F.lit("")), ",")
    if trim:
        parts = F.transform(parts, lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def exclusion_list(cfg: DataFrame, config_key: str, trim: bool = True,
                   config_type: str = "excluded") -> DataFrame:
    """Effective exclusion items per tenant: (tenant, item).

    Newest active row per tenant wins; a tenant without a row gets the
    caller's default list (``exclude_values(default=...)``).
    """
    from .config import effective_config
    eff = effective_config(cfg).where((F.col("config_type") == config_type) & (F.col("config_key") == config_key))
    return eff.select("tenant", F.explode(csv_items(F.col("config_value"), trim)).alias("item")).distinct()


def exclude_values(df: DataFrame, column: str, items: DataFrame, default: Sequence[str] = ()) -> DataFrame:
    """Anti join on (tenant, column); tenants with no configured list use ``default``."""
    out = df.join(items.withColumnRenamed("item", column), ["tenant", column], "left_anti")
    if default:
        has_cfg = items.select("tenant").distinct()
        no_cfg = out.join(has_cfg, "tenant", "left_anti").where(F.col(column).isin(list(default)))
        out = out.join(no_cfg.select("tenant", column).distinct(), ["tenant", column], "left_anti")
    return out


def exclude_devices(df: DataFrame, cfg: DataFrame, default: Sequence[str] = ()) -> DataFrame:
    """P5: drop devices listed (trimmed CSV) in the tenant's exclusion config."""
    return exclude_values(df, "device_id", exclusion_list(cfg, "devices", True), default)


def exclude_gateways(df: DataFrame, cfg: DataFrame, column: str = "application", default: Sequence[str] = ()) -> DataFrame:
    """Drop applications (gateways) listed in the tenant's exclusion config (no trim)."""
    return exclude_values(df, column, exclusion_list(cfg, "gateways", False), default)


# P7 ------------------------------------------------------------------------
def validate_ranges(df: DataFrame, rules: DataFrame, metric: str = "metric_type", value: str = "value") -> DataFrame:
    """Keep rows in ``[min, max]`` of their metric's rule; unknown metrics pass.

    ``rules`` (metric, min, max) is a configuration table; the engine
    broadcasts it when its size allows.
    """
    r = rules.select(F.col("metric").alias("_rm"), F.col("min").alias("_lo"), F.col("max").alias("_hi"))
    j = df.join(r, F.col(metric) == F.col("_rm"), "left")
    ok = F.coalesce(F.col(value).between(F.col("_lo"), F.col("_hi")), F.col("_rm").isNull())
    return j.where(ok).drop("_rm", "_lo", "_hi")


# P8 ------------------------------------------------------------------------
def complete_rows(df: DataFrame, group: Sequence[str], series_col: str, ts: str = "time",
                  value: str = "value") -> DataFrame:
    """Keep times at which every series of the group has a value.

    How many series a group has is a small aggregate (a row per group, from
    partials per group and series).  The series present are counted at each
    time; time, or its share, is in every shuffle key of the rows, so a group
    with a large share of all rows is many tasks.
    """
    v = df.where(F.col(value).isNotNull())
    present = F.size(F.collect_set(series_col).over(Window.partitionBy(*group, ts)))
    return where_complete(v.withColumn("_have", present), group, series_counts(v, group, series_col), ts)


#: Shares into which a group's times are dealt before they meet a row of the group.
SHARES = 64


def share_of(ts: str) -> Column:
    return F.pmod(F.xxhash64(ts), F.lit(SHARES)).cast("int")


def in_all_shares(df: DataFrame) -> DataFrame:
    """A small table, its rows repeated for every share (``_share``)."""
    return df.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))


def series_counts(df: DataFrame, group: Sequence[str], series_col: str) -> DataFrame:
    """(group as _g0.., _need): how many series each group has."""
    names = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    return df.select(*names, series_col).distinct().groupBy(*[f"_g{i}" for i in range(len(group))]).agg(F.count(series_col).alias("_need"))


def where_complete(df: DataFrame, group: Sequence[str], counts: DataFrame, ts: str = "time") -> DataFrame:
    """The rows of ``df`` whose ``_have`` is all of their group's series."""
    c = in_all_shares(counts).withColumnRenamed("_share", "_gs")
    on = (F.col("_have") == F.col("_need")) & (share_of(ts) == F.col("_gs"))
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return df.join(c, on, "left_semi").drop("_have")


# P9 ------------------------------------------------------------------------
def lookback(df: DataFrame, ts: str, now, period: str) -> DataFrame:
    """Rows with ``ts >= now - period`` (period text '3d' / '2w')."""
    delta = parse_period(period)
    return df.where(F.col(ts) >= _now(now) - F.make_dt_interval(F.lit(delta.days)))


# P10 -----------------------------------------------------------------------
def adaptive_lookback(app: DataFrame, res: DataFrame, now, steps: Sequence[int] = (30, 60, 120, 360),
                      min_rows: int = 10, ts: str = "time") -> tuple[DataFrame, DataFrame]:
    """Per entity choose the smallest window (minutes) with >= ``min_rows`` app rows.

    One scan of the widest window; ``count(when)`` per step; the choice is
    joined back.  If no step qualifies, app rows come from the widest window
    and resource rows from the first; so do the resource rows of an entity
    without any app row.
    """
    now_c = _now(now)
    widest = max(steps)
    first = steps[0]

    def within(m):
        # points in [now - m, now) carry end labels in (now - m, now]
        return F.col(ts) > now_c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m))

    a = app.where(within(widest) & (F.col(ts) <= now_c))
    counts = a.groupBy(*K).agg(*[F.count(F.when(within(m), 1)).alias(f"n{m}") for m in steps])
    choice = None
    for m in steps:
        choice = F.when(F.col(f"n{m}") >= min_rows, F.lit(m)) if choice is None else choice.when(F.col(f"n{m}") >= min_rows, F.lit(m))
    chosen = counts.select(*K, choice.alias("app_minutes"),
                           F.coalesce(choice, F.lit(first)).alias("res_minutes"))
    chosen = chosen.select(*K, F.coalesce("app_minutes", F.lit(widest)).alias("app_minutes"), "res_minutes")
    lo = lambda c: now_c - F.make_dt_interval(F.lit(0), F.lit(0), F.col(c).cast("int"))
    app_out = a.join(chosen, K).where(F.col(ts) > lo("app_minutes")).drop("app_minutes", "res_minutes")
    r = res.where(within(widest) & (F.col(ts) <= now_c))
    r = r.join(chosen, K, "left").withColumn("res_minutes", F.coalesce("res_minutes", F.lit(first)))
    res_out = r.where(F.col(ts) > lo("res_minutes")).drop("app_minutes", "res_minutes")
    return app_out, res_out
