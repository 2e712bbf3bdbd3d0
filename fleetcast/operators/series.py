"""Window and time-series operators.

Windows run *after* the minute aggregation (A1), so they see at most one row
per series and minute however dense the raw points are, and inside chunks of time
(``segments``), so a series is not one task however long it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import segments
from .cooldown import alert_cooldown  # noqa: F401  (W13)

K = ["tenant", "device_id"]
MINUTE_US = 60_000_000

# Rolling windows (minutes) and statistics used by the features.
DEFAULT_WINDOWS = [5, 15, 30, 60]
DEFAULT_STATS = ["mean", "std", "max", "min"]


# W3 ------------------------------------------------------------------------
def grid_bounds(df: DataFrame, ts: str = "time", keys: Sequence[str] = K) -> DataFrame:
    """Global first/last time per entity (the grid spans the entity's whole set)."""
    return df.groupBy(*keys).agg(F.min(ts).alias("grid_start"), F.max(ts).alias("grid_end"))


def minute_grid(df: DataFrame, series: Sequence[str], ts: str = "time", value: str = "value",
                step_minutes: int = 1, keys: Sequence[str] = K) -> DataFrame:
    """One row per step from the entity's min to max time for *every* series of the entity.

    The product is built from two small tables (bounds per entity, distinct
    series per entity) and exploded per series row, so no large shuffle
    carries the grid; the values are attached by an equi join that includes
    the time, which spreads a hot entity over all its minutes.
    """
    bounds = grid_bounds(df, ts, keys)
    names = df.select(*keys, *series).distinct()
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(step_minutes))
    grid = names.join(bounds, list(keys)).select(
        *keys, *series, F.explode(F.sequence("grid_start", "grid_end", step)).alias(ts))
    return grid.join(df.select(*keys, *series, ts, value), list(keys) + list(series) + [ts], "left")


# W4 ------------------------------------------------------------------------
def interpolate_linear(df: DataFrame, series: Sequence[str], ts: str = "time", value: str = "value",
                       limit: int = 5, step_minutes: int = 1, bounds: DataFrame | None = None,
                       keys: Sequence[str] = K) -> DataFrame:
    """Forward linear interpolation on a regular grid, at most ``limit`` steps per gap.

    Matches the frame-interpolation default: a leading gap stays empty, an
    interior gap fills its first ``limit`` steps on the straight line between
    its neighbours, a trailing gap repeats the last value up to ``limit``
    steps but not past the entity's grid end.  Only non-null rows are
    returned (originals plus fills); ``minute_grid`` restores the nulls.

    Built on gaps instead of a full grid: ``lead`` over the valid points of a
    series, then one ``explode(sequence(0, n))`` per point: the point and its fills.
    """
    sk = list(keys) + list(series)
    pts = df.where(F.col(value).isNotNull()).select(*sk, ts, value)
    if bounds is None:
        bounds = grid_bounds(pts, ts, keys)
    w = Window.partitionBy(*sk).orderBy(ts)
    g = pts.select(*sk, ts, value, F.lead(ts).over(w).alias("_nt"), F.lead(value).over(w).alias("_nv"))
    # one row per entity on the right: AQE broadcasts it when its measured size is small
    g = g.join(bounds.select(*keys, "grid_end"), list(keys))
    step_us = F.lit(step_minutes * MINUTE_US)
    gap = ((F.unix_micros("_nt") - F.unix_micros(ts)) / step_us).cast("long")
    to_end = ((F.unix_micros("grid_end") - F.unix_micros(ts)) / step_us).cast("long")
    lim = F.lit(limit).cast("long")
    # k = 0 is the point itself; interior gaps fill min(limit, gap - 1) steps on the
    # line to the next point, a trailing gap repeats the value up to the grid end
    n_fill = F.when(F.col("_nt").isNotNull(), F.least(lim, gap - 1)).otherwise(F.greatest(F.least(lim, to_end), F.lit(0).cast("long")))
    ex = g.select(*sk, ts, value, "_nt", "_nv", gap.alias("_gap"),
                  F.explode(F.sequence(F.lit(0).cast("long"), n_fill)).alias("_k"))
    v = (F.when(F.col("_k") == 0, F.col(value))
         .when(F.col("_nt").isNotNull(), F.col(value) + (F.col("_nv") - F.col(value)) * F.col("_k") / F.col("_gap"))
         .otherwise(F.col(value)))
    t = F.col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("_k") * step_minutes).cast("int"))
    return ex.select(*sk, t.alias(ts), v.alias(value))


# W1 ------------------------------------------------------------------------
def rolling_stats(df: DataFrame, series: Sequence[str], windows: Sequence[int] = DEFAULT_WINDOWS,
                  stats: Sequence[str] = DEFAULT_STATS, ts: str = "time", value: str = "value",
                  keys: Sequence[str] = K, chunk_us: int = segments.DAY_US) -> DataFrame:
    """Time-based rolling statistics over ``(t - w, t]``, at least one row.

    Output is wide: one column ``{stat}_{w}`` per pair; ``std`` is the sample
    std (null on one row).  A series is cut into chunks with the rows its
    frames reach back to, one shuffle by (series, chunk); all frames share one
    partition/order spec, so Spark sorts once and evaluates them together.
    """
    chunks = segments.with_halo(df.select(*keys, *series, ts, value), ts, max(windows) * MINUTE_US, chunk_us)
    out = chunks.select("*", *rolling_columns([*keys, *series, "_chunk"], windows, stats, ts, value))
    return out.where("_own").drop("_own", "_chunk")


def rolling_columns(partition: Sequence[str], windows: Sequence[int], stats: Sequence[str], ts: str, value: str) -> list[Column]:
    base = Window.partitionBy(*partition).orderBy(F.unix_micros(F.col(ts)))
    cols = []
    for w in windows:
        frame = base.rangeBetween(-(w * MINUTE_US - 1), 0)
        for s in stats:
            fn = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}[s]
            cols.append(fn(F.col(value)).over(frame).alias(f"{s}_{w}"))
    return cols


# W5 ------------------------------------------------------------------------
def ffill(df: DataFrame, series: Sequence[str], ts: str = "time", value: str = "value",
          step_minutes: int = 5, keys: Sequence[str] = K, fill: float | None = 0.0) -> DataFrame:
    """Grid, forward fill, then a constant for what stays empty."""
    grid = minute_grid(df, series, ts, value, step_minutes, keys)
    filled = segments.carried(grid.select(*keys, *series, ts, value), [*keys, *series], ts, [value])
    return filled if fill is None else filled.withColumn(value, F.coalesce(F.col(value), F.lit(fill)))


# W6 ------------------------------------------------------------------------
def overlap_slice(a: DataFrame, b: DataFrame, ts: str = "time", keys: Sequence[str] = K) -> DataFrame:
    """``[max(min_a, min_b), min(max_a, max_b)]`` per entity, only where start < end."""
    ba = a.groupBy(*keys).agg(F.min(ts).alias("a_min"), F.max(ts).alias("a_max"))
    bb = b.groupBy(*keys).agg(F.min(ts).alias("b_min"), F.max(ts).alias("b_max"))
    j = ba.join(bb, list(keys))
    out = j.select(*keys, F.greatest("a_min", "b_min").alias("slice_start"), F.least("a_max", "b_max").alias("slice_end"))
    return out.where(F.col("slice_start") < F.col("slice_end"))


# W10 -----------------------------------------------------------------------
def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key by ``order`` (a total order: no ties survive)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# W11 -----------------------------------------------------------------------
def chrono_split(df: DataFrame, keys: Sequence[str], ts: str, train_fraction: float = 0.8) -> DataFrame:
    """Flag the first ``floor(n * fraction)`` rows in time order of each key as train."""
    rows = segments.numbered(df, keys, ts)
    return rows.withColumn("is_train", F.col("_i") < F.floor(F.col("_n") * F.lit(train_fraction))).drop("_i", "_n")


# W12 -----------------------------------------------------------------------
def ts_folds(df: DataFrame, keys: Sequence[str], ts: str, n_splits: int = 5) -> DataFrame:
    """Expanding folds: test size ``n // (n_splits + 1)``, train = all rows before the test block.

    One output row per (input row, fold) where the row takes part in the fold.
    """
    t = (F.col("_n") / F.lit(n_splits + 1)).cast("long")
    ex = segments.numbered(df, keys, ts).select("*", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"), t.alias("_t"))
    test_start = F.col("_n") - (F.lit(n_splits) - F.col("fold")) * F.col("_t")
    role = (F.when(F.col("_i") < test_start, F.lit("train"))
            .when(F.col("_i") < test_start + F.col("_t"), F.lit("test")))
    return ex.withColumn("role", role).where(F.col("role").isNotNull() & (F.col("_t") > 0)) \
        .drop("_i", "_n", "_t")
