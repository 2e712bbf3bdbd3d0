"""Structured Streaming forms of the operators.

Inputs are streaming DataFrames of the ``points`` schema (ts must be a
``timestamp``).  Every stateful operator carries a watermark so its state
is bounded; late rows beyond the delay are dropped by Spark.  Checkpoints
live under the session's shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import canonical_resources
from ..session import ensure_checkpoint_dir
from ..sources.points import APP_LOCATION, ORIGIN, RESOURCE_LOCATION, RESOURCE_SOURCES
from ..sources.tables import read_predictions

K = ["tenant", "device_id"]
SERIES = [*K, "location", "gateway", "measurement"]


def _server(stream: DataFrame) -> DataFrame:
    return stream.where((F.col("origin") == ORIGIN) & (F.col("field") == "value"))


# R1 ------------------------------------------------------------------------
def stream_window_mean(stream: DataFrame, every: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Tumbling mean per series, emitted once the watermark passes the window end.

    Output: tenant, device_id, location, gateway, measurement, time (window
    end), value, n.
    """
    s = _server(stream).withWatermark("ts", delay)
    g = s.groupBy(F.window("ts", every).alias("w"), *SERIES).agg(F.avg("value").alias("value"),
                                                                  F.count(F.lit(1)).alias("n"))
    return g.select(*SERIES, F.col("w.end").alias("time"), "value", "n")


# R2 ------------------------------------------------------------------------
def stream_rolling(stream: DataFrame, windows: Sequence[int] = (5, 15, 30, 60), slide: int = 5,
                   delay: str = "10 minutes") -> DataFrame:
    """Sliding-window statistics per application metric, all window sizes (minutes) in one stream.

    Two chained aggregations.  The first keeps count, sum, sum of squares,
    minimum and maximum of every ``slide`` minutes, so a raw row updates one
    state row.  The second slides the widest window over these partials, and
    takes each size's statistics from the partials that lie in its last minutes.
    Sizes are multiples of the slide.  Bin-anchored (a window ends every
    ``slide`` minutes), unlike the row-anchored batch W1.
    """
    if any(w % slide for w in windows):
        raise ValueError("window sizes must be multiples of the slide")
    series = [*K, "gateway", "measurement"]
    s = _server(stream).where(F.col("location") == APP_LOCATION).withWatermark("ts", delay)
    v = F.col("value")
    parts = s.groupBy(F.window("ts", f"{slide} minutes").alias("bin"), *series).agg(
        F.count(v).alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("ss"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.count(F.lit(1)).alias("rows"))
    # the bin's own time stays in the row: the sliding window below is taken over the same time
    parts = parts.select(*series, F.window_time("bin").alias("at"), F.col("bin.end").alias("bin_end"), "n", "s", "ss", "lo", "hi", "rows")
    wide = F.window("at", f"{max(windows)} minutes", f"{slide} minutes").alias("w")
    p = parts.select(wide, *series, "bin_end", "n", "s", "ss", "lo", "hi", "rows")

    def inside(c: str, size: int):
        return F.when(F.unix_micros("bin_end") > F.unix_micros("w.end") - size * 60_000_000, F.col(c))

    aggs = []
    for w in windows:
        aggs += [F.sum(inside(c, w)).alias(f"{c}_{w}") for c in ("n", "s", "ss", "rows")]
        aggs += [F.min(inside("lo", w)).alias(f"lo_{w}"), F.max(inside("hi", w)).alias(f"hi_{w}")]
    g = p.groupBy("w", *series).agg(*aggs)

    def size_row(w: int):
        n, total = F.col(f"n_{w}"), F.col(f"s_{w}")
        spread = F.greatest(F.col(f"ss_{w}") - total * total / n, F.lit(0.0))
        return F.struct(F.lit(w).alias("window_minutes"), F.when(n > 0, total / n).alias("mean"),
                        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"), F.col(f"hi_{w}").alias("max"), F.col(f"lo_{w}").alias("min"),
                        F.col(f"rows_{w}").alias("n"))

    rows = F.inline(F.filter(F.array(*[size_row(w) for w in windows]), lambda r: r["n"].isNotNull()))
    out = g.select(*K, F.col("gateway").alias("application"), F.col("measurement").alias("metric_type"), F.col("w.end").alias("time"), rows)
    start = F.timestamp_micros(F.unix_micros("time") - F.col("window_minutes").cast("long") * 60_000_000)
    return out.select(*K, "application", "metric_type", start.alias("window_start"), "time", "window_minutes", "mean", "std", "max", "min", "n")


# R3 ------------------------------------------------------------------------
def stream_dedup(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated (series, ts) rows; state is kept only within the watermark."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark([*SERIES, "field", "ts"])


# R4 ------------------------------------------------------------------------
def stream_alerts(stream: DataFrame, limits: DataFrame) -> DataFrame:
    """Live utilisation above the limit (cpu as 100 - idle per point); limits is a 3-row table."""
    pick = None
    for gw, raw_m, _ in RESOURCE_SOURCES:
        c = (F.col("gateway") == gw) & (F.col("measurement") == raw_m)
        pick = c if pick is None else (pick | c)
    r = _server(stream).where((F.col("location") == RESOURCE_LOCATION) & pick)
    util = F.when(F.col("gateway") == "cpu", F.lit(100.0) - F.col("value")).otherwise(F.col("value"))
    r = r.select(*K, "ts", F.col("gateway").alias("resource_type"), util.alias("value"))
    return r.join(limits, "resource_type").where(F.col("value") > F.col("threshold"))


def stream_resource_minutes(stream: DataFrame, every: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Closed resource minutes in the public form (cpu as 100 - mean idle), from R1."""
    pick = None
    for gw, raw_m, _ in RESOURCE_SOURCES:
        c = (F.col("gateway") == gw) & (F.col("measurement") == raw_m)
        pick = c if pick is None else (pick | c)
    m = stream_window_mean(stream.where((F.col("location") == RESOURCE_LOCATION) & pick), every, delay)
    public = None
    for gw, _, pub in RESOURCE_SOURCES:
        public = F.when(F.col("gateway") == gw, pub) if public is None else public.when(F.col("gateway") == gw, pub)
    return m.select(*K, "time", F.col("gateway").alias("resource_type"), public.alias("measurement"),
                    F.when(F.col("gateway") == "cpu", F.lit(100.0) - F.col("value")).otherwise(F.col("value"))
                    .alias("value"))


# R5 ------------------------------------------------------------------------
def attach_batch(store: str, out: str, lookback_hours: int = 24) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: closed resource minutes meet the stored forecasts of these minutes.

    The forecasts are read anew for every batch, so those stored meanwhile are
    seen; only target times of the batch within ``lookback_hours`` of its newest
    minute are looked up, and the range prunes the table's date folders.  What a
    batch found goes to the folder of its id, which is overwritten: a batch that
    runs again after a failure leaves the same rows.
    """
    def write(minutes: DataFrame, batch_id: int) -> None:
        spark = minutes.sparkSession
        res = canonical_resources(minutes).select(*K, "resource_type", F.col("time").alias("target_time"),
                                                  F.col("value").alias("actual_value")).persist()
        try:
            lo, hi = res.agg(F.min("target_time"), F.max("target_time")).first()
            if hi is None:
                return
            lo = max(lo, hi - _dt.timedelta(hours=lookback_hours))
            due = read_predictions(spark, store).where(F.col("target_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
                                                  & F.col("target_time").between(F.lit(lo), F.lit(hi))
                                                  & F.col("actual_value").isNull() & (F.second("target_time") == 0))
            found = res.join(due.drop("actual_value", "error", "target_date"), [*K, "resource_type", "target_time"])
            found = found.withColumn("error", F.abs(F.col("predicted_value") - F.col("actual_value")))
            found.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            res.unpersist()
    return write


def stream_attach_actuals(minute_res: DataFrame, store: str, base: str, lookback_hours: int = 24) -> None:
    """Run everything available of a stream of resource minutes against the forecasts in ``store``; rows go to ``base/out``."""
    q = (minute_res.writeStream.foreachBatch(attach_batch(store, f"{base}/out", lookback_hours)).outputMode("append")
         .option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    q.awaitTermination()


def attached(spark: SparkSession, base: str) -> DataFrame:
    """The forecasts that have an actual, of all batches so far."""
    return spark.read.parquet(f"{base}/out").drop("batch")


# R6 ------------------------------------------------------------------------
def stream_silence(stream: DataFrame, timeout_minutes: int = 60, delay: str = "10 minutes") -> DataFrame:
    """Entities without data for ``timeout_minutes`` of event time: a row for each pause, and one when they stop.

    A session window of an entity ends ``timeout_minutes`` after its last point,
    so a session that the watermark closes is a silence.  Sessions are merged in
    each partition before the shuffle: a busy entity sends a few rows, not its
    points.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    s = _server(stream).select(*K, "ts").withWatermark("ts", delay)
    g = s.groupBy(F.session_window("ts", f"{timeout_minutes} minutes").alias("w"), *K).agg(F.max("ts").alias("last_seen"))
    return g.select(*K, "last_seen", F.col("w.end").alias("silent_at"))


# runner --------------------------------------------------------------------
def run_available(spark: SparkSession, df: DataFrame, name: str, mode: str = "append",
                  base: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over everything available, write parquet, return it as a table.

    Output and checkpoint go to the session's shared checkpoint folder (or
    ``base``).  Re-running with the same ``base`` resumes from the committed
    offsets and state: nothing is read or written twice (the file sink's
    log makes the output exactly-once).
    """
    base = base or stream_base(spark, name)
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def run_in_arrivals(spark: SparkSession, arrive: Callable[[int, str], None], n: int, source: Callable[[str], DataFrame],
                    job: Callable[[DataFrame], DataFrame], name: str, base: str | None = None) -> DataFrame:
    """Run a job ``n`` times, each time after more files have arrived, from one checkpoint: state outlives the runs.

    ``arrive(i, folder)`` writes the i-th files, ``source(folder)`` is the
    stream over them.
    """
    base = base or stream_base(spark, name)
    for i in range(n):
        arrive(i, f"{base}/in")
        out = run_available(spark, job(source(f"{base}/in")), name, base=base)
    return out


def stream_base(spark: SparkSession, name: str) -> str:
    """A new folder for a stream's files, under the session's shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:8]}")
