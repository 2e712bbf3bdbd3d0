"""Retention (L1-L3, A19): which rows stay, and pruning a stored table to them.

``prune`` compares the partitions of a stored table before and after a cut and
touches only those that lose rows: one that loses all is dropped, one that
loses some is overwritten.  With the table partitioned by the time that is cut,
an age cut is mostly dropped folders and one rewritten one.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import ts_lit


def _ts(v) -> Column:
    return ts_lit(v) if isinstance(v, (str, _dt.datetime)) else v


# L1 / L3 -------------------------------------------------------------------
def retain(df: DataFrame, ts: str, now, days: int) -> DataFrame:
    """Rows with ``ts >= now - days``."""
    return df.where(F.col(ts) >= _ts(now) - F.make_dt_interval(F.lit(days)))


# L2 ------------------------------------------------------------------------
def prune_predictions(pred: DataFrame, now, retention_days: int = 7, keep_days: int = 1) -> DataFrame:
    """Age cut, then drop forecasts superseded by a newer one for the same target (ties kept)."""
    kept = retain(pred, "prediction_time", now, retention_days)
    w = Window.partitionBy("tenant", F.coalesce(F.col("device_id"), F.lit("")), "target_time", "resource_type")
    old_target = F.col("target_time") < _ts(now) - F.make_dt_interval(F.lit(keep_days))
    latest = F.max("prediction_time").over(w)
    return kept.withColumn("_latest", latest).where(~old_target | (F.col("prediction_time") >= F.col("_latest"))) \
               .drop("_latest")


# the stored table ----------------------------------------------------------
@dataclass(frozen=True)
class Pruned:
    """Partitions by what became of them, and rows removed."""
    dropped: list[tuple]
    rewritten: list[tuple]
    untouched: int
    rows: int


def prune(spark: SparkSession, path: str, keep: Callable[[DataFrame], DataFrame], parts: Sequence[str]) -> Pruned:
    """Reduce the table at ``path``, partitioned by ``parts`` (text or dates), to the rows of ``keep(table)``.

    The driver gets two counts for each partition.  Partitions that lose some
    rows are written in one job with dynamic partition overwrite, whose files
    replace the old ones when all tasks have ended; those that lose all are
    deleted after it.  A run that fails in between leaves rows that the next run
    removes; a run on a pruned table changes nothing.
    """
    # partition values as the folders spell them: a batch '001' is not the number 1
    fields = [T.StructField(f.name, T.StringType()) if f.name in parts else f for f in spark.read.parquet(path).schema.fields]
    table = spark.read.schema(T.StructType(fields)).parquet(path)
    count = lambda df, name: df.groupBy(*parts).agg(F.count(F.lit(1)).alias(name))
    found = count(table, "before").join(count(keep(table), "after").withColumnsRenamed({p: f"_{p}" for p in parts}),
                                        [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts], "left").collect()
    key = lambda r: tuple(r[p] for p in parts)
    gone = sorted(key(r) for r in found if not r["after"])
    less = sorted(key(r) for r in found if r["after"] and r["after"] < r["before"])
    if less:
        lists = [F.struct(*[F.lit(v).alias(p) for p, v in zip(parts, k)]) for k in less]
        rows = keep(table).where(F.struct(*parts).isin(lists) if len(parts) > 1 else F.col(parts[0]).isin([k[0] for k in less]))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    for k in gone:
        p = folder("/".join([path, *[f"{n}={v}" for n, v in zip(parts, k)]]))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return Pruned(gone, less, len(found) - len(gone) - len(less), sum(r["before"] - (r["after"] or 0) for r in found))


# A19 -----------------------------------------------------------------------
def retention_stats(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("total_records"), F.min("prediction_time").alias("oldest"),
                    F.max("prediction_time").alias("latest"),
                    F.countDistinct(F.to_date("target_time")).alias("unique_days"))


def performance_retention_stats(perf: DataFrame) -> DataFrame:
    return perf.agg(F.count(F.lit(1)).alias("total_records"), F.min("trained_at").alias("oldest"),
                    F.max("trained_at").alias("latest"), F.countDistinct("application").alias("unique_apps"))
