"""Scans over long series in chunks of time: what one row needs from all rows before it, without one task per key.

A key's rows are cut into chunks (a day by default).  Each chunk is summarised in
one row, an exclusive scan over the summaries (a row per key and chunk) gives what
a chunk starts with, and a second pass inside the chunks adds the rest.  The
chunk is in every shuffle key of the rows, so a key that holds a large share of
all rows is spread over its chunks.  A moving frame needs the rows just before
its chunk instead: those are copied into it (``with_halo``).

Keys may be null.  The columns ``_chunk``, ``_own`` and ``_seg*`` must be free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_US = 24 * 3_600_000_000


def chunk_of(ts: str, chunk_us: int = DAY_US) -> Column:
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(chunk_us))


def _with_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` beside their chunk's summary row; null keys are equal."""
    renamed = summary.withColumnsRenamed({k: f"_seg_{k}" for k in (*keys, "_chunk")})
    on = F.col("_chunk") == F.col("_seg__chunk")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_seg_{k}"))
    return rows.join(renamed, on).drop(*[f"_seg_{k}" for k in (*keys, "_chunk")])


def numbered(df: DataFrame, keys: Sequence[str], ts: str, chunk_us: int = DAY_US) -> DataFrame:
    """``df`` with ``_i``, a row's place in its key's time order from 0, and ``_n``, the rows of its key."""
    rows = df.withColumn("_chunk", chunk_of(ts, chunk_us))
    per = rows.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_segc"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_chunk", F.coalesce(F.sum("_segc").over(before), F.lit(0)).alias("_segb"), F.sum("_segc").over(whole).alias("_n"))
    place = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(ts)) - 1
    return _with_summary(rows.withColumn("_segi", place), per, keys).withColumn("_i", F.col("_segi") + F.col("_segb")).drop("_segi", "_segb", "_chunk")


def carried(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], chunk_us: int = DAY_US) -> DataFrame:
    """``df`` with each of ``columns`` forward filled: its last non-null value up to the row, over all chunks."""
    rows = df.withColumn("_chunk", chunk_of(ts, chunk_us))
    last = rows.groupBy(*keys, "_chunk").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_segl{i}") for i, c in enumerate(columns)])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select(*keys, "_chunk", *[F.last(f"_segl{i}", ignorenulls=True).over(before).alias(f"_segb{i}") for i in range(len(columns))])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    filled = {f"_segv{i}": F.last(c, ignorenulls=True).over(inside) for i, c in enumerate(columns)}
    out = _with_summary(rows.withColumns(filled), last, keys)
    out = out.withColumns({c: F.coalesce(f"_segv{i}", f"_segb{i}") for i, c in enumerate(columns)})
    return out.select(*df.columns)


def with_halo(df: DataFrame, ts: str, reach_us: int, chunk_us: int = DAY_US) -> DataFrame:
    """Rows with their ``_chunk``, and once more in the next chunk (``_own`` false) where a frame of ``reach_us`` from there reaches back to them.

    A frame over (t - reach, t] of an own row then lies inside its chunk.
    """
    if reach_us > chunk_us:
        raise ValueError("a chunk must be as long as the longest frame")
    own = chunk_of(ts, chunk_us)
    near = F.unix_micros(F.col(ts)) > (own + 1) * F.lit(chunk_us) - F.lit(reach_us)
    places = F.when(near, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("_chunk", F.explode(places)).withColumn("_own", F.col("_chunk") == own)
