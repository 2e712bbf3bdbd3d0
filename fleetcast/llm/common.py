"""Helpers the training-data operators share: shared scratch tables, word splitting, hashing, components."""

from __future__ import annotations

import time
import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written tables in the shared folder of ``spark.checkpoint.dir``.

    A written table cuts lineage and survives the loss of an executor: every
    later stage reads files that all executors share.
    """

    def __init__(self, spark: SparkSession, label: str):
        conf = spark.conf.get("spark.checkpoint.dir", None)
        self.spark = spark
        self.root = f"{(conf or ensure_checkpoint_dir(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").parquet(path, compression=codec)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let go of the shuffle files of finished steps: Spark deletes them when the driver collects its garbage."""
        for _ in range(2):  # what listeners still hold goes the second time
            self.spark._jvm.System.gc()
            time.sleep(0.3)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z (bytes methods are ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash; emptied when full, so a worker's memory is bounded."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One cache of a worker for all operators.
WORDS = WordHashes()


def mix64(h: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit mixer (wrap-around arithmetic)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct sorted 64-bit hashes of the word runs of ``width``; a shorter text is one run of its own length."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(n, width)
    acc = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i : n - k + 1 + i])
    return np.unique(acc)


def connected_components(scratch: Scratch, edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): smallest node reachable over ``edges`` (a, b), roots included; nodes without edges are absent.

    Alternates two set-based steps on written tables.  Large star: every node
    hands its larger neighbours to its smallest one.  Small star: it hands its
    smaller neighbours to the smallest.  Both use a min aggregate with
    map-side partials and a join, so a hub is never gathered in one task, and
    the forest flattens in a logarithmic number of rounds.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = scratch.save(e, f"{label}-0")
    for i in range(1, max_rounds + 1):
        # done when every edge leads straight to a root: one edge a node, and no node is both ends
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up")).union(e.select(F.col("v").alias("x"), F.lit(0).alias("up")))
        if ends.groupBy("x").agg(F.sum("up").alias("n"), F.min("up").alias("m")).where("n > 1 or (n = 1 and m = 0)").isEmpty():
            roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the joins are plain exchanges: the engine can then split a hub's rows
        low = scratch.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{label}-low-{i}")
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .distinct())
        large = scratch.save(large, f"{label}-large-{i}")
        low = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), f"{label}-small-{i}")
        small = large.join(low, "u")
        e = (small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                          F.col("m").alias("v")).where("u <> v").distinct())
        e = scratch.save(e, f"{label}-{i}")
        for old in (f"{label}-{i - 1}", f"{label}-low-{i}", f"{label}-large-{i}", f"{label}-small-{i}"):
            scratch.drop(old)
    raise RuntimeError("components did not settle")


def tile(scratch: Scratch, entries: DataFrame, key: str, node: str, comp: str | None, size: int, label: str,
         nodes_with: DataFrame | None = None) -> DataFrame:
    """Deal the entries of every key into tiles of bounded size for pair search.

    Adds ``tile_kind``, ``tile_i``, ``tile_j``, ``side`` and ``crossed``.
    Keys whose entries all belong to one component, or that have one entry,
    are left out: they hold no pair worth a look.  A key of up to ``size``
    entries is one tile.  In a larger one, pairs inside its most frequent
    component need no look either, so the rest is cut into parts that meet
    each other and the parts of that component; a key with one large component
    and few others costs rows in proportion to its size.  Without ``comp``
    every entry counts as a component.  ``nodes_with`` has further columns of the
    nodes; only entries of the keys that stay get them.
    """
    if comp is None:
        nodes = scratch.save(entries.groupBy(key).agg(F.count("*").alias("node_n")).where("node_n > 1"), f"{label}-nodes")
        scratch.release()
        e, columns = entries.join(nodes, key), entries.columns
        if nodes_with is not None:
            e = scratch.save(e, f"{label}-met")
            scratch.release()
            e = e.join(nodes_with, node)
            columns = [*columns, *[c for c in nodes_with.columns if c != node]]
        return _tiles(e, columns, key, node, None, size)
    per = scratch.save(entries.groupBy(key, comp).agg(F.count("*").alias("c")), f"{label}-per")
    nodes = (per.groupBy(key).agg(F.count("*").alias("comps"), F.sum("c").alias("node_n"), F.max("c").alias("node_top"),
                                  F.max_by(comp, F.struct("c", comp)).alias("node_dom"))
             .where("comps > 1").drop("comps"))
    nodes = scratch.save(nodes, f"{label}-nodes")
    e, columns = entries.join(nodes, key), entries.columns
    if nodes_with is not None:
        e = scratch.save(e, f"{label}-met").join(nodes_with, node)
        columns = [*columns, *[c for c in nodes_with.columns if c != node]]
    return _tiles(e, columns, key, node, comp, size)


def _tiles(e: DataFrame, columns: list[str], key: str, node: str, comp: str | None, size: int) -> DataFrame:
    small = F.col("node_n") <= size
    parts = lambda c: F.ceil(c / size).cast("int")
    big = (e.where(~small).withColumn("tile_dom", F.lit(False) if comp is None else F.col(comp) == F.col("node_dom"))
           .withColumn("tile_pr", F.greatest(F.lit(1), parts(F.col("node_n") - (0 if comp is None else F.col("node_top")))))
           .withColumn("tile_pd", F.lit(0) if comp is None else parts(F.col("node_top")))
           .withColumn("tile_part", F.pmod(F.xxhash64(node), F.when(F.col("tile_dom"), F.col("tile_pd")).otherwise(F.col("tile_pr"))).cast("int")))
    to = lambda c: F.sequence(F.lit(0), c - 1)
    spot = lambda kind, i, j, side, crossed: F.struct(F.lit(kind).alias("tile_kind"), i.alias("tile_i"), j.alias("tile_j"),
                                                      side.cast("int").alias("side"), crossed.alias("crossed"))
    own, no, yes = F.col("tile_part"), F.lit(0), F.lit(True)
    rest = F.transform(to(F.col("tile_pr")), lambda j: spot(1, F.least(own, j), F.greatest(own, j), own > j, own != j))
    spots = rest if comp is None else F.when(F.col("tile_dom"), F.transform(to(F.col("tile_pr")), lambda i: spot(2, i, own, F.lit(1), yes))).otherwise(
        F.concat(rest, F.transform(to(F.col("tile_pd")), lambda j: spot(2, own, j, no, yes))))
    cols = [*columns, "tile_kind", "tile_i", "tile_j", "side", "crossed"]
    big = big.withColumn("tile_spot", F.explode(spots)).select("*", "tile_spot.*").select(*cols)
    one = e.where(small).select(*columns, F.lit(0).alias("tile_kind"), no.alias("tile_i"), no.alias("tile_j"),
                                no.alias("side"), F.lit(False).alias("crossed"))
    return (one.unionByName(big).repartition(key, "tile_kind", "tile_i", "tile_j")
            .sortWithinPartitions(key, "tile_kind", "tile_i", "tile_j", node))


TILE = ["tile_kind", "tile_i", "tile_j"]


def slices(batches, n: int):
    """Frames of at most ``n`` rows: what a worker holds beside the Arrow batch stays small."""
    for pdf in batches:
        for a in range(0, len(pdf), n):
            yield pdf.iloc[a : a + n]


def whole_keys(batches, key: list[str]):
    """(frame, group number of each row) with whole keys only, from partitions sorted by the key."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        number = _numbers(pdf, key)
        cut = int(np.searchsorted(number, number[-1]))  # the last key may go on in the next batch
        if cut:
            yield pdf.iloc[:cut].reset_index(drop=True), number[:cut]
        rest = pdf.iloc[cut:]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True), np.zeros(len(rest), np.int64)


def _numbers(pdf: pd.DataFrame, key: list[str]) -> np.ndarray:
    change = np.zeros(len(pdf), bool)
    for k in key:
        v = pdf[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.cumsum(change)


def groups_of(batches, key: list[str]):
    """The rows of each key from partitions sorted by it; a key may run over several Arrow batches."""
    for pdf, number in whole_keys(batches, key):
        starts = np.r_[0, np.flatnonzero(np.diff(number)) + 1, len(pdf)]
        for a, b in zip(starts[:-1], starts[1:]):
            yield pdf.iloc[a:b]


def pairs_within(number: np.ndarray):
    """Pairs of rows of the same group, as index arrays: all at distance 1, then 2, and so on."""
    i = np.arange(len(number))
    k = 1
    while True:
        i = i[i + k < len(number)]
        i = i[number[i] == number[i + k]]
        if not len(i):
            return
        for a in range(0, len(i), 500_000):
            yield i[a : a + 500_000], i[a : a + 500_000] + k
        k += 1


def clear_of(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not use (extra input columns may clash)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = "_" + name
    return name
