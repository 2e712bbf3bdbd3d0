"""Operator 3: approximate nearest neighbours by a forest of hash prefixes.

Distinct vectors are dealt by hash into shards of bounded size.  Each shard has
``TREES`` sorted arrays of 32-bit hash strings (signs of random projections
around the shard's centre).  A query descends every array by binary search to
its longest matching prefixes, then ascends all trees at once, one bit at a
time, until the ranges of rows that share the prefix hold ``WIDTH`` times the
shard's rows, and the rows asked for in every tree, in total (rows count once
a tree).  The rows in these ranges are
compared exactly, in double precision; the best of all shards are merged.
Because every shard is searched in proportion to its size, recall does not
depend on the number of rows.

Edge cases: vectors that are null, empty, all zero or hold null or non-finite
components take no part, nor do rows with a null id; vectors meet only vectors
of their own length; equal vectors are one candidate of the forest and come
back as all their rows, smaller ids first; a repeated (id, vector) row counts
once as a query and as one id among the results per row; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .vectors import finite, search

TREES, BITS, WIDTH = 64, 32, 1.2
SHARD, QUERY_BLOCK = 4096, 1024


def hash_strings(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(trees, rows): the hash strings as unsigned numbers, first bit highest."""
    trees, bits, _ = planes.shape
    out = np.empty((trees, len(x)), np.uint64)
    weights = (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))
    for t in range(trees):
        out[t] = ((x @ planes[t].T) > 0) @ weights
    return out


def ascend(trees: np.ndarray, asked: np.ndarray, bits: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(trees, queries) ranges [lo, hi) of the sorted arrays at each query's synchronous stopping level."""
    n_trees, n_queries = asked.shape
    lo, hi = np.zeros((n_trees, n_queries), np.int64), np.full((n_trees, n_queries), trees.shape[1], np.int64)
    open_ = np.arange(n_queries)
    for depth in range(bits, 0, -1):
        step = np.uint64(1) << np.uint64(bits - depth)
        base = asked[:, open_] & ~(step - np.uint64(1))
        a = np.stack([np.searchsorted(t, b) for t, b in zip(trees, base)])
        b = np.stack([np.searchsorted(t, x + step) for t, x in zip(trees, base)])
        done = (b - a).sum(0) >= least
        lo[:, open_[done]], hi[:, open_[done]] = a[:, done], b[:, done]
        open_ = open_[~done]
        if not len(open_):
            break
    return lo, hi


def _find(n_trees: int, bits: int, width: float, top: int, seed: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"qid": [], "cid": [], "score": []}).astype({"qid": "int64", "cid": "int64", "score": "float64"})
        rows = rows.sort_values("cid", kind="stable")
        cid = rows["cid"].to_numpy()
        x, q = np.stack(rows["vec"].to_numpy()).astype(np.float64), np.stack(asked["vec"].to_numpy()).astype(np.float64)
        rng = np.random.default_rng([seed, x.shape[1]])
        planes = rng.normal(size=(n_trees, bits, x.shape[1]))
        centre = x.mean(0)
        strings = hash_strings(x - centre, planes)
        order = np.argsort(strings, axis=1, kind="stable")
        depth = min(bits, int(np.ceil(np.log2(len(x) + 1))) + 2)  # below this, prefixes hold single rows
        short = np.uint64(bits - depth)
        arrays = np.take_along_axis(strings, order, axis=1) >> short
        # room for the rows asked for in every tree, so that a query's own copy cannot end the ascent by itself
        least = int(np.ceil(width * len(x))) + n_trees * top
        lo, hi = ascend(arrays, hash_strings(q - centre, planes) >> short, depth, least)
        out = []
        for j, qid in enumerate(asked["qid"].tolist()):
            seen = np.zeros(len(x), bool)
            for t in range(n_trees):
                seen[order[t, lo[t, j] : hi[t, j]]] = True
            near = np.flatnonzero(seen)
            d = x[near] - q[j]
            d = np.sqrt((d * d).sum(1))
            best = np.lexsort((cid[near], d))[:top]
            out.append(pd.DataFrame({"qid": qid, "cid": cid[near][best], "score": d[best]}))
        return pd.concat(out, ignore_index=True)
    return run


def nearest(vectors: DataFrame, scratch: Scratch, every: int = 100, top: int = 10, trees: int = TREES, bits: int = BITS,
            width: float = WIDTH, shard: int = SHARD, block: int = QUERY_BLOCK, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows (vec_id, embedding); queries: vec_id divisible by ``every``."""
    v = F.col("embedding")
    rows = (vectors.where(F.col("vec_id").isNotNull() & finite(v) & F.exists(v, lambda x: x != 0))
            .select("vec_id", v.alias("vec")))
    return search(rows, every, top, False, "double", _find(trees, bits, width, top + 1, seed), scratch, shard, block)


def op3_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest other vectors of every hundredth one."""
    return nearest(table(spark, sf_dir, "embeddings"), Scratch(spark, "op3"))


QUERIES = {"op3_prefix_forest": op3_prefix_forest}
ORACLE: dict[str, str] = {}
