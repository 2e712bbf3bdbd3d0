"""Operator 6: exact top-k inner products by aggregation without random access.

Vectors become integers, floor(256 x).  Distinct vectors are dealt by hash into
shards of bounded size; in a shard every dimension is a sorted list.  A query
reads each list from the end its weight prefers, all lists to the same depth;
what is unread is halved from one look at the bounds to the next.
What it has read gives every row a lower bound (unread components at the list's
far end) and an upper bound (unread ones at the list's front as read so far).
Rows whose upper bound is under the k-th best lower bound are out; reading
stops when no more rows than asked for are left or all are read.  The lists
are then read on for the few remaining rows alone, which gives the final scores.  Bounds
of all queries of a block come from matrix products over what has been read.
The best of all shards are merged; the result is exact.

Edge cases: vectors that are null, empty or hold null or non-finite components
take no part, nor do rows with a null id; zero vectors do; vectors meet only
vectors of their own length; equal integer vectors are one candidate and come
back as their rows, smaller ids first; ties go to the smaller id; an empty
table gives no rows; extra columns are ignored.  Scores are 64-bit integers: a
sum of products beyond them wraps around.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .vectors import finite, search

SHARD, QUERY_BLOCK = 4096, 1024
#: Looks at the bounds before the lists are read to their ends; each halves what is unread.
LOOKS = 6


def bounds(x: np.ndarray, place: np.ndarray, ends: np.ndarray, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, rows) lower and upper bounds of the rows ``x`` after ``depth`` entries of every list.

    ``place`` is a row's place in the ascending list of each dimension and
    ``ends`` the sorted lists, of all rows.  Positive weights read from the high end.
    """
    n = len(ends)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    seen_up, seen_down = place >= n - depth, place < depth
    read = up @ np.where(seen_up, x, 0).T + down @ np.where(seen_down, x, 0).T
    if depth >= n:
        return read, read
    far_up, far_down = ends[0], ends[-1]  # least product: the lowest value for positive weights, the highest for negative
    near_up, near_down = ends[n - depth], ends[depth - 1]  # last values read
    new_up, new_down = ~seen_up, ~seen_down
    lower = read + (up * far_up) @ new_up.T + (down * far_down) @ new_down.T
    upper = read + (up * near_up) @ new_up.T + (down * near_down) @ new_down.T
    return lower, upper


def top_rows(x: np.ndarray, q: np.ndarray, top: int, read: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows of ``x`` (double, whole numbers) that hold each query's ``top`` best, all ties at the edge included.

    ``read``, if given, gets the entries of a list that each query has read before its bounds were enough.
    """
    n = len(x)
    order = np.argsort(x, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
    ends = np.take_along_axis(x, order, axis=0)
    out: list[np.ndarray] = [np.arange(n)] * len(q)
    open_ = np.arange(len(q))
    if n <= top:
        return out
    rows = np.arange(n)  # rows that some open query may still need; its best lower bounds are among them
    for look in range(1, LOOKS + 2):
        depth = n - (n >> look) if look <= LOOKS else n
        lower, upper = bounds(x[rows], place[rows], ends, q[open_], depth)
        edge = np.partition(lower, len(rows) - top, axis=1)[:, len(rows) - top]
        may = upper >= edge[:, None]
        done = may.sum(1) <= 4 * top if depth < n else np.ones(len(open_), bool)
        for i in np.flatnonzero(done).tolist():
            out[open_[i]] = rows[may[i]]
        if read is not None:
            read[open_] = depth
        open_ = open_[~done]
        if not len(open_):
            break
        rows = rows[may[~done].any(0)]
    return out


def _find(top: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"qid": [], "cid": [], "score": []}).astype("int64")
        rows = rows.sort_values("cid", kind="stable")
        cid = rows["cid"].to_numpy()
        xi, qi = np.stack(rows["vec"].to_numpy()).astype(np.int64), np.stack(asked["vec"].to_numpy()).astype(np.int64)
        size = float(np.abs(xi).max(initial=0)) * float(np.abs(qi).max(initial=0)) * xi.shape[1]
        # doubles hold the products exactly up to 2^53; beyond that every row is scored in whole numbers
        keep = top_rows(xi.astype(np.float64), qi.astype(np.float64), top) if size < 2.0**53 else [np.arange(len(xi))] * len(qi)
        out = []
        for j, qid in enumerate(asked["qid"].tolist()):
            score = xi[keep[j]] @ qi[j]
            best = np.lexsort((cid[keep[j]], -score))[:top]
            out.append(pd.DataFrame({"qid": qid, "cid": cid[keep[j]][best], "score": score[best]}))
        return pd.concat(out, ignore_index=True)
    return run


def top_products(vectors: DataFrame, scratch: Scratch, every: int = 50, top: int = 5, scale: int = 256, shard: int = SHARD,
                 block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows (vec_id, embedding); queries: vec_id divisible by ``every``."""
    v = F.col("embedding")
    rows = (vectors.where(F.col("vec_id").isNotNull() & finite(v))
            .select("vec_id", F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vec")))
    return search(rows, every, top, True, "long", _find(top + 1), scratch, shard, block)


def op6_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector."""
    return top_products(table(spark, sf_dir, "embeddings"), Scratch(spark, "op6"))


ORACLE = {"op6_nra_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * c.vec[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""}
QUERIES = {"op6_nra_topk": op6_nra_topk}
