"""Steps the vector searches share: valid vectors, classes of equal ones, blocks of queries and rows, merged top lists."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch


def finite(v: Column) -> Column:
    """True for a non-empty vector without null, NaN or infinite components."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(ok(x), F.lit(False))), F.lit(False))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(cid, ids, vec): equal vectors as one, with their ``keep`` smallest ids; cid is the smallest.

    A class may hold any share of all rows: the limit per class is taken before
    the shuffle as well as after it.
    """
    w = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("cid"), "ids", "vec")


def search(rows: DataFrame, every: int, top: int, best_first: bool, score_type: str,
           find: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], scratch: Scratch, shard: int, block: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` other rows, ties to the smaller vec_id.

    ``find`` gets the classes of one shard and the query vectors of one block
    and returns (qid, cid, score) of each query's ``top + 1`` best classes.
    Shards and blocks are of bounded size and meet on an explicit key; a
    query's own class is a candidate until the end, when the query itself goes.
    """
    # a vec_id may repeat with different vectors: the row, not the id, is the candidate; equal rows are one candidate each
    all_classes = scratch.save(classes(rows, top + 1), "classes")
    queries = rows.where(F.col("vec_id") % every == 0)
    asked = scratch.save(queries.groupBy("vec").agg(F.min("vec_id").alias("qid")), "queries")
    n_shards = max(1, -(-all_classes.count() // shard))
    n_blocks = max(1, -(-asked.count() // block))
    to = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    at = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = all_classes.select(F.size("vec").alias("dim"), at("cid", n_shards).alias("shard"), F.explode(to(n_blocks)).alias("block"), "cid", "vec")
    right = asked.select(F.size("vec").alias("dim"), F.explode(to(n_shards)).alias("shard"), at("qid", n_blocks).alias("block"), "qid", "vec")
    key = ["dim", "shard", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(find, f"qid long, cid long, score {score_type}")
    order = [F.desc("score") if best_first else F.asc("score"), F.asc("vec_id")]
    # the best classes of a query over all shards, then their rows
    w = Window.partitionBy("qid").orderBy(order[0], F.asc("cid"))
    found = found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top + 1).drop("place")
    found = scratch.save(found, "found")
    hits = found.join(all_classes.select("cid", "ids"), "cid").select("qid", F.explode("ids").alias("vec_id"), "score")
    w = Window.partitionBy("qid").orderBy(*order)
    hits = hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top + 1).drop("place")
    hits = scratch.save(hits, "hits")
    # a query's class by content; rows that share an id and a vector are one query
    mine = scratch.save(queries.select(F.col("vec_id").alias("query_id"), "vec").distinct().join(asked, "vec").select("query_id", "qid"), "mine")
    out = mine.join(hits, "qid").where("vec_id <> query_id")
    w = Window.partitionBy("query_id").orderBy(*order)
    return (out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
