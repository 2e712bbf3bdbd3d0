"""Operator 1: chat formatting with rotated perspectives, in DataFrame functions only.

For every participant of a conversation (every speaker but the moderators) the
dialogue is rendered with that participant as the assistant and all others as
named users; a mask lists the character ranges the assistant is trained on (its
texts with their end markers).  Markers that a text holds itself are defused.

A conversation may hold any share of all turns, so no step gathers one: turns
are numbered over range partitions (a count for each conversation and partition,
then places within them), and a rendering is a row for every ``BLOCK`` turns.
Blocks of a perspective join, in order, to the whole rendering.

Edge cases: a null role speaks as 'unknown'; a null text is empty; null turns
come first; turns that tie are ordered by speaker and text, and repeated turns
all stay; a null ``conv_id`` is a conversation of its own; conversations of
moderators alone have no perspective and give no rows; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

BLOCK = 32
MODERATORS = ("system",)
END = "<|end|>\n"


def numbered(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, speaker, body, seq): turns with their place in the conversation, from 0."""
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("speaker"),
                     F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("body"),
                     F.monotonically_increasing_id().alias("mid"))
    order = ["conv_id", "turn", "speaker", "body", "mid"]  # the last one parts equal turns
    t = t.repartitionByRange(*order).sortWithinPartitions(*order)
    t = scratch.save(t.select("conv_id", "speaker", "body", F.spark_partition_id().alias("part"),
                              F.monotonically_increasing_id().alias("k")), "turns")
    per = t.groupBy("conv_id", "part").agg(F.count("*").alias("c"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("conv_id").alias("p_conv"), F.col("part").alias("p_part"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("k")) - 1
    return (t.withColumn("place", place).join(per, F.col("conv_id").eqNullSafe(F.col("p_conv")) & (F.col("part") == F.col("p_part")))
            .select("conv_id", "speaker", "body", (F.col("base") + F.col("place")).alias("seq")))


def perspectives(turns: DataFrame, scratch: Scratch, block: int = BLOCK, moderators: tuple[str, ...] = MODERATORS) -> DataFrame:
    """(conv_id, perspective, block, n_turns, text, mask): mask has 'start-end' ranges of ``text``, joined by commas."""
    t = scratch.save(numbered(turns, scratch), "numbered")
    who = (t.where(~F.col("speaker").isin(*moderators)).select(F.col("conv_id").alias("w_conv"), F.col("speaker").alias("perspective")).distinct())
    who = scratch.save(who, "participants")
    own = F.col("speaker") == F.col("perspective")
    head = (F.when(F.col("speaker").isin(*moderators), F.concat(F.lit("<|"), "speaker", F.lit("|>\n")))
            .when(own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user|>"), "speaker", F.lit("\n"))))
    rows = (t.join(who, F.col("conv_id").eqNullSafe(F.col("w_conv")))
            .select("conv_id", "perspective", F.floor(F.col("seq") / block).alias("block"), "seq", own.alias("own"),
                    F.length(head).alias("skip"), F.concat(head, "body", F.lit(END)).alias("seg")))
    turn = F.struct("seq", "own", "skip", F.length("seg").alias("size"), "seg")
    b = rows.groupBy("conv_id", "perspective", "block").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    offset = "aggregate(slice(turns, 1, i), 0, (a, t) -> a + t.size)"
    ranges = (f"filter(transform(turns, (t, i) -> if(t.own, concat(cast({offset} + t.skip as string), '-', "
              f"cast({offset} + t.size as string)), null)), x -> x is not null)")
    return b.select("conv_id", "perspective", "block", F.size("turns").cast("long").alias("n_turns"),
                    F.array_join("turns.seg", "").alias("text"), F.expr(f"array_join({ranges}, ',')").alias("mask"))


def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side."""
    return perspectives(table(spark, sf_dir, "conversations"), Scratch(spark, "op1"))


ORACLE = {"op1_chat_perspectives": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, body) - 1 AS seq FROM t),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT s.conv_id, perspective, seq // {BLOCK} AS block, seq, body, speaker = perspective AS own,
         CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10) WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user|>' || speaker || chr(10) END AS head
  FROM s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
g AS (SELECT *, head || body || '<|end|>' || chr(10) AS seg FROM r),
o AS (SELECT *, sum(length(seg)) OVER (PARTITION BY conv_id, perspective, block ORDER BY seq) - length(seg) AS off FROM g)
SELECT conv_id, perspective, CAST(block AS BIGINT) AS block, count(*) AS n_turns, string_agg(seg, '' ORDER BY seq) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(off + length(head) AS VARCHAR) || '-' || CAST(off + length(seg) AS VARCHAR) END, ',' ORDER BY seq), '') AS mask
FROM o GROUP BY conv_id, perspective, block
"""}
QUERIES = {"op1_chat_perspectives": op1_chat_perspectives}
