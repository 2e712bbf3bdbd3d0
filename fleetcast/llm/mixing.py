"""Operator 11: mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key; documents are range-sorted by (source,
key), running sums of their sizes are taken over the parts, and each source is
cut at its budget: whole passes over the source first, then the documents whose
running sum lies below the rest, the last of them in part.  A source's taken
words are its budget exactly.

Targets: a source's weight share of the total, at most ``most`` times its size;
what that leaves over is shared again by weight.  With sources in ascending
order of (limit / weight), the shares of all from the first source whose limit
holds its share are settled by two running sums; no loop is needed.

A source may hold any share of all rows: it is many parts of the range sort.
The driver gets two rows: the total, and the source where the limits end.

Edge cases: a null text has no words; a document without words is taken zero
times; a null source is a source of its own, ordered last; a null ``doc_id`` has
one key for all; rows that repeat are documents of their own (equal ones are
interchangeable, so reruns agree); an empty table, or one without words, gives
no rows or zeros; very long texts are counted whole; extra columns are ignored
(``carry`` names those to keep, whatever they are called).
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .running import running

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
GAP, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
WIDE = "decimal(38,0)"


def n_words(text: Column) -> Column:
    """Number of words: every word with the gap after it becomes one letter."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{GAP}+", "")
    return F.length(F.regexp_replace(bare, f"{WORD}+{GAP}*", "x")).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.split(text, f"(?<={WORD})(?={GAP})"), F.lit(1), n), "")


def targets(sources: DataFrame, total: int, weights: tuple[int, ...], most: int, scratch: Scratch) -> DataFrame:
    """(none, src, source_size, target, budget) of ``sources`` (none, src, source_size); budget is target without its fraction."""
    s = running(sources, [], ["none", "src"], {"place": F.lit(1)}, scratch, "places")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    s = s.withColumns({"weight": weight, "limit": F.col("source_size") * most})
    s = s.withColumn("ratio", F.col("limit") * (F.lit(lcm(*weights)) / F.col("weight")).cast("long"))
    s = running(s, [], ["ratio", "none", "src"], {"spent": F.col("limit"), "passed": F.col("weight")}, scratch, "limits")
    s = scratch.save(s, "sources")
    all_weight = s.agg(F.sum("weight")).first()[0] or 0
    rest, left = F.lit(total) - F.col("spent"), F.lit(all_weight) - F.col("passed")
    holds = F.col("limit").cast(WIDE) * left.cast(WIDE) >= rest.cast(WIDE) * F.col("weight").cast(WIDE)
    free = s.where(holds).orderBy("ratio", "none", "src").select(rest.alias("rest"), left.alias("left")).first()
    if free is None:  # more asked for than all limits together
        share, whole = F.col("limit").cast("double"), F.col("limit")
    else:
        words = F.lit(free["rest"]) * F.col("weight")
        share = F.least(F.col("limit").cast("double"), words.cast("double") / F.lit(float(free["left"])))
        whole = F.least("limit", F.expr(f"({free['rest']}L * weight) div {free['left']}L"))
    return s.select("none", "src", "source_size", share.alias("target"), whole.cast("long").alias("budget"))


def budgeted(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, total: int | None = None, most: int = MOST,
             carry: tuple[str, ...] = (), seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, carried): one row a document; ``total`` is all words if None.

    ``carried`` is a struct of the columns named in ``carry`` (null without).
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    key = F.conv(F.substring(F.sha2(name, 256), 1, 15), 16, 10).cast("long")
    kept = F.struct(*carry) if carry else F.lit(None).cast("string")
    rows = docs.select("doc_id", "source", F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("src"),
                       key.alias("key"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("print"),
                       F.monotonically_increasing_id().alias("mid"), kept.alias("carried"))  # mid parts equal documents
    rows = scratch.save(rows, "sized")
    sources = scratch.save(rows.groupBy("none", "src").agg(F.sum("size").alias("source_size")), "sizes")
    total = sources.agg(F.sum("source_size")).first()[0] or 0 if total is None else total
    goal = scratch.save(targets(sources, total, weights, most, scratch), "targets")
    rows = running(rows, ["none", "src"], ["key", "doc_id", "size", "print", "mid"], {"before": F.col("size")}, scratch, "sorted")
    passes = F.expr("if(source_size = 0, 0, budget div source_size)")
    rest = F.expr("if(source_size = 0, 0, budget % source_size)")
    part = F.greatest(F.lit(0), F.least("size", rest - F.col("before")))
    return (rows.join(goal, ["none", "src"])
            .select("doc_id", "source", "size", "source_size", "target", (passes * F.col("size") + part).cast("long").alias("taken"), "carried"))


def mix(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, total: int | None = None, most: int = MOST) -> DataFrame:
    """(doc_id, source, pass, words, text): the mix itself, a row for each time a document is taken, the cut one in part."""
    rows = budgeted(docs, scratch, weights, total, most, carry=("text",)).where("taken > 0")
    times = rows.withColumn("pass", F.explode(F.expr("sequence(0, cast((taken - 1) div size as int))")))
    words = F.least("size", F.col("taken") - F.col("pass") * F.col("size"))
    text = F.when(words == F.col("size"), F.col("carried.text")).otherwise(first_words(F.col("carried.text"), words.cast("int")))
    return times.select("doc_id", "source", "pass", words.alias("words"), text.alias("text"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 5, 2, 1 of their sources."""
    return budgeted(table(spark, sf_dir, "documents"), Scratch(spark, "op11")).drop("source", "carried")


ORACLE = {"op11_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS key
  FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, {MOST} * source_size AS lim,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight FROM s),
o AS (SELECT *, row_number() OVER l AS place,
             (SELECT sum(source_size) FROM s) - sum(lim) OVER l + lim AS rest, (SELECT sum(weight) FROM w) - sum(weight) OVER l + weight AS remaining
      FROM w WINDOW l AS (ORDER BY lim * 10 // weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
f AS (SELECT rest, remaining FROM o WHERE lim * remaining >= rest * weight ORDER BY place LIMIT 1),
t AS (SELECT o.source, o.source_size, least(CAST(lim AS DOUBLE), CAST(f.rest * weight AS DOUBLE) / CAST(f.remaining AS DOUBLE)) AS target,
             least(lim, f.rest * weight // f.remaining) AS budget FROM o, f),
r AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS before FROM d)
SELECT r.doc_id, r.size, CAST(t.source_size AS BIGINT) AS source_size, t.target,
       CAST(CASE WHEN t.source_size = 0 THEN 0
            ELSE (budget // t.source_size) * size + greatest(0, least(size, budget % t.source_size - before)) END AS BIGINT) AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
"""}
QUERIES = {"op11_mixing": op11_mixing}
