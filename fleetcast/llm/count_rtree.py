"""Operator 9: n-gram Jaccard join over an R-tree of group counts.

The word shingles of a document are hashed into groups; a document is the point
of its group counts, and for any two sets the overlap is at most the sum of the
smaller coordinates.  The tree uses that bound on three levels.

* Root.  The groups are the 2^32 hash prefixes.  A document's overlap with
  anything else is at most the number of its shingles whose group another
  document has as well: the minima against the upper corner of all other
  points.  It is enough to look at each document's first groups in hash order,
  as long as ``c`` of the shared ones must lie among them (see ``prefix_size``).
  Most documents end here.
* Branches.  A survivor enters the branch of each of its rarest shared groups;
  two documents that link are sure to meet in one branch.
* Leaves.  In a branch, points are folded to 128 groups, sorted by set size and
  boxed; the summed minima against a box's upper corner, then against its
  points, bound the overlap.  The pairs that remain are verified on their texts.

Equal sets are one point from the start.  Before the branches are searched,
documents with equal minimal groups (under a few orders) are compared with the
most shared document among them, and linked ones merge: large groups of near copies
fall into few components, and a branch looks only at pairs of different ones.
No pair of different components is left out, so the components are exact.

Edge cases: null or empty texts and texts without words have no shingles, link
with nothing and are their own component; a text with fewer words than a
shingle is one shingle; rows that repeat a ``doc_id`` are joined in its
component; a null ``doc_id`` takes no part and comes back with a null component
and no shingles counted; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (TILE, WORDS, Scratch, connected_components, groups_of, pairs_within, shingle_hashes, slices, table, tile,
                     whole_keys, words_of)

#: The contract of op9: four words, 85 of 100.
WIDTH, PERCENT = 4, 85
#: Documents of a root block on average; coordinates of a folded point; points of a box; entries of a tile.
BLOCK, FOLD, BOX, TILE_SIZE = 2048, 128, 32, 1024
#: Keys by which a document is compared with the most shared one of those that have it too.
ROUNDS = 3


def needed(n, percent: int):
    """Least overlap that a set of n must have with any partner."""
    return -(-(percent * n) // 100)


def extra(n, percent: int):
    """How many of a pair's common shingles are asked for among the first ones."""
    return np.maximum(1, n - needed(n, percent))


def prefix_size(n, percent: int):
    """Two linked sets have at least ``extra`` common shingles among their first ``prefix_size`` ones."""
    return np.minimum(n, n - needed(n, percent) + extra(n, percent))


def asked(n, percent: int):
    """``extra`` of the smallest partner that a set of n can have: no linked pair has fewer in common."""
    return extra(needed(n, percent), percent)


def shingles(text: str | None, width: int) -> np.ndarray:
    return shingle_hashes(WORDS.of(words_of(text)), width)


def fold(h: np.ndarray) -> bytes:
    """Counts of a set's shingles in ``FOLD`` groups, up to 255 each; what goes beyond is the size less their sum."""
    return np.minimum(np.bincount((h & np.uint64(FOLD - 1)).astype(np.int64), minlength=FOLD), 255).astype("u1").tobytes()


def _sketch(width: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, 1000):
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                h = shingles(text, width)
                n = len(h)
                first = (h[: int(prefix_size(n, percent))] >> np.uint64(32)).astype("<u4")
                out.append((doc_id, n, xxhash.xxh3_128_digest(h.tobytes()), first.tobytes(), fold(h)))
            yield pd.DataFrame(out, columns=["doc_id", "n", "set_hash", "first", "point"])
    return run


def _to_buckets(n_buckets: int):
    """Per block and range of groups: the groups that occur and in how many documents (counts saturate at 255)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        groups = np.concatenate([np.unique(np.frombuffer(b, "<u4")) for b in pdf["first"]])
        g, c = np.unique(groups, return_counts=True)
        bucket = (g.astype(np.uint64) * np.uint64(n_buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
        block = int(pdf["block"].iloc[0])
        rows = [(block, i, g[a:b].astype("<u4").tobytes(), np.minimum(c[a:b], 255).astype("u1").tobytes())
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        return pd.DataFrame(rows, columns=["block", "bucket", "groups", "counts"])
    return run


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """To every block: those of its groups that at least two documents have, with their frequency."""
    for pdf in groups_of(batches, ["bucket"]):
        gs = [np.frombuffer(b, "<u4") for b in pdf["groups"]]
        cs = [np.frombuffer(b, "u1") for b in pdf["counts"]]
        all_g = np.concatenate(gs)
        g, inverse = np.unique(all_g, return_inverse=True)
        df = np.bincount(inverse, weights=np.concatenate(cs)).astype(np.int64)
        rows, at = [], 0
        for block, mine in zip(pdf["block"], gs):
            f = df[inverse[at : at + len(mine)]]
            at += len(mine)
            ok = f > 1
            if ok.any():
                rows.append((block, mine[ok].tobytes(), np.minimum(f[ok], 2**32 - 1).astype("<u4").tobytes()))
        yield pd.DataFrame(rows, columns=["block", "groups", "df"])


def _perm(groups: np.ndarray, r: int) -> np.ndarray:
    return (groups.astype(np.uint64) * np.uint64(2654435761 + 2 * r * 40503) + np.uint64(r * 7919)) & np.uint64(0xFFFFFFFF)


def _survivors(percent: int, rounds: int):
    def run(docs: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        cols = ["doc_id", "n", "point", "branches", "common", "keys"]
        if not len(docs) or not len(shared):
            return pd.DataFrame(columns=cols)
        g = np.concatenate([np.frombuffer(b, "<u4") for b in shared["groups"]])
        df = np.concatenate([np.frombuffer(b, "<u4") for b in shared["df"]])
        order = np.argsort(g, kind="stable")
        g, df = g[order], df[order]
        out = []
        for doc_id, n, first, point in zip(docs["doc_id"], docs["n"], docs["first"], docs["point"]):
            mine = np.frombuffer(first, "<u4")
            at = np.minimum(np.searchsorted(g, mine), len(g) - 1)
            hit = g[at] == mine
            common, ask = int(hit.sum()), int(asked(n, percent))
            if common < ask:
                continue
            mine, f = mine[hit], df[at[hit]]
            rare = mine[np.lexsort((mine, f))][: common - ask + 1]
            keys = [int(_perm(mine, 2 * r).min()) << 31 ^ int(_perm(mine, 2 * r + 1).min()) for r in range(rounds)]
            out.append((doc_id, n, point, np.unique(rare).tolist(), common / len(np.frombuffer(first, "<u4")), keys))
        return pd.DataFrame(out, columns=cols)
    return run


def _boxed(n: np.ndarray, points: np.ndarray, over: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, partners) of a large branch sorted by set size: boxes first, then the points of the boxes that are left."""
    starts = np.arange(0, len(n), BOX)
    upper = np.maximum.reduceat(points, starts, axis=0)
    largest, most = np.maximum.reduceat(n, starts), np.maximum.reduceat(over, starts)
    smallest = np.minimum.reduceat(n, starts)
    for i in range(len(n)):
        # each pair is found from its smaller set (ties: the earlier one)
        boxes = (starts + BOX > i + 1) & (smallest * percent <= 100 * n[i])
        bound = np.minimum(upper, points[i]).sum(1) + np.minimum(most, over[i])
        least = (100 + percent) * bound >= percent * (n[i] + np.minimum(np.maximum(smallest, n[i]), largest))
        for b in np.flatnonzero(boxes & least).tolist():
            lo, hi = max(int(starts[b]), i + 1), min(int(starts[b]) + BOX, len(n))
            if lo < hi:
                both = np.minimum(points[lo:hi], points[i]).sum(1) + np.minimum(over[lo:hi], over[i])
                yield i, np.flatnonzero((100 + percent) * both >= percent * (n[lo:hi] + n[i])) + lo


def _leaf_pairs(percent: int):
    """Pairs of a branch's points whose summed minima allow a link.

    A pair comes from the first of the branches it shares alone.  Branches of up
    to a box are one leaf each; the leaves of a batch are looked at together.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, number in whole_keys(batches, ["branch", *TILE]):
            ids, n, comp = g["doc_id"].to_numpy(), g["n"].to_numpy(), g["comp"].to_numpy()
            side, crossed = g["side"].to_numpy(), g["crossed"].to_numpy()
            raw = np.stack([np.frombuffer(p, "u1") for p in g["point"]])
            over = n - raw.sum(1, dtype=np.int64)  # two sets share at most the lesser of these beyond the minima
            lower = g["lower"].to_numpy()
            here = lambda i, j: [k for k, (x, y) in enumerate(zip(i.tolist(), j.tolist()))
                                 if not len(np.intersect1d(lower[x], lower[y], assume_unique=True))]
            sizes = np.bincount(number)
            large = sizes[number] > BOX
            small = np.flatnonzero(~large)
            for i, j in pairs_within(number[small]):
                i, j = small[i], small[j]
                ok = (comp[i] != comp[j]) & (~crossed[i] | (side[i] != side[j]))
                ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                i, j = i[ok], j[ok]
                for a in range(0, len(i), 50_000):
                    x, y = i[a : a + 50_000], j[a : a + 50_000]
                    both = np.minimum(raw[x], raw[y]).sum(1, dtype=np.int64) + np.minimum(over[x], over[y])
                    ok = (100 + percent) * both >= percent * (n[x] + n[y])
                    x, y = x[ok], y[ok]
                    first = here(x, y)
                    yield pd.DataFrame({"a": ids[x[first]], "b": ids[y[first]]})
            for k in np.flatnonzero(sizes > BOX).tolist():
                at = np.arange(*np.searchsorted(number, [k, k + 1]))
                at = at[np.argsort(n[at], kind="stable")]
                a_out: list[int] = []
                b_out: list[int] = []
                for i, js in _boxed(n[at], raw[at].astype(np.int32), over[at], percent):
                    js = js[(comp[at[js]] != comp[at[i]]) & (not crossed[at[i]] or (side[at[js]] != side[at[i]]))]
                    js = js[here(np.full(len(js), at[i]), at[js])]
                    a_out += [int(ids[at[i]])] * len(js)
                    b_out += ids[at[js]].tolist()
                    if len(a_out) > 20_000:
                        yield pd.DataFrame({"a": a_out, "b": b_out}, dtype=np.int64)
                        a_out, b_out = [], []
                yield pd.DataFrame({"a": a_out, "b": b_out}, dtype=np.int64)
    return run


def _verify(width: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for pdf in batches:
            ok = []
            for x, y in zip(pdf["text_a"], pdf["text_b"]):
                if x != last[0]:
                    last = (x, shingles(x, width))
                s, t = last[1], shingles(y, width)
                same = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(100 * same >= percent * (len(s) + len(t) - same))
            yield pdf.loc[np.array(ok, bool), ["a", "b"]]
    return run


def _verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str, width: int, percent: int) -> DataFrame:
    both = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"))
    return scratch.save(both.mapInPandas(_verify(width, percent), "a long, b long"), name)


def links(docs: DataFrame, scratch: Scratch, width: int = WIDTH, percent: int = PERCENT, rounds: int = ROUNDS,
          block: int = BLOCK, tile_size: int = TILE_SIZE) -> tuple[DataFrame, DataFrame]:
    """(sketches, components): per row its set size, and the component of every document that links with another."""
    rows = docs.where("doc_id is not null").select("doc_id", "text")
    sketch = scratch.save(rows.mapInPandas(
        _sketch(width, percent), "doc_id long, n long, set_hash binary, first binary, point binary"), "sketches")
    # equal sets are one point: its smallest doc_id
    classes = scratch.save(sketch.where("n > 0").groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")), "classes")
    member = sketch.where("n > 0").select("doc_id", "set_hash").join(classes.where("rows > 1"), "set_hash")
    same = member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    reps = sketch.join(classes.select("set_hash", F.col("rep").alias("doc_id")), ["set_hash", "doc_id"])
    n_reps = classes.count()
    n_blocks = max(1, -(-n_reps // block))
    n_buckets = max(32, n_blocks)
    reps = reps.select(
        "doc_id", "n", "first", "point", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).alias("block"))
    ranges = reps.select("block", "first").groupBy("block").applyInPandas(
        _to_buckets(n_buckets), "block long, bucket int, groups binary, counts binary")
    shared = scratch.save(ranges.repartition("bucket").sortWithinPartitions("bucket")
                          .mapInPandas(_shared, "block long, groups binary, df binary"), "shared")
    found = (reps.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        _survivors(percent, rounds), "doc_id long, n long, point binary, branches array<long>, common double, keys array<long>"))
    found = scratch.save(found, "survivors")
    scratch.drop("shared")
    # texts of the survivors, by content: a doc_id may repeat with another text
    alive = found.select("doc_id").distinct()
    texts = scratch.save(rows.join(alive, "doc_id"), "texts")
    # every survivor against the most shared document of each of its keys: pairs in proportion to the survivors
    keyed = found.select("doc_id", "common", "n", F.posexplode("keys").alias("r", "key"))
    head = keyed.groupBy("r", "key").agg(F.max(F.struct("common", -F.col("doc_id"), "n")).alias("m"), F.count("*").alias("c")).where("c > 1")
    head = scratch.save(head.select("r", "key", (-F.col("m.col2")).alias("head"), F.col("m.n").alias("h_n")), "heads")
    pairs = (keyed.join(head, ["r", "key"]).where("doc_id <> head")
             .where(F.least("n", "h_n") * 100 >= F.greatest("n", "h_n") * percent)
             .select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct())
    stars = _verified(scratch.save(pairs, "star-pairs"), texts, scratch, "star-links", width, percent)
    comp = _components(scratch, stars, alive, "stars")
    entries = (found.join(comp, found["doc_id"] == comp["node"])
               .select("*", F.posexplode("branches").alias("place", "branch"))
               # with the branches before this one (32 bits each, in order), which a pair may have met in already
               .select("branch", F.transform(F.slice("branches", 1, F.col("place")), lambda x: (x - F.lit(2**31)).cast("int")).alias("lower"),
                       "doc_id", "n", "point", F.col("component").alias("comp")))
    tiles = tile(scratch, entries, "branch", "doc_id", "comp", tile_size, "branches")
    pairs = scratch.save(tiles.mapInPandas(_leaf_pairs(percent), "a long, b long").distinct(), "pairs")
    all_links = same.union(stars).union(_verified(pairs, texts, scratch, "links", width, percent))
    return sketch.select("doc_id", "n"), connected_components(scratch, all_links, "cc")


def _components(scratch: Scratch, edges: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """Component of each of ``nodes``; those without links are their own."""
    cc = connected_components(scratch, edges, label).withColumnRenamed("node", "n2")
    out = nodes.join(cc, nodes["doc_id"] == cc["n2"], "left")
    return scratch.save(out.select(F.col("doc_id").alias("node"), F.coalesce("component", "doc_id").alias("component")), f"{label}-all")


def jaccard_components(docs: DataFrame, scratch: Scratch, width: int = WIDTH, percent: int = PERCENT, **kw) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    sketch, comp = links(docs, scratch, width, percent, **kw)
    sketch = sketch.withColumnRenamed("n", "n_shingles")
    out = (sketch.join(comp, sketch["doc_id"] == comp["node"], "left")
           .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
    none = docs.where("doc_id is null").select("doc_id", F.lit(0).cast("long").alias("n_shingles"),
                                               F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(none)


def op9_count_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 4-word shingles at 85 of 100, as components."""
    return jaccard_components(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


QUERIES = {"op9_count_rtree": op9_count_rtree}
ORACLE: dict[str, str] = {}
