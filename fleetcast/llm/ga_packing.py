"""Operator 7: packing documents into fixed-length sequences by a grouping genetic algorithm on islands.

Every document becomes token ids with an end id.  Only longer ones are cut,
into full-length pieces behind a first piece that may be shorter; full pieces
fill a sequence each, so one piece a document is left to group.  These are
dealt by hash into blocks of bounded size.  A block is evolved on several
islands: a genome is a grouping of the block's pieces into bins; crossover
injects the best-filled bins of one parent into the other, drops the other's
bins that hold the same pieces, and best-fits the pieces this displaces.
Between epochs (written tables) each island's elite moves to the next island
of its block.  Then the bins that stayed under-filled are dealt into new
blocks, whole, and evolved again with the old grouping as a seed, so that
no step can need more sequences than the one before.

Edge cases: a null or empty text is the end id alone; repeated rows are packed
once each (an internal row key tells them apart); a null ``doc_id`` is kept; an
empty table gives no rows; extra columns are ignored.  A text that spells the
vocabulary's special token is encoded by the tokenizer file itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import Scratch, slices, table

CAPACITY = 1024
END_ID = 2
SPECIAL = "<|endoftext|>"
#: Pieces a block holds on average; islands of a block; epochs between which elites move.
BLOCK, ISLANDS, EPOCHS = 4096, 3, 2
#: Genomes of an island and generations of an epoch.
POPULATION, GENERATIONS = 4, 4
#: Bins with at least this share of free space are dealt out again in the second round.
SLACK = 1 / 64


# ---------------------------------------------------------------- pieces
class DocumentCoder:
    def __init__(self, vocabulary: str | None, rank_file: str | None):
        self.vocabulary = vocabulary
        self.encoding = bpe.coder(rank_file).encoding
        self.whole = None

    def encode(self, text: str) -> list[int]:
        if SPECIAL in text:
            if self.whole is None:
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.vocabulary or bpe.default_path("byte_bpe_50k.json"))
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text)  # the same ids as unit by unit, in half the time


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: the first may be shorter, the others are full."""
    first = n - capacity * ((n - 1) // capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(capacity: int, end_id: int, vocabulary: str | None, rank_file: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = DocumentCoder(vocabulary, rank_file)
        for pdf in slices(batches, 1000):
            out = []
            for key, doc_id, text in zip(pdf["rk"], pdf["doc_id"], pdf["text"]):
                ids = np.array(c.encode(text) + [end_id], "<u4")
                for i, (s, n) in enumerate(piece_bounds(len(ids), capacity)):
                    out.append((key, doc_id, i, s, n, zlib.crc32(ids[s : s + n].tobytes())))
            yield pd.DataFrame(out, columns=["rk", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None,
           rank_file: str | None = None) -> DataFrame:
    rows = docs.select(F.monotonically_increasing_id().alias("rk"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(_pieces(capacity, end_id, vocabulary, rank_file),
                            "rk long, doc_id long, piece int, start long, length long, ids_crc32 long")


# ---------------------------------------------------------------- genomes
def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, free: list[int], capacity: int) -> None:
    """Put the pieces of ``order`` where they leave the least space; opens bins as needed.

    ``by_room`` has the open bins by free space and ``rooms`` a bit for each
    free space that occurs, so the best fit is one bit operation away.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for b, f in enumerate(free):
        if f > 0:
            by_room[f].append(b)
            rooms |= 1 << f
    for i in order.tolist():
        n = int(lengths[i])
        above = rooms >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(free), capacity
            free.append(capacity)
        bins[i] = b
        left = room - n
        free[b] = left
        if left:
            by_room[left].append(b)
            rooms |= 1 << left


def tidy(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fills(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=lengths)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first; among equals, fuller full bins (mean squared fill) are better.  Smaller is better."""
    f = fills(bins, lengths) / capacity
    return len(f), -float((f * f).mean())


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``b`` go into ``a``."""
    fb = fills(b, lengths)
    share = rng.uniform(0.2, 0.6)
    good = np.flatnonzero(fb >= np.quantile(fb, 1 - share))
    good = good[rng.random(len(good)) < 0.7]
    injected = np.isin(b, good)
    broken = np.unique(a[injected])  # bins of a that hold a piece twice now
    loose = np.isin(a, broken) & ~injected
    # the worst bins of the child are opened as well, so that best fit has something to improve
    fa = fills(a, lengths)
    weak = np.flatnonzero(fa < np.quantile(fa, 0.05))
    loose |= np.isin(a, weak) & ~injected
    child = np.where(injected, b + len(fa), a)
    kept = ~loose
    child[kept] = tidy(child[kept])
    n = int(child[kept].max()) + 1 if kept.any() else 0
    free = (capacity - np.bincount(child[kept], weights=lengths[kept], minlength=n)).astype(int).tolist()
    moved = np.flatnonzero(loose)
    moved = moved[np.argsort(-lengths[moved] + rng.normal(0, 8, len(moved)), kind="stable")]
    best_fit(lengths, moved, child, free, capacity)
    return tidy(child)


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, rng: np.random.Generator) -> list[np.ndarray]:
    """One epoch on one island; the best genome comes first and never gets worse."""
    population = list(population)
    while len(population) < POPULATION:
        noise = rng.normal(0, 4.0 * len(population), len(lengths))
        genome = np.zeros(len(lengths), np.int32)
        best_fit(lengths, np.argsort(-lengths + noise, kind="stable"), genome, [], capacity)
        population.append(tidy(genome))
    key = lambda g: fitness(g, lengths, capacity)
    population.sort(key=key)
    floor = -(-int(lengths.sum()) // capacity)
    for _ in range(GENERATIONS):
        if key(population[0])[0] <= floor:
            break
        children = []
        for _ in range(POPULATION - 1):
            i, j = rng.permutation(len(population))[:2]
            children.append(crossover(population[i], population[j], lengths, capacity, rng))
        population = sorted(population + children, key=key)[:POPULATION]
    return population[:POPULATION]


def _epoch(capacity: int, epoch: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                lengths = np.asarray(r.lengths, np.int64)
                start = [np.frombuffer(g, np.int32) for g in (r.genomes if r.genomes is not None else [])]
                if r.migrant is not None:
                    start.append(np.frombuffer(r.migrant, np.int32))
                rng = np.random.default_rng([seed, r.block, r.island, epoch])
                pop = evolve(lengths, start, capacity, rng)
                n, worth = fitness(pop[0], lengths, capacity)
                out.append((r.block, r.island, r.lengths, [g.tobytes() for g in pop], n, worth))
            yield pd.DataFrame(out, columns=["block", "island", "lengths", "genomes", "n_bins", "worth"])
    return run


def _seed_genomes(seeds):
    return None if seeds is None or any(s < 0 for s in seeds) else [tidy(np.asarray(seeds, np.int64)).tobytes()]


def _place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A block's pieces with their bins in the winning genome."""
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            bins = np.frombuffer(r.genome, np.int32)
            order = np.argsort(bins, kind="stable")
            lengths = np.array([i["length"] for i in r.items], np.int64)[order]
            bins = bins[order]
            ends = np.cumsum(lengths)
            first = np.r_[True, bins[1:] != bins[:-1]]
            base = np.maximum.accumulate(np.where(first, ends - lengths, 0))
            total = np.bincount(bins, weights=lengths).astype(np.int64)
            yield pd.DataFrame({"rk": np.array([i["rk"] for i in r.items], np.int64)[order],
                                "piece": np.array([i["piece"] for i in r.items], np.int32)[order], "length": lengths,
                                "block": r.block, "bin": bins, "offset": ends - lengths - base, "fill": total[bins]})


def group(items: DataFrame, scratch: Scratch, label: str, capacity: int, islands: int = ISLANDS, epochs: int = EPOCHS,
          seed: int = 7) -> DataFrame:
    """(rk, piece, length, block, bin, offset, fill) for items (rk, piece, length, block, seed_bin); seed_bin -1: none."""
    item = F.struct("length", "rk", "piece", "seed_bin")
    blocks = scratch.save(items.groupBy("block").agg(F.sort_array(F.collect_list(item), asc=False).alias("items")), f"{label}-blocks")
    state = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                          F.col("items.length").alias("lengths"), F.col("items.seed_bin").alias("seeds"))
    to_genomes = F.udf(_seed_genomes, "array<binary>")
    state = (state.withColumn("genomes", to_genomes("seeds")).drop("seeds")
             .withColumn("migrant", F.lit(None).cast("binary")))
    # a given number of tasks: the rows are few but take long, so their size must not merge them
    tasks = max(1, -(-blocks.count() * islands // 2))
    for epoch in range(epochs):
        done = (state.repartition(tasks, "block", "island")
                .mapInPandas(_epoch(capacity, epoch, seed),
                             "block long, island int, lengths array<long>, genomes array<binary>, n_bins int, worth double"))
        done = scratch.save(done, f"{label}-epoch-{epoch}")
        elites = done.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("genomes")[0].alias("migrant"))
        state = done.drop("n_bins", "worth").join(elites, ["block", "island"])
    best = done.groupBy("block").agg(F.min_by(F.col("genomes")[0], F.struct("n_bins", "worth", "island")).alias("genome"))
    placed = blocks.join(best, "block").mapInPandas(
        _place, "rk long, piece int, length long, block long, bin int, offset long, fill long")
    return scratch.save(placed, f"{label}-placed")


def pack(docs: DataFrame, scratch: Scratch, capacity: int = CAPACITY, end_id: int = END_ID, block: int = BLOCK,
         vocabulary: str | None = None, rank_file: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document."""
    cut = scratch.save(pieces(docs, capacity, end_id, vocabulary, rank_file), "pieces")
    short = cut.where(F.col("length") < capacity).select("rk", "piece", "length")
    n = short.count()
    n_blocks = max(1, -(-n // block))
    one = group(short.withColumn("block", F.pmod(F.xxhash64("rk", "piece"), F.lit(n_blocks)))
                .withColumn("seed_bin", F.lit(-1).cast("long")), scratch, "one", capacity)
    slack = F.col("fill") <= capacity * (1 - SLACK)
    again = one.where(slack)
    m_blocks = max(1, -(-again.count() // block))
    two = group(again.select("rk", "piece", "length",
                             F.pmod(F.xxhash64("block", "bin"), F.lit(m_blocks)).alias("block"),
                             (F.col("block") * (1 << 20) + F.col("bin")).alias("seed_bin")), scratch, "two", capacity, seed=11)
    number = F.col("block") * (1 << 20) + F.col("bin")
    placed = (one.where(~slack).select("rk", "piece", (number * 2).alias("sequence_id"), "offset")
              .unionByName(two.select("rk", "piece", (number * 2 + 1).alias("sequence_id"), "offset")))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = (cut.where(F.col("length") == capacity)
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return cut.where(F.col("length") < capacity).join(placed, ["rk", "piece"]).select(*columns).unionByName(full)


def op7_ga_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op7"))


QUERIES = {"op7_ga_packing": op7_ga_packing}
ORACLE: dict[str, str] = {}
