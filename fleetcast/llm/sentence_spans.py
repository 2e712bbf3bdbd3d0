"""Operator 4: substring dedup by sliding runs of sentences.

Sentences of over ``LONG_WORDS`` words are cut into pieces behind commas and
between some pairs of words, chosen by their hash, so that a passage inside a
long sentence is cut alike wherever it stands.  A run starts at every sentence
or piece and takes more until it has at least ``MIN_SENTENCES`` of them and
``MIN_WORDS`` words; another ends at every one and grows backwards.  So a passage
repeated elsewhere is cut into the same runs whatever surrounds it, from its
first whole piece to its last, and chance repeats of two-word sentences are no
evidence.  The runs of all texts are counted over the corpus in two passes: the
forward runs by 64 bits, then, with 128 bits, those whose hash repeats and the
backward runs that begin where one of them does (what repeats backwards from a
piece begins with a forward run that repeats).  The first occurrence of a run, by
``doc_id``, text hash and place, stays; sentences covered by any other
occurrence of a repeated run go.

Edge cases: a null text stays null and an empty one empty, with no sentences;
rows that repeat both ``doc_id`` and text are one document and get the same
result; a null ``doc_id`` comes first in the order; a text without full stops
is one sentence a line; one word over and over is not cut, having no place to
tell from another; ``n_sentences`` and ``n_removed`` count pieces; a text shorter than a run has no run and is kept; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, clear_of, mix64, slices, table

MIN_SENTENCES, MIN_WORDS = 2, 24
#: A sentence of more words is cut, behind commas and at one pair of words in so many.
LONG_WORDS, ONE_IN = 12, 4
#: Characters of the texts that are cut together.
SLICE = 2_000_000
_COMMAS = (",", ";", ":", "，", "；", "、")
_WORD = re.compile(r"\S+\s*")
_SENTENCE = re.compile(r"[^.!?\n。！？]*(?:[.!?\n。！？]+\s*|\Z)")
_U = np.uint64
#: Two odd multipliers and their inverses modulo 2^64; a run's hash is a polynomial in each.
_FACTORS = tuple((_U(r), _U(pow(r, -1, 1 << 64))) for r in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))


class _Hashes(WordHashes):
    """64 bits of a word (str); the lowest one says whether it ends in a comma."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ~1 | word.endswith(_COMMAS)
        return h


_HASHES = _Hashes()


def _lower(text: str) -> str:
    """Lower case that does not depend on what stands around a letter."""
    low = text.lower()
    return low if low.isascii() else low.replace("ς", "σ")


def _cuts(h: np.ndarray) -> np.ndarray:
    """Whether a long sentence is cut between a word and the next."""
    a, b = h[:-1], h[1:]
    return (a != b) & (((a + _U(3) * b) >> _U(9) & _U(ONE_IN - 1) == 0) | (a & _U(1) == 1))


def sentences(text: str) -> list[str]:
    """Pieces that join to the text; each ends behind its stops and white space, or inside a long sentence."""
    out = []
    for s in _SENTENCE.findall(text):
        if s:
            out += _pieces(s) if len(s) > 2 * LONG_WORDS else [s]
    return out


def _pieces(sentence: str) -> list[str]:
    words = _lower(sentence).split()
    if len(words) <= LONG_WORDS:
        return [sentence]
    at = np.flatnonzero(_cuts(_HASHES.of(words))).tolist()
    if not at:
        return [sentence]
    ends = [m.end() for m in _WORD.finditer(sentence)]
    cuts = [0, *[ends[i] for i in at], len(sentence)]
    return [sentence[a:b] for a, b in zip(cuts, cuts[1:])]


def _polynomials(h: np.ndarray, first: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of each stretch ``h[first:end]``, the same wherever it stands."""
    factor, inverse = _FACTORS[which]
    powers, back = (np.cumprod(np.r_[_U(1), np.full(len(h), f, _U)]) for f in (factor, inverse))
    upto = np.r_[_U(0), np.cumsum(h * powers[:-1])]
    return mix64((upto[end] - upto[first]) * back[first])


class Cut:
    """The pieces of some texts as arrays; those without words only count in ``place`` and ``n_pieces``.

    ``head``: where each text's pieces with words begin; ``place``: their number
    among all pieces of the text; ``end``, ``begin``: of the run that starts, or
    ends, at a piece (-1: there is none).
    """

    def __init__(self, texts: list[str], min_sentences: int, min_words: int):
        parts = [[s.split() for s in _SENTENCE.findall(_lower(t)) if s] for t in texts]
        flat = [s for p in parts for s in p]
        size = np.fromiter(map(len, flat), np.int64, len(flat))
        n_sentences = np.fromiter(map(len, parts), np.int64, len(parts))
        self.words = _HASHES.of([w for s in flat for w in s])
        n = len(self.words)
        sentence = np.repeat(np.arange(len(flat)), size)
        opens = np.ones(n, bool)
        if n > 1:
            opens[1:] = (sentence[1:] != sentence[:-1]) | (size[sentence[1:]] > LONG_WORDS) & _cuts(self.words)
        self.at = np.flatnonzero(opens)
        of = sentence[self.at]
        in_sentence = np.bincount(of, minlength=len(flat))
        counted = np.maximum(in_sentence, 1)
        edge = np.r_[0, np.cumsum(n_sentences)]
        before = np.r_[0, np.cumsum(counted)]
        self.n_pieces = before[edge[1:]] - before[edge[:-1]]
        text = np.repeat(np.arange(len(texts)), n_sentences)
        real = np.r_[0, np.cumsum(in_sentence)]
        self.place = before[of] - before[edge[:-1]][text[of]] + np.arange(len(of)) - real[of]
        self.head = real[edge]
        k, upto = np.arange(len(of)), np.r_[self.at, n]
        end = np.maximum(np.searchsorted(upto, upto[:-1] + min_words), k + min_sentences)
        self.end = np.where(end <= self.head[1:][text[of]], end, -1)
        begin = np.minimum(np.searchsorted(upto, upto[1:] - min_words, "right") - 1, k + 1 - min_sentences)
        self.begin = np.where(begin >= self.head[:-1][text[of]], begin, -1)

    def hashes(self, first: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Hash of each run from piece ``first`` to before piece ``end``."""
        pieces = _polynomials(self.words, self.at, np.r_[self.at, len(self.words)][1:], which)
        return _polynomials(pieces, first, end, which).astype(np.int64)


def _together(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in order, as many as have about ``SLICE`` characters."""
    number = pdf["text"].str.len().cumsum().to_numpy() // SLICE
    for a, b in zip(*(lambda e: (e[:-1], e[1:]))(np.r_[0, np.flatnonzero(np.diff(number)) + 1, len(pdf)])):
        yield pdf.iloc[a:b]


def _forward(min_sentences: int, min_words: int):
    """A row a text: its pieces and 64 bits of the run that starts at each of the first ones."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, 500):
            for part in _together(pdf):
                cut = Cut(part["text"].tolist(), min_sentences, min_words)
                first = np.flatnonzero(cut.end >= 0)
                h = cut.hashes(first, cut.end[first], 0)
                yield pd.DataFrame({"doc_id": part["doc_id"], "th": part["th"], "n": cut.n_pieces,
                                    "hs": np.split(h, np.searchsorted(first, cut.head[1:-1]))})
    return run


RUNS = "doc_id long, th long, starts array<int>, stops array<int>, lo array<long>, hi array<long>"


def _repeating(min_sentences: int, min_words: int):
    """A row a text: the runs that start where a forward run repeats, with 128 bits each."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, 500):
            for part in _together(pdf):
                cut = Cut(part["text"].tolist(), min_sentences, min_words)
                shared = np.zeros(len(cut.place) + 1, bool)  # the last one: no run begins
                for head, at in zip(cut.head.tolist(), part["at"]):
                    shared[head + np.asarray(at, np.int64)] = True
                first, back = np.flatnonzero(shared[:-1]), np.flatnonzero(shared[cut.begin])
                # a backward run may be a forward one as well
                both = np.unique(np.stack([np.r_[first, cut.begin[back]], np.r_[cut.end[first], back + 1]]), axis=1)
                first, end = both[0], both[1]
                edges = np.searchsorted(first, cut.head[1:-1])
                split = lambda x: np.split(x, edges)
                yield pd.DataFrame({"doc_id": part["doc_id"], "th": part["th"], "starts": split(cut.place[first].astype(np.int32)),
                                    "stops": split((cut.place[end - 1] + 1).astype(np.int32)), "lo": split(cut.hashes(first, end, 0)),
                                    "hi": split(cut.hashes(first, end, 1))})
    return run


RESULT = "text string, n_removed int"


def _rebuilt(text: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
    """Texts without the covered sentences; blank pieces inside a covering run go with it."""
    out = []
    for t, a, b in zip(text, starts, stops):
        if t is None:
            out.append((None, 0))
            continue
        parts = sentences(t)
        depth = np.zeros(len(parts) + 1, np.int64)
        np.add.at(depth, np.asarray(a, np.int64), 1)
        np.add.at(depth, np.asarray(b, np.int64), -1)
        stay = np.cumsum(depth)[:-1] == 0
        out.append(("".join(p for p, s in zip(parts, stay.tolist()) if s), int((~stay).sum())))
    return pd.DataFrame(out, columns=["text", "n_removed"])


def dedup(docs: DataFrame, scratch: Scratch, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
          name: str = "spans") -> DataFrame:
    """``docs`` with one more struct column ``name``: text, n_sentences, n_removed."""
    th, c_doc, c_th, c_n, starts, stops, cut = (clear_of(docs, x) for x in ("th", "c_doc", "c_th", "c_n", "starts", "stops", "cut"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).where("length(text) > 0")
    # 64 bits of the forward runs: which hashes repeat, and where
    forward = scratch.save(rows.mapInPandas(_forward(min_sentences, min_words), "doc_id long, th long, n int, hs array<long>"), "forward")
    twice = scratch.save(forward.select(F.explode("hs").alias("h")).groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "twice")
    at = (forward.select("th", F.posexplode("hs").alias("at", "h")).join(twice, "h", "left_semi")
          .groupBy("th").agg(F.collect_set("at").alias("at")))
    at = scratch.save(at, "at")
    # 128 bits of the runs there, forwards and backwards, and the first occurrence of each
    found = scratch.save(rows.join(at, "th").mapInPandas(_repeating(min_sentences, min_words), RUNS), "found")
    each = found.select("doc_id", "th", F.explode(F.arrays_zip("starts", "stops", "lo", "hi")).alias("r")).select("doc_id", "th", "r.*")
    here = F.struct("doc_id", "th", "starts")
    first = each.groupBy("lo", "hi").agg(F.count("*").alias("c"), F.min(here).alias("first")).where("c > 1")
    first = scratch.save(first.select("lo", "hi", "first"), "first")
    covered = (each.join(first, ["lo", "hi"]).where(~here.eqNullSafe(F.col("first")))
               .groupBy("doc_id", "th").agg(F.collect_set(F.struct("starts", "stops")).alias("runs")))
    none = F.lit(None).cast("array<struct<starts:int,stops:int>>")
    counted = (forward.select("doc_id", "th", "n", none.alias("runs")).unionByName(covered.select("doc_id", "th", F.lit(None).cast("int").alias("n"), "runs"))
               .groupBy("doc_id", "th").agg(F.max("n").alias("n"), F.first("runs", ignorenulls=True).alias("runs")))
    counted = scratch.save(counted.select(F.col("doc_id").alias(c_doc), F.col("th").alias(c_th), F.col("n").alias(c_n),
                                          F.col("runs.starts").alias(starts), F.col("runs.stops").alias(stops)), "covered")
    for old in ("forward", "twice", "at", "found", "first"):
        scratch.drop(old)
    joined = docs.withColumn(th, F.xxhash64("text")).join(counted, F.col("doc_id").eqNullSafe(F.col(c_doc)) & (F.col(th) == F.col(c_th)), "left")
    # only texts that lose something go through Python
    changed = F.col(starts).isNotNull()
    joined = joined.withColumn(cut, F.pandas_udf(_rebuilt, RESULT)(F.when(changed, F.col("text")), starts, stops))
    result = F.struct(F.when(changed, F.col(cut)["text"]).otherwise(F.col("text")).alias("text"),
                      F.coalesce(c_n, F.lit(0)).alias("n_sentences"), F.col(cut)["n_removed"].alias("n_removed"))
    return joined.withColumn(name, result).drop(th, c_doc, c_th, c_n, starts, stops, cut)


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of passages that an earlier place has."""
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op4")).select("doc_id", "spans.*")


QUERIES = {"op4_sentence_spans": op4_sentence_spans}
ORACLE: dict[str, str] = {}
