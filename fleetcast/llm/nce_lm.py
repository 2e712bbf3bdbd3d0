"""Operator 5: scoring documents with a log-bilinear neural model trained by noise-contrastive estimation.

The model predicts one of ``CLASSES`` classes (the most frequent words, the end
of a text, and one class for all other words) from the two classes before it:
``r = C1 R[w-1] + C2 R[w-2]``, ``log P(w) = r . Q[w] + b[w] - log Z``.  A word
of the class of others costs in addition its share of that class by training
counts, so that the scores are those of a normalised distribution over texts.

All training documents are counted, words and class triples alike, as grouped
Spark tables that grow with the corpus.  Training runs in rounds over the
triple table: every partition draws triples by their counts and takes
noise-contrastive steps in numpy from the same start; the parameters are then
averaged, weighted by the partitions' tokens.  ``log Z`` of every context comes
from batched matrix products, also as a Spark job.

The counts of the ``COMMON`` most frequent words travel to the tasks (a fixed
bound); those of all other words meet the documents in a join.

Edge cases: null and empty texts are the end alone; a null ``doc_id`` counts
as the text '' for the split; repeated rows are scored (and counted) each; with
no training rows every token has probability by the smoothing alone; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, slices, table, words_of

CLASSES, DIM = 1024, 16
START, OTHER, END = 0, 1, 2
COMMON = 65_536
ROUNDS, BATCH, NOISE, RATE = 2, 2048, 64, 0.1
#: Least steps of a partition in a round, for small corpora.
LEAST_STEPS = 300
#: Distinct words or triples a task holds before it hands them on.
HELD = 250_000


# ---------------------------------------------------------------- counts
def split(docs: DataFrame) -> DataFrame:
    """(doc_id, text, held_out) of every row."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select("doc_id", "text", (F.crc32(key.cast("binary")) % 5 == 1).alias("held_out"))


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()
    frame = lambda: pd.DataFrame({"token": list(seen.keys()), "c": list(seen.values())})
    for pdf in batches:
        for text in pdf["text"]:
            seen.update(words_of(text))
            if len(seen) > HELD:
                yield frame()
                seen.clear()
        seen[b""] += len(pdf)  # no word is empty: this is the end
    yield frame()


def most_frequent(counts: DataFrame, n: int) -> list:
    """The ``n`` words with the highest counts (ties: the smaller word), as driver rows.

    A histogram over eighths of powers of two (a few hundred rows) first says
    which counts can be among them, so that tasks do not each send ``n`` rows.
    """
    eighth = F.floor(F.log2(F.col("c").cast("double")) * 8)
    left, cut = n, 0
    for b, words in sorted(counts.groupBy(eighth.alias("b")).count().collect(), reverse=True):
        left, cut = left - words, b
        if left <= 0:
            break
    return counts.where(eighth >= cut).orderBy(F.desc("c"), "token").limit(n).collect()


class Ids(dict):
    """Word -> number; 0 for a word that is not listed."""

    def __missing__(self, word):
        return 0


def _triples(common, classes: int):
    """(context, w, c): class triples of the training texts; context = class of w-2 * classes + class of w-1."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, cls, _ = common.value
        held: list[np.ndarray] = []
        size = 0

        def flush():
            code, c = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"context": code // classes, "w": (code % classes).astype(np.int32), "c": c})
        for pdf in batches:
            for text in pdf["text"]:
                ws = words_of(text)
                w = np.empty(len(ws) + 3, np.int64)
                w[:2], w[-1] = START, END
                w[2:-1] = cls[np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws))]
                held.append((w[:-2] * classes + w[1:-1]) * classes + w[2:])
                size += len(w) - 2
                if size > 8 * HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


# ---------------------------------------------------------------- model
class Model:
    def __init__(self, unigram: np.ndarray, dim: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        k = len(unigram)
        self.p = {"R": rng.normal(0, 0.1, (k, dim)), "Q": rng.normal(0, 0.1, (k, dim)), "C1": np.eye(dim), "C2": np.eye(dim) * 0.5,
                  "b": np.log(unigram)[:, None]}

    def rows(self) -> tuple[list[str], list[np.ndarray]]:
        return list(self.p), list(self.p.values())


def steps(p: dict[str, np.ndarray], context: np.ndarray, w: np.ndarray, c: np.ndarray, noise: np.ndarray, classes: int,
          rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One partition's noise-contrastive steps: at least as many draws as it has distinct triples, by their counts."""
    p = {k: v.copy() for k, v in p.items()}
    grown = {k: np.full_like(v, 1e-3) for k, v in p.items()}
    upto = np.cumsum(c / c.sum())
    noise_upto = np.cumsum(noise)
    expected = np.log(NOISE) + np.log(noise)
    sigmoid = lambda x: 0.5 * (1 + np.tanh(0.5 * x))
    for _ in range(max(LEAST_STEPS, -(-len(w) // BATCH))):
        i = np.minimum(np.searchsorted(upto, rng.random(BATCH)), len(w) - 1)
        t, c2, c1 = w[i], context[i] // classes, context[i] % classes
        n = np.minimum(np.searchsorted(noise_upto, rng.random(NOISE)), classes - 1)
        R, Q, C1, C2, b = p["R"], p["Q"], p["C1"], p["C2"], p["b"][:, 0]
        r1, r2 = R[c1], R[c2]
        r = r1 @ C1.T + r2 @ C2.T
        d_t = sigmoid((r * Q[t]).sum(1) + b[t] - expected[t]) - 1
        d_n = sigmoid(r @ Q[n].T + b[n] - expected[n])
        d_r = d_t[:, None] * Q[t] + d_n @ Q[n]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        np.add.at(g["Q"], t, d_t[:, None] * r)
        np.add.at(g["Q"], n, d_n.T @ r)
        np.add.at(g["b"], (t, 0), d_t)
        np.add.at(g["b"], (n, 0), d_n.sum(0))
        np.add.at(g["R"], c1, d_r @ C1)
        np.add.at(g["R"], c2, d_r @ C2)
        g["C1"], g["C2"] = d_r.T @ r1, d_r.T @ r2
        for k, v in p.items():
            step = g[k] / BATCH
            grown[k] += step * step
            v -= RATE * step / np.sqrt(grown[k])
    return p


def _round(params, noise: np.ndarray, classes: int, seed: int):
    """Rows of the parameters a partition ends with, weighted by its tokens."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdfs = list(batches)  # one input split of the triple table
        if not pdfs:
            return
        pdf = pd.concat(pdfs)
        c = pdf["c"].to_numpy(np.float64)
        rng = np.random.default_rng([seed, len(pdf), int(pdf["context"].iloc[0]), int(pdf["w"].iloc[0])])
        p = steps(params.value, pdf["context"].to_numpy(), pdf["w"].to_numpy(np.int64), c, noise, classes, rng)
        for name, v in p.items():
            yield pd.DataFrame({"name": name, "row": np.arange(len(v)), "weight": c.sum(), "v": [x.tolist() for x in v]})
    return run


def train(spark: SparkSession, triples: DataFrame, unigram: np.ndarray, dim: int = DIM, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameters after rounds of local steps and averaging; only the averages reach the driver (classes x dim)."""
    params = Model(unigram, dim).p
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(params)
        parts = triples.mapInPandas(_round(sent, unigram, len(unigram), r), "name string, row int, weight double, v array<double>")
        mean = F.array(*[F.sum(F.col("weight") * F.get("v", F.lit(i))) / F.sum("weight") for i in range(dim)])
        got = parts.groupBy("name", "row").agg(mean.alias("v")).collect()
        if not got:
            break
        params = {k: v.copy() for k, v in params.items()}
        for name, row, v in got:
            params[name][row] = np.array(v[: params[name].shape[1]], np.float64)
    return params


def _log_z(params) -> object:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = params.value
        a1, a2 = p["R"] @ p["C1"].T, p["R"] @ p["C2"].T
        for pdf in batches:
            out = []
            for c2 in pdf["c2"].tolist():
                s = (a1 + a2[c2]) @ p["Q"][1:].T + p["b"][1:, 0]  # every context (c2, .) at once; the start is never predicted
                m = s.max(1)
                out.append((m + np.log(np.exp(s - m[:, None]).sum(1))).tolist())
            yield pd.DataFrame({"c2": pdf["c2"], "z": out})
    return run


def log_z(spark: SparkSession, params: dict[str, np.ndarray]) -> np.ndarray:
    """(classes, classes): log normaliser of context (w-2, w-1)."""
    k = len(params["R"])
    sent = spark.sparkContext.broadcast(params)
    rows = spark.range(0, k, 1, 16).select(F.col("id").cast("int").alias("c2")).mapInPandas(_log_z(sent), "c2 int, z array<double>").collect()
    return np.array([r.z for r in sorted(rows, key=lambda r: r.c2)], np.float64)


# ---------------------------------------------------------------- scores
def _score(common, model, classes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, cls, logs = common.value
        p, z = model.value
        a1, a2, q, b = p["R"] @ p["C1"].T, p["R"] @ p["C2"].T, p["Q"], p["b"][:, 0]
        for pdf in slices(batches, 1000):
            out = []
            for key, doc_id, held, text in zip(pdf["rk"], pdf["doc_id"], pdf["held_out"], pdf["text"]):
                ws = words_of(text)
                i = np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws))
                w = np.empty(len(ws) + 3, np.int64)
                w[:2], w[-1] = START, END
                w[2:-1] = cls[i]
                total = 0.0
                for s in range(0, len(w) - 2, 65_536):  # long texts in blocks
                    c2, c1, t = w[s : s + 65_536][: len(w) - 2 - s], w[s + 1 : s + 65_537][: len(w) - 2 - s], w[s + 2 : s + 65_538]
                    c2, c1 = c2[: len(t)], c1[: len(t)]
                    r = a1[c1] + a2[c2]
                    total += float((np.einsum("ij,ij->i", r, q[t]) + b[t] - z[c2, c1]).sum())
                rare = Counter(ws[j] for j in np.flatnonzero(i == 0).tolist())
                listed = i[i > 0]
                others = listed[cls[listed] == OTHER]
                out.append((key, doc_id, held, len(ws) + 1, len(listed), float(logs[listed].sum()), float(logs[others].sum()),
                            len(ws) - len(listed) + len(others), total / np.log(10), list(rare.keys()), list(rare.values())))
            yield pd.DataFrame(out, columns=["rk", "doc_id", "held_out", "n_tokens", "listed", "log_listed", "log_others", "n_others",
                                             "log_classes", "rare", "times"])
    return run


def score(docs: DataFrame, scratch: Scratch, classes: int = CLASSES, common_words: int = COMMON, dim: int = DIM,
          rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    spark = docs.sparkSession
    rows = split(docs)
    training = rows.where(~F.col("held_out")).select("text")
    counts = training.mapInPandas(_count_words, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")).where("c > 0")
    counts = scratch.save(counts, "counts")
    n, v, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"),
                            F.coalesce(F.sum(F.when(F.length("token") == 0, F.col("c"))), F.lit(0))).first()
    top = most_frequent(counts.where("length(token) > 0"), common_words)
    in_class = sum(r.c for r in top[: classes - 3])
    # number 0 stands for unlisted words; classes of the first ones are their own
    cls = np.full(len(top) + 1, OTHER, np.int64)
    cls[1 : classes - 2] = np.arange(3, 3 + len(cls[1 : classes - 2]))
    logs = np.r_[0.0, np.log10(np.array([r.c for r in top], np.float64) + 0.5)]
    common = spark.sparkContext.broadcast((Ids({bytes(r.token): i + 1 for i, r in enumerate(top)}), cls, logs))
    others_c, others_v = n - ends - in_class, v - (ends > 0) - min(len(top), classes - 3)
    unigram = np.full(classes, 0.5)
    unigram[OTHER], unigram[END] = others_c + 0.5, ends + 0.5
    unigram[3 : 3 + min(len(top), classes - 3)] = [r.c + 0.5 for r in top[: classes - 3]]
    unigram /= unigram.sum()
    triples = (training.mapInPandas(_triples(common, classes), "context long, w int, c long")
               .groupBy("context", "w").agg(F.sum("c").alias("c")))
    triples = scratch.save(triples, "triples")
    params = train(spark, triples, unigram, dim, rounds)
    model = spark.sparkContext.broadcast((params, log_z(spark, params)))
    scored = rows.select("*", F.monotonically_increasing_id().alias("rk")).mapInPandas(
        _score(common, model, classes),
        "rk long, doc_id long, held_out boolean, n_tokens long, listed long, log_listed double, log_others double, n_others long, "
        "log_classes double, rare array<binary>, times array<long>")
    scored = scratch.save(scored, "scored")
    rare = (scored.select("rk", F.explode(F.arrays_zip("rare", "times")).alias("x"))
            .select("rk", F.col("x.rare").alias("token"), F.col("x.times").alias("times")))
    c = F.coalesce(F.col("c"), F.lit(0))
    rare = (rare.join(counts, "token", "left").groupBy("rk")
            .agg(F.sum(F.col("times") * F.log10(c + 0.5)).alias("log_rare"),
                 F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known_rare")))
    log_end, log_all = float(np.log10(ends + 0.5)), float(np.log10(n + 0.5 * (v + 1)))
    # the class of others: its words' counts, half a count each, and half a count for all unseen words
    log_other = float(np.log10(others_c + 0.5 * others_v + 0.5))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return (scored.drop("rare", "times").join(rare, "rk", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("listed") + zero("known_rare") + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("log_listed") + zero("log_rare") + log_end - F.col("n_tokens") * log_all).alias("base_score"),
                    (F.col("log_classes") + F.col("log_others") + zero("log_rare") - F.col("n_others") * log_other).alias("score")))


def op5_nce_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, by smoothed counts and by the model."""
    return score(table(spark, sf_dir, "documents"), Scratch(spark, "op5"))


QUERIES = {"op5_nce_lm": op5_nce_lm}
ORACLE: dict[str, str] = {}
