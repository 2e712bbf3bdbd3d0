"""Operator 2: quality classifier by co-training of a text view and a page-metadata view.

The text view sees what a document says: style ratios and the presence of
telling words.  The metadata view sees where it comes from: source, language
and declared length.  Both are logistic models fitted in numpy on a bounded
labelled sample.  In each round both views score every unlabelled document;
where a view's calibrated probability is nearest to 0 or 1, it hands
pseudo-labels to the other.  A part of the labelled sample is kept from all training; on it the
views are calibrated, and the least score a kept document may have is set so
that ``KEEP_SHARE`` of its good documents pass, with a margin where the other
documents leave room for one.  The calibrated views combine as
independent evidence (log-odds add, the prior counts once), and all documents
are scored in one pass over their whole texts.

A document is good when its label says quality 1 and not toxic.  Toxic documents
look like good ones but for some words, so a third model learns them as a class
of their own, from words without punctuation that say much about toxicity.  Its
limit comes from both sides of the held rows: half way between what
``TOXIC_SHARE`` of the toxic ones reach and what ``MILD_SHARE`` of the good ones
stay under, and the latter where the two overlap.  A kept document passes both.

Bounds (of the fit alone): ``LABELLED`` labelled rows, those with the smallest
hashes of ``doc_id``; ``WORDS`` telling words; of the documents a view is sure
of, all without a label being scored, the ``PSEUDO`` surest of either label go
to the other view in a round (documents alike in all features count once).

Edge cases: a null or empty text has zero ratios and no words, a very long one
is read whole; null metadata is a value of its own; of labelled rows that repeat
a ``doc_id`` the one with the least features is learnt from, and each row is
scored for itself; rows without ``doc_id`` are scored and not learnt from; labels without a document, or with a null in them, are
passed over, and contradicting labels of a document count as not good; without
toxic ones among the labels the third model lets all pass; without
labels of both kinds every score is the share of good labels (1 without any)
and all documents are kept; an empty table gives no rows; input columns with
clashing names are kept apart.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, table

LABELLED, PSEUDO, WORDS = 8000, 1000, 2000
ROUNDS, SURE, KEEP_SHARE = 3, 0.98, 0.995
#: Share of the labelled sample kept for calibration (one in so many, by hash).
HELD_ONE_IN = 4
#: Share of the held toxic documents to reject, of the held good ones to let pass; chi-squared of a word that counts; weight of the penalty.
TOXIC_SHARE, MILD_SHARE, TOXIC_WORTH, TOXIC_L2, TOXIC_STEPS = 0.98, 0.99, 15.0, 3e-4, 400
SPACE = 1 << 20
_UPPER, _DIGIT = string.ascii_uppercase.encode(), string.digits.encode()
_PUNCTUATION = string.punctuation.encode()
_STOPS, _MARKS = b".,;:?'\"()-", bytes(set(string.punctuation.encode()) - set(b".,;:?'\"()-"))


# ---------------------------------------------------------------- views
def style(raw: bytes, words: list[bytes], distinct: int) -> list[float]:
    n, k = max(1, len(raw)), max(1, len(words))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    lines = raw.split(b"\n")
    return [np.log1p(len(words)), len(raw) / k, share(_UPPER), share(_DIGIT), share(_STOPS), share(_MARKS), share(b"|"), share(b"!"),
            len(lines) / k, distinct / k, len(set(lines)) / len(lines), len(raw.translate(None, bytes(range(128)))) / n]


N_STYLE, N_META = 12, 3


def word_ids(words: set[bytes]) -> np.ndarray:
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w) & (SPACE - 1) for w in words), np.int64, len(words)))


def bare_ids(raw: bytes) -> np.ndarray:
    """Of the words without punctuation."""
    return word_ids(set(raw.lower().translate(None, _PUNCTUATION).split()))


def meta_ids(lang, source, n_chars) -> list[int]:
    size = "none" if n_chars is None or n_chars != n_chars else str(int(np.log2(max(1.0, float(n_chars))) * 2))
    return [xxhash.xxh3_64_intdigest(f"{k}={v}") & (SPACE - 1) for k, v in (("lang", lang), ("source", source), ("size", size))]


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            raw = (r.text or "").encode("utf-8", "surrogatepass")
            words = raw.lower().split()
            distinct = set(words)
            out.append((r.doc_id, r.good, r.toxic, style(raw, words, len(distinct)), word_ids(distinct).astype("<u4").tobytes(),
                        bare_ids(raw).astype("<u4").tobytes(), meta_ids(r.lang, r.source, r.n_chars)))
        yield pd.DataFrame(out, columns=["doc_id", "good", "toxic", "style", "words", "bare", "meta"])


# ---------------------------------------------------------------- models
@dataclass
class Sparse:
    """Rows of column numbers (all values 1) beside dense columns."""
    index: np.ndarray
    start: np.ndarray
    dense: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray], dense: np.ndarray) -> Sparse:
        sizes = np.array([len(r) for r in rows], np.int64)
        return cls(np.concatenate(rows) if rows else np.empty(0, np.int64), np.r_[0, np.cumsum(sizes)], dense)

    def take(self, rows: np.ndarray) -> Sparse:
        return Sparse.of([self.index[self.start[i] : self.start[i + 1]] for i in rows.tolist()], self.dense[rows])

    def dot(self, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        upto = np.r_[0.0, np.cumsum(w[self.index])]
        return upto[self.start[1:]] - upto[self.start[:-1]] + self.dense @ v

    def and_then(self, more: Sparse) -> Sparse:
        return Sparse(np.r_[self.index, more.index], np.r_[self.start, self.start[-1] + more.start[1:]], np.r_[self.dense, more.dense])

    def back(self, e: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(self.index, np.repeat(e, np.diff(self.start)), width), self.dense.T @ e


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def logit(p):
    return np.log(p) - np.log1p(-p)


@dataclass
class Logistic:
    """L2 logistic regression, full batches with adaptive steps; class weights even out rare classes."""
    width: int
    n_dense: int
    l2: float = 3e-3
    iterations: int = 150
    w: np.ndarray = field(default=None)
    v: np.ndarray = field(default=None)
    b: float = 0.0

    def fit(self, x: Sparse, y: np.ndarray) -> Logistic:
        theta = np.zeros(self.width + self.n_dense + 1)
        m, s = np.zeros_like(theta), np.zeros_like(theta)
        weight = np.where(y > 0.5, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean())) / len(y)
        for t in range(1, self.iterations + 1):
            w, v, b = theta[: self.width], theta[self.width : -1], theta[-1]
            e = (sigmoid(x.dot(w, v) + b) - y) * weight
            gw, gv = x.back(e, self.width)
            g = np.r_[gw + self.l2 * w, gv + self.l2 * v, e.sum()]
            m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
            theta = theta - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        self.w, self.v, self.b = theta[: self.width], theta[self.width : -1], float(theta[-1])
        return self

    def margin(self, x: Sparse) -> np.ndarray:
        return x.dot(self.w, self.v) + self.b


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) that make sigmoid(slope * margin + offset) a probability; targets are smoothed."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 0.0, float(logit((good + 1) / (len(y) + 2)))
    for _ in range(100):
        p = sigmoid(a * margin + b)
        e, h = p - target, p * (1 - p) + 1e-9
        g = np.array([(e * margin).sum() + 1e-3 * a, e.sum()])
        H = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum()]])
        step = np.linalg.solve(H + 1e-9 * np.eye(2), g)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.0)), float(b)


@dataclass
class Fitted:
    """What scoring needs; small."""
    prior: float = 1.0
    least: float = 0.0
    words: dict[int, int] = field(default_factory=dict)
    metas: dict[int, int] = field(default_factory=dict)
    mean: np.ndarray = field(default=None)
    scale: np.ndarray = field(default=None)
    text: Logistic | None = None
    meta: Logistic | None = None
    text_fit: tuple[float, float] = (0.0, 0.0)
    meta_fit: tuple[float, float] = (0.0, 0.0)
    n_pseudo: int = 0
    bare: dict[int, int] = field(default_factory=dict)
    toxic: Logistic | None = None
    toxic_fit: tuple[float, float] = (0.0, 0.0)
    most: float = np.inf

    def dense(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -5, 5)

    def text_rows(self, ids: list[np.ndarray], styles: np.ndarray) -> Sparse:
        return Sparse.of([np.array([self.words[i] for i in r.tolist() if i in self.words], np.int64) for r in ids], self.dense(styles))

    def toxic_margin(self, ids: list[np.ndarray], styles: np.ndarray) -> np.ndarray:
        """How toxic texts are; at most ``most`` for a kept one."""
        if self.toxic is None:
            return np.full(len(ids), -np.inf)
        return self.toxic.margin(Sparse.of([np.array([self.bare[i] for i in r.tolist() if i in self.bare], np.int64) for r in ids], self.dense(styles)))

    def meta_rows(self, ids: list[list[int]]) -> Sparse:
        return Sparse.of([np.array([self.metas[i] for i in r if i in self.metas], np.int64) for r in ids], np.empty((len(ids), 0)))

    def views(self, xt: Sparse, xm: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lt = self.text_fit[0] * self.text.margin(xt) + self.text_fit[1]
        lm = self.meta_fit[0] * self.meta.margin(xm) + self.meta_fit[1]
        return sigmoid(lt), sigmoid(lm), sigmoid(lt + lm - logit(self.prior))


def telling(rows: list[np.ndarray], y: np.ndarray, most: int, least: float = 0.0) -> dict[int, int]:
    """The words whose presence says most about the label (chi-squared; in at least five documents)."""
    all_ids = np.concatenate(rows)
    ids, inverse = np.unique(all_ids, return_inverse=True)
    n1 = np.bincount(inverse, np.repeat(y, [len(r) for r in rows]))
    n = np.bincount(inverse).astype(float)
    expected = n * y.mean()
    worth = np.where(n >= 5, (n1 - expected) ** 2 / np.maximum(expected * (1 - y.mean()), 1e-9), 0)
    best = np.argsort(-worth, kind="stable")[:most]
    return {int(ids[i]): k for k, i in enumerate(best) if worth[i] > least}


def packed(words: set[bytes], styles: list[float], meta: list[int], known: dict[int, int]) -> bytes:
    """What both views see of a document: ratios, metadata and telling words."""
    told = sorted(known[i] for i in word_ids(words).tolist() if i in known)
    return np.array(styles, "<f4").tobytes() + np.array(meta, "<u4").tobytes() + np.array(told, "<u4").tobytes()


def unpacked(rows: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, list[list[int]]]:
    """(telling words, ratios, metadata) of each row."""
    styles = np.array([np.frombuffer(b, "<f4", N_STYLE) for b in rows], np.float64).reshape(-1, N_STYLE)
    rest = [np.frombuffer(b, "<u4", offset=4 * N_STYLE).astype(np.int64) for b in rows]
    return [r[N_META:] for r in rest], styles, [r[:N_META].tolist() for r in rest]


def surest(f: Fitted, rows: list[bytes], sure: float) -> pd.DataFrame:
    """(to, good, surety, row) of the rows a view is sure of; ``to`` is the view that gets the label."""
    words, styles, metas = unpacked(rows)
    pt, pm, _ = f.views(Sparse.of(words, f.dense(styles)), f.meta_rows(metas))
    parts = []
    for to, p in (("meta", pt), ("text", pm)):
        at = np.flatnonzero((p >= sure) | (p <= 1 - sure))
        parts.append(pd.DataFrame({"to": to, "good": p[at] >= 0.5, "surety": np.abs(p[at] - 0.5), "row": [rows[i] for i in at.tolist()]}))
    return pd.concat(parts, ignore_index=True)


def cotrain(sample: pd.DataFrame, unlabelled: Callable[[Fitted], Callable] | None = None, words: int = WORDS, rounds: int = ROUNDS,
            sure: float = SURE, keep_share: float = KEEP_SHARE) -> Fitted:
    """Fit both views on labelled rows (doc_id, good, toxic, style, words, bare words, meta).

    ``unlabelled``, given the telling words, returns the function that a round
    calls with the fitted views, the limit and the rows each view has been
    told; it returns the new pseudo-labels as (to, good, row).
    """
    sample = sample.sort_values("doc_id", kind="stable").reset_index(drop=True)
    good = sample["good"].to_numpy(np.float64)
    if not len(good):
        return Fitted()
    if good.min() == good.max():
        return Fitted(prior=float(good.mean()))
    ids = [np.frombuffer(b, "<u4").astype(np.int64) for b in sample["words"]]
    styles = np.array(sample["style"].tolist(), np.float64)
    held = np.array([xxhash.xxh3_64_intdigest(str(d)) % HELD_ONE_IN == 0 for d in sample["doc_id"]])
    learn = ~held
    if min(held.sum(), learn.sum()) < 20 or len(set(good[held])) < 2 or len(set(good[learn])) < 2:
        held = learn = np.ones(len(good), bool)  # too few labels to keep some apart
    metas = [list(m) for m in sample["meta"]]
    f = Fitted(prior=float(good[learn].mean()), words=telling([ids[i] for i in np.flatnonzero(learn)], good[learn], words),
               mean=styles[learn].mean(0), scale=styles[learn].std(0) + 1e-6)
    xt, taught, at = f.text_rows(ids, styles), np.flatnonzero(learn), np.flatnonzero(held)
    ask = None if unlabelled is None else unlabelled(f)
    told: dict[str, dict[bytes, bool]] = {"text": {}, "meta": {}}  # pseudo-labels of each view
    for r in range(rounds + 1):
        more = {view: unpacked(list(rows)) for view, rows in told.items()}
        f.metas = {m: k for k, m in enumerate(sorted({m for row in [*metas, *more["meta"][2]] for m in row}))}
        xm = f.meta_rows(metas)
        for view, x, extra, width, dense in (("text", xt, Sparse.of(more["text"][0], f.dense(more["text"][1])), len(f.words), N_STYLE),
                                             ("meta", xm, f.meta_rows(more["meta"][2]), len(f.metas), 0)):
            y = np.r_[good[taught], np.fromiter(told[view].values(), np.float64, len(told[view]))]
            model = Logistic(width, dense).fit(x.take(taught).and_then(extra), y)
            setattr(f, view, model)
            setattr(f, f"{view}_fit", platt(model.margin(x.take(at)), good[at]))
        if r == rounds or ask is None:
            break
        new = ask(f, sure, told)
        for to, label, row in zip(new["to"], new["good"], new["row"]):
            told[to][bytes(row)] = bool(label)
        if not len(new):
            break
    f.n_pseudo = sum(map(len, told.values()))
    score = f.views(xt.take(at), xm.take(at))[2]
    # half way (in log-odds) between the least score that good documents need and what others reach, where these are apart
    passing, others = np.quantile(score[good[at] > 0.5], 1 - keep_share), np.quantile(score[good[at] <= 0.5], 0.95)
    between = sigmoid((logit(np.clip(passing, 1e-9, 1 - 1e-9)) + logit(np.clip(min(passing, others), 1e-9, 1 - 1e-9))) / 2)
    f.least = float(min(0.5, passing, between))
    _learn_toxic(f, sample, styles, good, learn, held, words)
    return f


def _learn_toxic(f: Fitted, sample: pd.DataFrame, styles: np.ndarray, good: np.ndarray, learn: np.ndarray, held: np.ndarray, words: int) -> None:
    toxic = sample["toxic"].to_numpy(np.float64)
    taught, at = np.flatnonzero(learn), np.flatnonzero(held)
    bad, mild = toxic[at] > 0.5, good[at] > 0.5
    if not bad.any() or not mild.any() or len(set(toxic[taught])) < 2:
        return
    ids = [np.frombuffer(b, "<u4").astype(np.int64) for b in sample["bare"]]
    f.bare = telling([ids[i] for i in taught], toxic[taught], words, TOXIC_WORTH)
    x = Sparse.of([np.array([f.bare[i] for i in ids[k].tolist() if i in f.bare], np.int64) for k in taught], f.dense(styles[taught]))
    f.toxic = Logistic(len(f.bare), N_STYLE, TOXIC_L2, TOXIC_STEPS).fit(x, toxic[taught])
    margin = f.toxic_margin([ids[i] for i in at], styles[at])
    f.toxic_fit = platt(margin, toxic[at])
    caught, passing = np.quantile(margin[bad], 1 - TOXIC_SHARE), np.quantile(margin[mild], MILD_SHARE)
    f.most = float(max(passing, (passing + caught) / 2))


# ---------------------------------------------------------------- Spark
def _packed(known: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                raw = (r.text or "").encode("utf-8", "surrogatepass")
                words = raw.lower().split()
                distinct = set(words)
                rows.append(packed(distinct, style(raw, words, len(distinct)), meta_ids(r.lang, r.source, r.n_chars), known))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "row": rows})
    return run


def _surest(f: Fitted, sure: float, told: dict[str, set[int]], most: int):
    """The ``most`` surest rows of a task for each view and label that the view has not been told."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in batches:
            found = surest(f, pdf["row"].tolist(), sure)
            found["at"] = [xxhash.xxh3_64_intdigest(b) - (1 << 63) for b in found["row"]]
            found = found[np.array([h not in told[to] for h, to in zip(found["at"], found["to"])], bool)]
            best = found if best is None else pd.concat([best, found], ignore_index=True)
            best = best.sort_values(["surety", "at"], ascending=[False, True], kind="stable").groupby(["to", "good"]).head(most)
        if best is not None:
            yield best[["to", "good", "surety", "at", "row"]]
    return run


def _unlabelled(docs: DataFrame, marks: DataFrame, scratch: Scratch, most: int) -> Callable[[Fitted], Callable]:
    """All documents without a label, as the views see them, written once; every round scores each of them."""
    def told_words(f: Fitted) -> Callable:
        rows = docs.where("doc_id is not null").select("doc_id", "text", "lang", "source", "n_chars").mapInPandas(
            _packed(f.words), "doc_id long, row binary")
        rows = scratch.save(rows.join(marks.select("doc_id"), "doc_id", "left_anti").select("row").distinct(), "unlabelled")

        def ask(f: Fitted, sure: float, told: dict[str, dict[bytes, bool]]) -> pd.DataFrame:
            seen = {to: {xxhash.xxh3_64_intdigest(b) - (1 << 63) for b in t} for to, t in told.items()}
            best = rows.mapInPandas(_surest(f, sure, seen, most), "to string, good boolean, surety double, at long, row binary")
            # the surest of every part of the rows, then of these: no task sorts all that a view is sure of
            order = [F.desc("surety"), F.asc("at")]
            for by in (["to", "good", F.pmod("at", F.lit(1024))], ["to", "good"]):
                best = best.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= most).drop("place")
            return best.orderBy("to", "good", "at").select("to", "good", "row").toPandas()
        return ask
    return told_words


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pseudo: int = PSEUDO) -> Fitted:
    marks = (labels.where("doc_id is not null and quality is not null and toxic is not null")
             .groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("double").alias("good"),
                                    F.max(F.col("toxic") != 0).cast("double").alias("toxic")))
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    # at most ``labelled`` rows: a proven bound for a broadcast
    wanted = ids.join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    features = ["good", "toxic", "style", "words", "bare", "meta"]
    rows = (docs.select("doc_id", "text", "lang", "source", "n_chars").join(F.broadcast(wanted), "doc_id")
            .mapInPandas(_features, "doc_id long, good double, toxic double, style array<double>, words binary, bare binary, meta array<long>"))
    # one row an id before anything reaches the driver
    sample = rows.groupBy("doc_id").agg(F.min(F.struct(*features)).alias("least")).select("doc_id", "least.*").toPandas()
    scratch = Scratch(docs.sparkSession, "cotraining")
    fitted = cotrain(sample, _unlabelled(docs, marks, scratch, pseudo))
    scratch.drop("unlabelled")
    return fitted


SCORES = T.StructType([T.StructField("text_score", T.DoubleType()), T.StructField("meta_score", T.DoubleType()),
                       T.StructField("score", T.DoubleType()), T.StructField("keep", T.BooleanType())])


def scorer(spark: SparkSession, fitted: Fitted):
    """Column function (text, lang, source, n_chars) -> text_score, meta_score, score, keep."""
    sent = spark.sparkContext.broadcast(fitted)

    def of(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        f: Fitted = sent.value
        n = len(text)
        if f.text is None:
            p = np.full(n, f.prior)
            return pd.DataFrame({"text_score": p, "meta_score": p, "score": p, "keep": np.ones(n, bool)})
        ids, bare, styles = [], [], np.zeros((n, N_STYLE))
        for i, t in enumerate(text):
            raw = (t or "").encode("utf-8", "surrogatepass")
            words = raw.lower().split()
            distinct = set(words)
            styles[i] = style(raw, words, len(distinct))
            ids.append(np.array([k for k in word_ids(distinct).tolist() if k in f.words], np.int64))  # the rest says nothing
            bare.append(np.array([k for k in bare_ids(raw).tolist() if k in f.bare] if f.bare else [], np.int64))
        metas = [meta_ids(*m) for m in zip(lang, source, n_chars)]
        pt, pm, p = f.views(f.text_rows(ids, styles), f.meta_rows(metas))
        margin = f.toxic_margin(bare, styles)
        if f.toxic is not None:
            good = p * sigmoid(-f.toxic_fit[0] * margin - f.toxic_fit[1])
        else:
            good = p
        return pd.DataFrame({"text_score": pt, "meta_score": pm, "score": good, "keep": (p >= f.least) & (margin <= f.most)})
    return F.pandas_udf(of, SCORES)


def scored(docs: DataFrame, labels: DataFrame, name: str = "quality") -> DataFrame:
    """``docs`` with one more struct column ``name``."""
    of = scorer(docs.sparkSession, fit(docs, labels))
    return docs.withColumn(name, of("text", "lang", "source", F.col("n_chars").cast("double")))


def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, with the decision to keep it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return scored(docs, table(spark, sf_dir, "labels")).select("doc_id", "quality.*")


QUERIES = {"op2_cotraining": op2_cotraining}
ORACLE: dict[str, str] = {}
