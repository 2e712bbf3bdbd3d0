"""One linear model per key from grouped sufficient statistics (M4).

A ridge regression needs only a key's row count, means and co-moments, and these
add up.  Rows are grouped by (key, block, chunk of time): each group becomes one
small co-moment matrix, so a key's rows are spread over its chunks and what
travels on does not grow with them.  Chunks of a key are then merged and
solved in one small group; all keys are solved in parallel and no fit loops over
them.

Blocks are those of expanding time folds: the training rows of a fold are the
blocks before its test block, so its matrices are sums over earlier blocks, and
one pass over the rows gives the models of every fold and the final one.
Matrices hold deviations from the chunk's own means and are merged with the
difference of means, which stays exact where sums of squares would cancel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import segments

WEEK_US = 7 * 24 * 3_600_000_000
#: Folds are numbered from 0; the model of all rows has this number.
FINAL = -1


@dataclass
class Moments:
    """Count, means and centered co-moments of rows (features, label last)."""

    n: int
    mean: np.ndarray
    comoment: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        centered = rows - mean
        return Moments(len(rows), mean, centered.T @ centered)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        shift = other.mean - self.mean
        return Moments(n, self.mean + shift * (other.n / n),
                       self.comoment + other.comoment + np.outer(shift, shift) * (self.n * other.n / n))


def solve(m: Moments, penalty: float) -> tuple[np.ndarray, float, np.ndarray]:
    """(coefficients, intercept, importances) of ridge on standardised features.

    Features that do not vary get zero; importances are the absolute
    standardised coefficients as shares of one (all zero for a constant label).
    """
    d = len(m.mean) - 1
    var = np.clip(np.diag(m.comoment) / m.n, 0.0, None)
    scale = np.sqrt(var)
    varies = scale > 1e-12 * np.maximum(1.0, np.abs(m.mean))
    coef, importance = np.zeros(d), np.zeros(d)
    at = np.flatnonzero(varies[:d])
    if varies[d] and len(at):
        corr = m.comoment[np.ix_(at, at)] / m.n / np.outer(scale[at], scale[at])
        toward = m.comoment[at, d] / m.n / scale[at] / scale[d]
        beta = np.linalg.solve(corr + penalty * np.eye(len(at)), toward)
        coef[at] = beta * scale[d] / scale[at]
        total = np.abs(beta).sum()
        importance[at] = np.abs(beta) / total if total > 0 else 0.0
    return coef, float(m.mean[d] - coef @ m.mean[:d]), importance


def time_blocks(times: DataFrame, keys: Sequence[str], ts: str, n_splits: int) -> DataFrame:
    """``times`` with ``block``: 0 for the rows no fold tests, f + 1 for the test rows of fold f (of W12's folds).

    A key with no more than ``n_splits`` times has no folds, all its rows are block 0.
    """
    size = F.floor(F.col("_n") / F.lit(n_splits + 1))
    first = F.col("_n") - F.lit(n_splits) * size
    block = F.when((size == 0) | (F.col("_i") < first), F.lit(0)).otherwise(F.floor((F.col("_i") - first) / size) + 1)
    return segments.numbered(times, keys, ts).withColumn("block", block.cast("int")).drop("_n", "_i")


def _stacked(pdf: pd.DataFrame) -> np.ndarray:
    return np.column_stack([np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy()])


def fit_per_key(rows: DataFrame, keys: Sequence[str], features: Sequence[str], ts: str = "time", penalty: float = 1e-3,
                chunk_us: int = WEEK_US) -> DataFrame:
    """(keys, fold, n_rows, label_mean, label_std, intercept, coef, importance) from rows (keys, time, block, features, label).

    One row for every key and fold that has rows to learn from, fold -1 being all
    rows.  Null features count as 0, rows without a label are left out.
    """
    keys, d = list(keys), len(features)
    x = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features])
    r = rows.where(F.col("label").isNotNull()).select(*keys, "block", F.floor(F.unix_micros(ts) / chunk_us).alias("chunk"),
                                                      x.alias("x"), F.col("label").cast("double").alias("y"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    of_key = ", ".join(f"`{k}` {types[k]}" for k in keys)

    def moments(pdf: pd.DataFrame) -> pd.DataFrame:
        m = Moments.of(_stacked(pdf))
        return pd.DataFrame({**{k: pdf[k].iloc[:1].to_numpy() for k in keys}, "block": pdf["block"].iloc[:1].to_numpy(), "n": [m.n],
                             "mean": [m.mean.tobytes()], "comoment": [m.comoment.tobytes()]})

    def models(pdf: pd.DataFrame) -> pd.DataFrame:
        per_block: dict[int, Moments] = {}
        for block, n, mean, comoment in zip(pdf["block"], pdf["n"], pdf["mean"], pdf["comoment"]):
            m = Moments(int(n), np.frombuffer(mean), np.frombuffer(comoment).reshape(d + 1, d + 1))
            per_block[block] = per_block[block] + m if block in per_block else m
        out, so_far = [], None
        for block in range(max(per_block) + 2):
            if so_far is not None and block >= 1:
                out.append((FINAL if block > max(per_block) else block - 1, so_far))
            if block in per_block:
                so_far = per_block[block] if so_far is None else so_far + per_block[block]
        made = []
        for fold, m in out:
            coef, intercept, importance = solve(m, penalty)
            made.append((*[pdf[k].iloc[0] for k in keys], fold, m.n, float(m.mean[d]), float(np.sqrt(max(m.comoment[d, d], 0.0) / m.n)),
                         intercept, coef.tolist(), importance.tolist()))
        return pd.DataFrame(made, columns=[*keys, "fold", "n_rows", "label_mean", "label_std", "intercept", "coef", "importance"])

    parts = r.groupBy(*keys, "block", "chunk").applyInPandas(moments, f"{of_key}, block int, n long, mean binary, comoment binary")
    return parts.groupBy(*keys).applyInPandas(
        models, f"{of_key}, fold int, n_rows long, label_mean double, label_std double, intercept double, coef array<double>, importance array<double>")


def linear(features: Sequence[str]) -> Column:
    """Intercept and products of a joined model row, in column functions; null features count as 0."""
    x = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features])
    return F.col("intercept") + F.aggregate(F.zip_with(x, "coef", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
