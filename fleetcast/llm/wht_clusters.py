"""Operator 13: centroid clustering with progressive search over Walsh-Hadamard coefficients.

Vectors become integers and are transformed once, exactly: the rows of the
Hadamard matrix are ordered by their number of sign changes, so the first
coefficients describe a vector coarsely.  The transform multiplies squared
distances by the number of components, so a running sum of squared coefficient
differences is a lower bound of the scaled distance, exact once all are in.

A search takes the centroid nearest in the first coefficients, its whole
distance is the bound; the other centroids accumulate differences coarse to
fine and leave when they are strictly worse.  Those that finish all
coefficients have exact distances, and ties go to the smaller number.

Every round is one pass over the transformed vectors, without a shuffle of
them: a task returns the sums of its vectors for each centroid, Spark adds
them, and the driver gets ``k * dims`` sums.  A vector that many rows share
is a row like any other, so no key can be hot.

Edge cases: vectors that are null, have another number of components, or hold a
null or non-finite one take no part; repeated rows count as often as they are
there; a null id is an id; with fewer than ``k`` vectors there are as many
centroids, with none no rows; extra columns are ignored.  Components that would
not fit 64-bit arithmetic are handled as Python integers, exactly; distances and
inertias beyond a long are returned as the largest long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, slices, table
from .vectors import finite

DIMS, K, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Components below this keep all sums of a search within 64 bits.
NARROW = 1 << 24
TOP = (1 << 63) - 1
SLICE = 8192
#: Coefficients whose sums travel in one row.
BLOCK = 16


def hadamard(n: int) -> np.ndarray:
    """The n x n Hadamard matrix (n a power of two), its rows ordered by sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")]


def nearest(z: np.ndarray, c: np.ndarray, work: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number, scaled squared distance) of the nearest row of ``c`` for every row of ``z``, both transformed.

    ``work`` gets the number of coefficient differences that were looked at.
    """
    n, k, dims = len(z), len(c), z.shape[1]
    first = min(4, dims)
    sums = ((z[:, None, :first] - c[None, :, :first]) ** 2).sum(axis=2)
    guess = sums.argmin(axis=1) if n else np.zeros(0, np.int64)
    bound = ((z - c[guess]) ** 2).sum(axis=1)
    row, number = np.divmod(np.arange(n * k), k)
    sums = sums.reshape(-1)
    looked, at = n * k * first + n * dims, first
    while True:
        stay = sums <= bound[row]
        row, number, sums = row[stay], number[stay], sums[stay]
        if at == dims:
            break
        to = min(2 * at, dims)
        sums = sums + ((z[row, at:to] - c[number, at:to]) ** 2).sum(axis=1)
        looked, at = looked + len(row) * (to - at), to
    if work is not None:
        work.append(looked)
    # rows are in order: the least sum of each, then the least number among those that reach it
    starts = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(sums, starts) if n else sums
    hit = sums == least[row]
    row, number = row[hit], number[hit]
    keep = np.r_[True, row[1:] != row[:-1]][: len(row)]
    return number[keep], least


@dataclass(frozen=True)
class Centroids:
    """Integer centroids, as Python integers, and their coefficients."""

    rows: tuple[tuple[int, ...], ...]

    def coefficients(self) -> tuple[np.ndarray, bool]:
        dims = len(self.rows[0])
        wide = any(abs(x) >= NARROW for r in self.rows for x in r)
        m = np.array(self.rows, dtype=object if wide else np.int64)
        return m @ hadamard(dims).T.astype(m.dtype), wide

    def moved(self, sums: dict[int, list[int]], counts: dict[int, int]) -> Centroids:
        """Floors of the means; ``sums`` are of coefficients, which the transform (its own inverse but for the scale) undoes."""
        dims = len(self.rows[0])
        back = hadamard(dims).T.astype(object)
        mean = lambda j: tuple(int(s) // dims // counts[j] for s in back @ np.array(sums[j], dtype=object))
        return Centroids(tuple(mean(j) if counts.get(j) else r for j, r in enumerate(self.rows)))


def transformed(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, coef, wide): coefficients as integers, or as text in ``wide`` for vectors with huge components."""
    ints = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    # a scaled component may leave the range of doubles: take it apart in Python then
    rows = rows.where(finite(F.col("embedding")) & (F.size("embedding") == dims))
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), F.array_max(F.transform(ints, F.abs)).alias("top"))

    def run(batches):
        h = hadamard(dims)
        for pdf in slices(batches, SLICE):
            if not len(pdf):
                continue
            wide = pdf["top"].to_numpy() >= NARROW - 1
            coef, text = np.full(len(pdf), None, object), np.full(len(pdf), None, object)
            if (~wide).any():
                q = np.floor(np.stack(pdf["x"].to_numpy()[~wide]) * scale).astype(np.int64)
                coef[~wide] = pd.Series(list((q @ h.T).astype(np.int32)), dtype=object).to_numpy()
            for i in np.flatnonzero(wide):
                coef[i], text[i] = None, [str(v) for v in h.astype(object) @ np.array([_floor(x, scale) for x in pdf["x"].iloc[i]], object)]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "coef": coef, "wide": text})

    return rows.mapInPandas(run, "vec_id long, coef array<int>, wide array<string>")


def _floor(x: float, scale: int) -> int:
    """floor(scale * x), of the double product where it is finite."""
    y = scale * x
    if np.isfinite(y):
        return int(np.floor(y))
    num, den = float(x).as_integer_ratio()
    return scale * num // den


def _matrix(pdf: pd.DataFrame, wide: bool) -> np.ndarray:
    if not wide and pdf["wide"].isna().all():
        return np.stack(pdf["coef"].to_numpy()).astype(np.int64)
    rows = [[int(v) for v in (c if w is None else w)] for c, w in zip(pdf["coef"], pdf["wide"])]
    return np.array(rows, dtype=object)


def _search(pdf: pd.DataFrame, c: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    z = _matrix(pdf, wide)
    return z, *nearest(z, c.astype(z.dtype))


def starts(kept: DataFrame, k: int, seed: int) -> DataFrame:
    """The k vectors with the smallest hash of their id (a limit that the start of the clustering is made of)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    return kept.withColumn("hash", F.sha2(name, 256)).orderBy("hash", "coef", "wide").limit(k)


def cluster(rows: DataFrame, scratch: Scratch, dims: int = DIMS, k: int = K, rounds: int = ROUNDS, scale: int = SCALE,
            seed: int = SEED) -> tuple[DataFrame, Centroids]:
    """((vec_id, cluster, distance as text), centroids) of ``rows`` (vec_id, embedding)."""
    kept = scratch.save(transformed(rows, dims, scale), "transformed")
    back = hadamard(dims).T.astype(object)
    first = [back @ np.array([int(v) for v in (r["wide"] or r["coef"])], object) for r in starts(kept, k, seed).collect()]
    centroids = Centroids(tuple(tuple(int(s) // dims for s in v) for v in first))
    if not first:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit("0").alias("distance")), centroids
    for _ in range(rounds):
        after = centroids.moved(*_sums(kept, centroids, dims))
        if after == centroids:  # every further round would repeat this one
            break
        centroids = after
    c, wide = centroids.coefficients()

    def run(batches):
        for pdf in slices(batches, SLICE):
            if len(pdf):
                _, number, far = _search(pdf, c, wide)
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "cluster": number.astype(np.int32), "distance": [str(int(d) // dims) for d in far]})

    return scratch.save(kept.mapInPandas(run, "vec_id long, cluster int, distance string"), "assigned"), centroids


def _sums(kept: DataFrame, centroids: Centroids, dims: int) -> tuple[dict[int, list[int]], dict[int, int]]:
    """Coefficient sums and numbers of vectors of each centroid; one job."""
    c, wide = centroids.coefficients()

    def run(batches):
        total, count = np.zeros((len(c), dims), object), np.zeros(len(c), np.int64)
        for pdf in slices(batches, SLICE):
            if len(pdf):
                z, number, _ = _search(pdf, c, wide)
                for j in np.unique(number):
                    mine = z[number == j]
                    total[j] += mine.sum(axis=0).astype(object)
                    count[j] += len(mine)
        at = [(j, b) for j in np.flatnonzero(count) for b in range(0, dims, BLOCK)]
        yield pd.DataFrame({"cluster": [j for j, _ in at], "block": [b for _, b in at],
                            "total": [[str(x) for x in total[j, b : b + BLOCK]] for j, b in at],
                            "n": [count[j] for j, _ in at]}).astype({"cluster": "int32", "block": "int32", "n": "int64"})

    def add(pdf):  # as many rows as there are tasks
        total = [str(sum(map(int, column))) for column in zip(*pdf["total"])]
        return pd.DataFrame({"cluster": pdf["cluster"].iloc[:1], "block": pdf["block"].iloc[:1], "total": [total], "n": [int(pdf["n"].sum())]})

    schema = "cluster int, block int, total array<string>, n long"
    parts = kept.mapInPandas(run, schema).groupBy("cluster", "block").applyInPandas(add, schema)
    sums, counts = {}, {}
    for r in parts.collect():  # k * dims sums
        sums.setdefault(r["cluster"], [0] * dims)[r["block"] : r["block"] + BLOCK] = map(int, r["total"])
        counts[r["cluster"]] = r["n"]
    return sums, counts


def op13_wht_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rounds of clustering of all embeddings around eight centroids."""
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"), Scratch(spark, "op13"))
    held = F.least(F.col("distance").cast("decimal(38,0)"), F.lit(TOP).cast("decimal(38,0)"))
    held = F.coalesce(F.when(F.length("distance") < 38, held), F.lit(TOP).cast("decimal(38,0)"))
    far = assigned.select("vec_id", "cluster", held.alias("distance"))
    per = {r["cluster"]: int(r["s"]) for r in far.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # at most k rows
    capped = lambda n: F.lit(min(n, TOP)).cast("long")
    shas = [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in centroids.rows] or [""]
    at = F.col("cluster") + 1
    return far.select("vec_id", "cluster", F.col("distance").cast("long").alias("distance"),
                      F.element_at(F.array(*[capped(per.get(j, 0)) for j in range(len(shas))]), at).alias("cluster_inertia"),
                      capped(sum(per.values())).alias("inertia"), F.element_at(F.array(*map(F.lit, shas)), at).alias("centroid_sha256"))


def _twin() -> str:
    """One step a round: assign, then the floors of the means."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
e AS MATERIALIZED (SELECT rid, vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS p FROM v),
c0 AS MATERIALIZED (
  SELECT rn - 1 AS j, unnest(q) AS m, generate_subscripts(q, 1) AS p
  FROM (SELECT q, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) AS rn FROM v) WHERE rn <= {K})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
d{i} AS MATERIALIZED (SELECT rid, j, CAST(sum((x - m) * (x - m)) AS BIGINT) AS d FROM e JOIN c{i} USING (p) GROUP BY rid, j),
a{i} AS MATERIALIZED (SELECT rid, min(d) AS d, arg_min(j, (d, j)) AS j FROM d{i} GROUP BY rid)""")
        if i < ROUNDS:
            steps.append(f"""
s{i} AS MATERIALIZED (SELECT j, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM e JOIN a{i} USING (rid) GROUP BY j, p),
c{i + 1} AS MATERIALIZED (SELECT c.j, c.p, CASE WHEN n IS NULL THEN c.m ELSE (s - ((s % n) + n) % n) // n END AS m FROM c{i} c LEFT JOIN s{i} USING (j, p))""")
    return "WITH " + ",".join(steps) + f""",
h AS (SELECT j, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY p)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY j)
SELECT vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} a JOIN v USING (rid) JOIN h ON h.j = a.j"""


ORACLE = {"op13_wht_clusters": _twin()}
QUERIES = {"op13_wht_clusters": op13_wht_clusters}
