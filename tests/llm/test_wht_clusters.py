"""Clustering: the search against plain distances, whole runs against a plain loop in Python integers, odd rows."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetcast.llm import wht_clusters as wc
from fleetcast.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def test_matrix_is_orthogonal_and_coarse_to_fine():
    h = wc.hadamard(64)
    assert (h @ h.T == 64 * np.eye(64, dtype=np.int64)).all()
    assert ((np.diff(h, axis=1) != 0).sum(axis=1) == np.arange(64)).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 2, 3, 50, 1 << 24, 1 << 90]), st.integers(1, 9))
def test_search_is_plain_distance(seed, top, k):
    """Small ranges make ties; huge ones need Python integers."""
    rng = np.random.default_rng(seed)
    draw = lambda n: np.array([[int(x * (2 * top - 1)) - top + 1 for x in rng.random(16)] for _ in range(n)], dtype=object)
    x, c = draw(12), draw(k)
    kind = object if top > 1 << 24 else np.int64
    h = wc.hadamard(16).T.astype(kind)
    number, far = wc.nearest(x.astype(kind) @ h, c.astype(kind) @ h)
    plain = [[sum((a - b) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
    assert list(number) == [d.index(min(d)) for d in plain]
    assert [int(f) for f in far] == [16 * min(d) for d in plain]


def test_coarse_coefficients_eliminate(spark):
    """On clustered vectors the search looks at fewer differences than all centroids have."""
    rng = np.random.default_rng(5)
    c = rng.integers(-500, 500, (8, 64))
    smooth = np.cumsum(rng.integers(-60, 60, (8, 64)), axis=1) + rng.integers(-900, 900, (8, 1))
    x = smooth[rng.integers(0, 8, 2000)] + rng.integers(-40, 40, (2000, 64))
    h, work = wc.hadamard(64).T, []
    number, _ = wc.nearest(x @ h, smooth @ h, work)
    assert work[0] < 0.4 * 2000 * 8 * 64
    assert (number == ((x[:, None] - smooth[None]) ** 2).sum(2).argmin(1)).all()
    assert len(wc.nearest(x[:0] @ h, c @ h)[0]) == 0


def plain(rows, dims=64, k=8, rounds=10):
    """Sorted result rows of (vec_id, embedding)."""
    def floor(x):
        num, den = float(x).as_integer_ratio()
        return 1024 * num // den
    kept = [(i, [floor(x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: name(r[0]))[:k]
    c = [v for _, v in first]
    dist = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w))

    def assign():
        out = []
        for _, v in kept:
            d = [dist(v, w) for w in c]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        at = [j for j, _ in assign()]
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                c[j] = [sum(column) // len(mine) for column in zip(*mine)]
    final = assign()
    inertia = [sum(d for j, d in final if j == n) for n in range(len(c))]
    cap = lambda n: min(n, 2**63 - 1)
    return sorted(((i, j, cap(d), cap(inertia[j]), cap(sum(map(cap, inertia))), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
                   for (i, _), (j, d) in zip(kept, final)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def run(spark, tmp_path, rows, schema="vec_id long, embedding array<float>, cluster string, coef int", extra=("x", 1)):
    spark.createDataFrame([(*r, *extra) for r in rows], schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    return result(wc.op13_wht_clusters(spark, str(tmp_path)))


def test_query_is_a_plain_loop(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert result(wc.op13_wht_clusters(spark, SF)) == plain(rows)


def test_odd_vectors(spark, tmp_path):
    """Nulls, other lengths, non-finite components, repeated rows, a null id, clashing columns."""
    rng = np.random.default_rng(11)
    good = [(i, [float(x) for x in rng.normal(size=64).astype(np.float32)]) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [1.0] * 63 + [None]), (105, [1.0] * 63 + [float("nan")]),
           (106, [1.0] * 63 + [float("inf")]), (107, [0.0] * 64), (None, [0.5] * 64), (3, good[3][1]), (3, good[3][1])]
    assert run(spark, tmp_path, good + odd) == plain(good + odd)


def test_huge_components(spark, tmp_path):
    rng = np.random.default_rng(12)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64) * 10.0 ** (i % 4 * 3)]) for i in range(24)]
    rows += [(90, [3e38] * 64), (91, [-3e38] * 32 + [1.0] * 32)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, tmp_path, rows) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, tmp_path, n):
    rows = [(i, [float(i)] * 64) for i in range(n)] + [(50, None)]
    assert run(spark, tmp_path, rows) == plain(rows)


def test_other_widths(spark):
    rows = [(i, [float(i % 5), float(i % 3), 0.25, -0.5]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out, centroids = wc.cluster(df, Scratch(spark, "t13"), dims=4, k=3, rounds=4)
    assert sorted((r[0], r[1], int(r[2])) for r in out.collect()) == [r[:3] for r in sorted(plain(rows, 4, 3, 4))]
    assert len(centroids.rows) == 3
