"""Operators 1, 2, 3, 5 and 6, the pipeline and the registration."""

import collections
import math
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from fleetcast.llm import chat_perspectives, cotraining, nce_lm, nra_topk, prefix_forest, queries

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = {q.split("_")[0] for q in queries.QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)} and len(queries.QUERIES) == 13
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(str, cur.fetchall()))


# ---------------------------------------------------------------- 1
def test_perspectives_of_three_parties(spark, scratch):
    rows = [(1, 0, "system", "Rules", "x"), (1, 1, "ann", "Hi <|end|>", "x"), (1, 2, "bob", "Yo", "x"), (1, 2, "bob", "Yo", "x"),
            (1, None, "ann", None, "x"), (2, 0, "system", "alone", "x"), (None, 0, None, "lost", "x"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, block string")
    got = {(r.conv_id, r.perspective): r for r in chat_perspectives.perspectives(df, scratch(), block=100).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "unknown")}
    r = got[1, "bob"]
    assert r.text == ("<|user|>ann\n<|end|>\n<|system|>\nRules<|end|>\n<|user|>ann\nHi < |end|><|end|>\n"
                      "<|assistant|>\nYo<|end|>\n<|assistant|>\nYo<|end|>\n") and r.n_turns == 5
    spans = [tuple(map(int, x.split("-"))) for x in r.mask.split(",")]
    assert [r.text[a:b] for a, b in spans] == ["Yo<|end|>\n"] * 2
    assert chat_perspectives.perspectives(df.where("false"), scratch()).count() == 0


def test_blocks_join_to_the_whole(spark, scratch):
    rows = [(c, t, ["a", "b", "c"][t % 3], f"turn {t}") for c in (1, 2) for t in range(100)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    blocks = sorted(chat_perspectives.perspectives(df, scratch(), block=7).collect(), key=lambda r: r.block)
    one = {(r.conv_id, r.perspective): r.text for r in chat_perspectives.perspectives(df, scratch(), block=1000).collect()}
    joined = collections.defaultdict(str)
    for r in blocks:
        joined[r.conv_id, r.perspective] += r.text
    assert joined == one and len(one) == 6


def test_chat_formatting_runs_no_python(spark, scratch):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn int, role string, text string")
    plan = chat_perspectives.perspectives(df, scratch())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- 2
def test_classifier_on_labels_it_has_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.where("pmod(xxhash64(doc_id, 1L), 3) > 0")
    got = {r.doc_id: r.quality for r in cotraining.scored(docs, seen).collect()}
    rest = labels.join(seen, "doc_id", "left_anti").collect()
    good = [got[r.doc_id] for r in rest if r.quality == 1 and r.toxic == 0]
    junk = [got[r.doc_id] for r in rest if r.quality == 0]
    assert np.mean([g.keep for g in good]) >= 0.95 and np.mean([not g.keep for g in junk]) >= 0.9
    fitted = cotraining.fit(docs, seen)
    assert fitted.n_pseudo > 0 and fitted.text.w is not None and fitted.meta.w is not None


def test_toxic_documents_are_rejected(spark):
    """Held-out recall on toxic documents, apart from low quality."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = labels.where("pmod(xxhash64(doc_id, 'part'), 3) > 0")
    rest = labels.where("pmod(xxhash64(doc_id, 'part'), 3) = 0").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = cotraining.scored(docs, seen, "result").join(rest, "doc_id").select("result.keep", "quality", "toxic").collect()
    toxic, junk, good = ([r.keep for r in rows if (r.quality, r.toxic) in kinds] for kinds in ([(1, 1)], [(0, 0), (0, 1)], [(1, 0)]))
    assert len(toxic) >= 80 and np.mean(toxic) <= 0.1 and np.mean(junk) <= 0.05 and np.mean(good) >= 0.97


def _logit(p):
    return math.log(p / (1 - p))


def test_scores_equal_plain_python(spark, documents):
    """Both views, their sum of evidence, the toxic model and the decision, word by word from the fitted numbers."""
    f = cotraining.fit(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    p = lambda fit, z: 1 / (1 + math.exp(-(fit[0] * z + fit[1])))
    for r in cotraining.scored(documents, spark.read.parquet(f"{SF}/labels.parquet")).limit(150).collect():
        raw = (r.text or "").encode()
        words = raw.lower().split()
        styles = cotraining.style(raw, words, len(set(words)))
        dense = [max(-5.0, min(5.0, (x - m) / s)) for x, m, s in zip(styles, f.mean, f.scale)]
        margin = lambda model, known, ids: (sum(model.w[known[i]] for i in set(ids) if i in known)
                                            + sum(a * b for a, b in zip(dense, model.v)) + model.b)
        ids = lambda ws: [int(cotraining.word_ids({w})[0]) for w in ws]
        pt = p(f.text_fit, margin(f.text, f.words, ids(words)))
        pm = p(f.meta_fit, margin(f.meta, f.metas, cotraining.meta_ids(r.lang, r.source, r.n_chars)))
        both = 1 / (1 + math.exp(-(_logit(pt) + _logit(pm) - _logit(f.prior))))
        bare = raw.lower().translate(None, cotraining._PUNCTUATION).split()
        toxic = margin(f.toxic, f.bare, ids(bare)) if f.toxic else -math.inf
        score = both * (1 - p(f.toxic_fit, toxic)) if f.toxic else both
        assert np.allclose([r.quality.text_score, r.quality.meta_score, r.quality.score], [pt, pm, score], rtol=1e-7, atol=1e-12)
        if abs(both - f.least) > 1e-9 and not abs(toxic - f.most) < 1e-9:
            assert r.quality.keep == (both >= f.least and toxic <= f.most)


def test_pseudo_labels_are_the_surest_of_all_unlabelled(spark, documents, scratch):
    marks = spark.read.parquet(f"{SF}/labels.parquet").where("pmod(xxhash64(doc_id), 4) > 0").select("doc_id").distinct()
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(marks, "doc_id")
    f = cotraining.fit(documents, labels)
    labelled = {r.doc_id for r in marks.collect()}
    rows = set()
    for r in documents.union(documents).collect():  # repeated rows count once
        if r.doc_id not in labelled:
            raw = (r.text or "").encode()
            words = raw.lower().split()
            rows.add(cotraining.packed(set(words), cotraining.style(raw, words, len(set(words))),
                                       cotraining.meta_ids(r.lang, r.source, r.n_chars), f.words))
    every = cotraining.surest(f, sorted(rows), 0.6)
    told = {"text": {every[every.to == "text"].row.iloc[0]: True}, "meta": {}}
    ask = cotraining._unlabelled(documents.union(documents), marks, scratch(), 7)(f)
    got = ask(f, 0.6, told)
    every = every[[not (t == "text" and b in told["text"]) for t, b in zip(every.to, every.row)]]
    for (to, good), part in every.groupby(["to", "good"]):
        mine = got[(got.to == to) & (got.good == good)]
        assert len(mine) == min(7, len(part))
        surety = {bytes(b): x for b, x in zip(part.row, part.surety)}
        assert np.allclose(sorted(surety[bytes(b)] for b in mine.row), sorted(part.surety)[-len(mine):])
    assert len(got) and set(map(bytes, got.row)) <= rows


def test_classifier_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 0), (5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = cotraining.scored(odd_documents, labels, "result")
    rows = out.collect()
    assert len(rows) == 12 and out.columns == [*odd_documents.columns, "result"]
    assert all(0 <= r.result.score <= 1 and r.result.keep is not None for r in rows)
    assert all(r.result.keep and r.result.score == 1.0 for r in cotraining.scored(odd_documents, labels.where("false"), "result").collect())
    assert cotraining.scored(no_documents, labels, "result").count() == 0


# ---------------------------------------------------------------- 3 and 6
ODD_VECTORS = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (100, [0.0, 1.0]), (200, None), (300, [float("nan"), 1.0]), (400, [None, 1.0]),
               (500, [0.0, 0.0]), (600, [2.0, 2.0, 2.0]), (601, [2.0, 2.0, 1.0]), (None, [1.0, 1.0]), (700, []), (3, [1.0, 0.5])]


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cid string, score int")


def test_forest_recall_and_scores(spark, scratch):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, np.float64) for r in df.collect()}
    got = collections.defaultdict(list)
    for r in prefix_forest.nearest(df, scratch(), every=5, shard=128, block=16).collect():
        got[r.query_id].append(r)
    hit = total = 0
    for q in (i for i in data if i % 5 == 0):
        want = sorted((float(np.sqrt(((data[i] - data[q]) ** 2).sum())), i) for i in data if i != q)[:10]
        rows = sorted(got[q], key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 11)) and [(r.score, r.vec_id) for r in rows] == sorted((r.score, r.vec_id) for r in rows)
        for r in rows:
            assert math.isclose(r.score, float(np.sqrt(((data[r.vec_id] - data[q]) ** 2).sum())), rel_tol=1e-12)
        hit, total = hit + len({i for _, i in want} & {r.vec_id for r in rows}), total + 10
    assert hit >= 0.9 * total


def test_forest_odd_vectors(spark, scratch):
    got = collections.defaultdict(list)
    for r in prefix_forest.nearest(_vectors(spark, ODD_VECTORS), scratch(), every=100).collect():
        got[r.query_id].append((r.rank, r.vec_id))
    assert sorted(got) == [0, 100, 600]
    assert [v for _, v in sorted(got[0])] == [1, 3, 100] and [v for _, v in sorted(got[100])] == [3, 0, 0, 1]
    assert [v for _, v in got[600]] == [601]
    assert prefix_forest.nearest(_vectors(spark, ODD_VECTORS).where("false"), scratch()).count() == 0


def _products(data, every, top):
    out = set()
    for q in (i for i in data if i % every == 0):
        want = sorted((-int(data[i] @ data[q]), i) for i in data if i != q and len(data[i]) == len(data[q]))[:top]
        out |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(want)}
    return out


@pytest.mark.parametrize("shard", [40, 4096])
def test_nra_equals_brute_force(spark, scratch, shard):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = {r.vec_id: np.floor(256 * np.array(r.embedding, np.float64)).astype(np.int64) for r in df.collect()}
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in nra_topk.top_products(df, scratch(), every=5, shard=shard, block=16).collect()}
    assert got == _products(data, 5, 5)


def test_nra_stops_early_and_odd_vectors(spark, scratch):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, (500, 3)).astype(float)
    x[:4] = 1000
    keep = nra_topk.top_rows(x, np.array([[1.0, 1.0, 1.0], [-1.0, 0.0, 2.0]]), 4)
    assert set(keep[0]) >= {0, 1, 2, 3} and len(keep[0]) < 500
    real = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").where("embedding is not null").limit(1000).collect()
    x = np.floor(256 * np.array([r.embedding for r in real if len(r.embedding) == 64]))
    read = np.zeros(20, int)
    for q, rows in zip(x, nra_topk.top_rows(x, x[:20], 6, read)):
        score = x @ q
        assert set(np.flatnonzero(score >= np.sort(score)[-6])) <= set(rows) and len(rows) <= 24
    assert (read < len(x)).mean() >= 0.9  # bounds decide, not the ends of the lists
    got = {(r.query_id, r.vec_id) for r in nra_topk.top_products(_vectors(spark, ODD_VECTORS), scratch(), every=100).collect()}
    assert got == {(0, 1), (0, 3), (0, 100), (0, 500), (100, 0), (100, 1), (100, 3), (100, 500), (500, 0), (500, 1), (500, 3), (500, 100), (600, 601)}
    assert nra_topk.top_products(_vectors(spark, ODD_VECTORS).where("false"), scratch()).count() == 0


# ---------------------------------------------------------------- 5
def test_scores_of_documents(documents, scratch):
    rows = documents.select("doc_id", "text").collect()
    counts = collections.Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 5 != 1:
            counts.update((r.text or "").encode().lower().split())
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in nce_lm.score(documents, scratch(), classes=64, common_words=200).collect()}
    base = model = 0.0
    for r in rows:
        w = [*(r.text or "").encode().lower().split(), b""]
        g = got[r.doc_id]
        want = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert g.n_tokens == len(w) and g.n_known == sum(counts[x] > 0 for x in w) and g.train_tokens == n
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and math.isclose(g.base_score, want, rel_tol=1e-9)
        if g.held_out:
            base, model = base + want, model + g.score
    assert model > base  # more likely on texts it has not seen


def test_model_is_normalised(spark):
    p = nce_lm.Model(np.full(20, 1 / 20), 4).p
    z = nce_lm.log_z(spark, p)
    a1, a2 = p["R"] @ p["C1"].T, p["R"] @ p["C2"].T
    for c2, c1 in ((0, 0), (3, 7)):
        s = (a1[c1] + a2[c2]) @ p["Q"].T + p["b"][:, 0] - z[c2, c1]
        assert math.isclose(float(np.exp(s[1:]).sum()), 1.0, rel_tol=1e-9)


def test_scores_odd_rows(odd_documents, no_documents, scratch):
    got = nce_lm.score(odd_documents, scratch(), classes=16, common_words=8).collect()
    assert len(got) == 12 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 8)} == {1}
    assert nce_lm.score(no_documents, scratch()).count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, documents):
    from fleetcast.llm.common import Scratch
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "spans", "packing"]
    scratch, docs = Scratch(spark, "pipeline-test"), documents
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.save(stage(spark, docs, SF), name)
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert out.columns == documents.columns and set(after) <= set(before)
        if name == "quality":
            clean = [d for d, r in labels.items() if d in before and r.quality == 1 and r.toxic == 0]
            assert sum(d in after for d in clean) >= 0.95 * len(clean) and len(after) < len(before)
        if name == "near_duplicates":
            assert all(after[d] == before[d] for d in after)
        if name in ("lines", "spans"):
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_pipeline_odd_rows(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == odd_documents.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
