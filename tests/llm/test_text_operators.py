"""Operators 4, 7, 8, 9 and 10 against plain Python on small tables, and on odd rows."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetcast.llm import bpe, byte_bpe, common, count_rtree, fuzzy_lines, ga_packing, sentence_spans

N_ODD = 12


# ---------------------------------------------------------------- 8
def _whole_ids(text):
    return bpe.coder().encoding.encode_ordinary(text or "")


def test_bpe_equals_whole_text_encoding(documents, scratch):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = byte_bpe.decode(byte_bpe.encode(documents, scratch(), chunk=200, overlap=64)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == _whole_ids(texts[r.doc_id])
        assert bytes(r.decoded).decode() == texts[r.doc_id] and r.n_tokens == len(r.ids) // 4


def test_bpe_odd_rows(odd_documents, no_documents, scratch):
    got = byte_bpe.encode(odd_documents, scratch(), finish=byte_bpe.digests, schema=byte_bpe.DIGESTS).collect()
    want = collections.Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd_documents.collect())
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in got) == want and len(got) == N_ODD
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {0}
    assert byte_bpe.encode(no_documents, scratch()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab' \n\t é1,.st'rel½", max_size=300))
def test_stitching_finds_the_matches_of_the_whole(text):
    c = bpe.coder()
    assert c.encode(text) == _whole_ids(text)
    cuts = byte_bpe.cut_points(text, 40, 24)
    whole = byte_bpe.boundaries(c.regex, text)
    for a, b in zip(cuts, cuts[1:]):
        chunk = text[a : b + 24]
        later = text[b : b + 64] if b + 64 < len(text) else text[b:]
        mine, theirs = byte_bpe.boundaries(c.regex, text[cuts[0] : b + 24]), byte_bpe.boundaries(c.regex, later)
        at = byte_bpe.stitch(mine[mine >= b], b + 24, theirs[theirs <= 24], b)
        assert at in whole and chunk


# ---------------------------------------------------------------- 7
def test_packing_pieces_and_places(documents, scratch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.default_path("byte_bpe_50k.json"))
    rows = ga_packing.pack(documents, scratch()).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for d in documents.collect():
        ids = np.array(tok.encode(d.text, add_special_tokens=False).ids + [2], "<u4")
        parts = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts))) and sum(p.length for p in parts) == len(ids)
        assert len(parts) == -(-len(ids) // 1024) and all(p.length == 1024 for p in parts[1:])
        for p in parts:
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(by_seq) <= 1.02 * -(-total // 1024) + 1


def test_packing_odd_rows(odd_documents, no_documents, scratch):
    rows = ga_packing.pack(odd_documents, scratch()).collect()
    assert sum(r.piece == 0 for r in rows) == N_ODD
    assert {r.length for r in rows if r.doc_id in (2, 3)} == {1}
    assert ga_packing.pack(no_documents, scratch()).count() == 0


def test_evolution_never_loses_to_its_seed():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 1024, 400))[::-1].astype(np.int64)
    seed = ga_packing.tidy(np.arange(400))
    best = ga_packing.evolve(lengths, [seed], 1024, rng)[0]
    f = ga_packing.fills(best, lengths)
    plain = np.zeros(400, np.int32)
    ga_packing.best_fit(lengths, np.arange(400), plain, [], 1024)  # best fit decreasing
    assert f.max() <= 1024 and len(f) <= plain.max() + 1 and f.sum() == lengths.sum()
    child = ga_packing.crossover(best, seed, lengths, 1024, rng)
    assert ga_packing.fills(child, lengths).max() <= 1024 and len(child) == 400


# ---------------------------------------------------------------- 9
def _sets(rows, width):
    out = {}
    for r in rows:
        w = (r.text or "").encode().lower().split()
        out[r.doc_id] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    return out


def _components(sets, percent):
    names = sorted(sets)
    up = {d: d for d in names}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            s, t = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: find(d) for d in names}


@pytest.mark.parametrize("width,percent,tile", [(4, 85, 1024), (5, 80, 8)])
def test_jaccard_components_equal_brute_force(spark, documents, scratch, width, percent, tile):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in documents.limit(80).collect()]
    for k in range(60):  # a chain and a star of near copies of two texts, some rare and some common edits
        w = rows[k % 2][1].split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 40)}"
        rows.append((10_000 + k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = _sets(df.collect(), width)
    want = _components(sets, percent)
    got = count_rtree.jaccard_components(df, scratch(), width, percent, block=16, tile_size=tile).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(s) for d, s in sets.items()}


def test_jaccard_odd_rows(odd_documents, no_documents, scratch):
    got = collections.defaultdict(list)
    for r in count_rtree.jaccard_components(odd_documents, scratch()).collect():
        got[r.doc_id].append((r.n_shingles, r.component_id))
    assert sum(map(len, got.values())) == N_ODD
    assert got[2] == [(0, 2)] and got[3] == [(0, 3)] and got[8] == [(0, 8)] and got[None] == [(0, None)]
    assert got[7] == [(1, 6)] and got[6] == [(1, 6)] and got[10][0][1] == 4 and {c for _, c in got[5]} == {5}
    assert count_rtree.jaccard_components(no_documents, scratch()).count() == 0


def test_bounds_never_miss():
    for n in range(1, 400):
        for percent in (80, 85):
            need = int(count_rtree.needed(n, percent))
            assert need - 1 < percent * n / 100 <= need
            p, ask = int(count_rtree.prefix_size(n, percent)), int(count_rtree.asked(n, percent))
            assert 1 <= ask <= p <= n


def test_very_large_sets_share_no_more_than_their_bound():
    """Groups of over 255 shingles: what does not fit the counts is in the bound too."""
    rng = np.random.default_rng(4)
    for n, same in ((90_000, 80_000), (200_000, 200_000), (300_000, 1_000), (500, 400)):
        a = rng.integers(0, 2**64, n, np.uint64)
        b = np.r_[a[:same], rng.integers(0, 2**64, n - same, np.uint64)]
        x, y = (np.frombuffer(count_rtree.fold(v), "u1").astype(np.int64) for v in (a, b))
        assert same <= np.minimum(x, y).sum() + min(len(a) - x.sum(), len(b) - y.sum()) <= n


def test_pairs_come_from_one_branch():
    """Three branches with the same points give each pair once, in leaves of both sizes."""
    for size in (10, 100):
        h = [np.arange(1000 + i, 1200 + i, dtype=np.uint64) for i in range(size)]
        rows = [{"branch": k, "lower": np.array([b for b in (3, 5, 8) if b < k], np.int32), "doc_id": i, "n": 200, "point": count_rtree.fold(x), "comp": i, "tile_kind": 0,
                 "tile_i": 0, "tile_j": 0, "side": 0, "crossed": False} for k in (3, 5, 8) for i, x in enumerate(h)]
        out = pd.concat(count_rtree._leaf_pairs(80)(iter([pd.DataFrame(rows)])))
        got = [(min(p), max(p)) for p in zip(out["a"], out["b"])]
        assert len(got) == len(set(got)) and set(got) >= {(i, j) for i in range(size) for j in range(i + 1, size) if 180 * (200 - j + i) >= 80 * 400}


# ---------------------------------------------------------------- 4
def _plain_runs(parts):
    """Every run forwards from a piece and backwards from one, as the words themselves."""
    real = [(i, tuple(p.lower().split())) for i, p in enumerate(parts) if p.split()]
    enough = lambda a, b: b - a >= sentence_spans.MIN_SENTENCES and sum(len(w) for _, w in real[a:b]) >= sentence_spans.MIN_WORDS
    spots = set()
    for k in range(len(real)):
        spots.update((k, b) for b in itertools.islice((b for b in range(k, len(real) + 1) if enough(k, b)), 1))
        spots.update((a, k + 1) for a in itertools.islice((a for a in range(k, -1, -1) if enough(a, k + 1)), 1))
    return [(real[a][0], real[b - 1][0] + 1, tuple(w for _, w in real[a:b])) for a, b in spots]


def _plain_spans(rows):
    seen, keep = {}, {}
    order = sorted({(r.doc_id, r.text) for r in rows if r.text}, key=lambda x: (x[0] is not None, x[0] or 0))
    where = collections.defaultdict(list)
    for d, t in order:
        for x, y, z in sorted(_plain_runs(sentence_spans.sentences(t))):
            where[z].append((d, t, x, y))
    for z, spots in where.items():
        for spot in spots[1:]:
            seen.setdefault(spot[:2], set()).update(range(spot[2], spot[3]))
    for d, t in order:
        keep[d, t] = "".join(p for i, p in enumerate(sentence_spans.sentences(t)) if i not in seen.get((d, t), ()))
    return keep


def test_spans_equal_plain_python(documents, scratch):
    rows = documents.collect()
    want = _plain_spans(rows)
    got = {r.doc_id: r.spans.text for r in sentence_spans.dedup(documents, scratch()).collect()}
    assert got == {r.doc_id: want.get((r.doc_id, r.text), r.text) for r in rows}
    assert any(got[r.doc_id] != r.text for r in rows)


def test_spans_odd_rows(odd_documents, no_documents, scratch):
    out = sentence_spans.dedup(odd_documents, scratch(), name="result")
    assert out.columns == [*odd_documents.columns, "result"]
    got = {r.doc_id: r.result for r in out.collect()}
    assert got[1].n_removed == 0 and got[5].text == "Another tail, of the fifth." and got[2].text is None and got[3].text == ""
    assert got[4].n_removed == 0 and out.count() == N_ODD
    assert sentence_spans.dedup(no_documents, scratch(), name="result").count() == 0


def test_planted_passages_go(spark, scratch):
    """Passages inside long sentences, and tails after a long one; no runs() on the side that checks."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, total = [], 0
    for k in range(40):
        # no stop inside; one long sentence and two short ones
        passage = text(80) if k % 2 else ". ".join(text(n) for n in (30, 12, 11)) + "."
        total += len(passage.split())
        rows += [(k, f"{text(9)} {passage} {text(9)}."), (1000 + k, f"{text(11)}. {text(7)} {passage} {text(5)}.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans.text for r in sentence_spans.dedup(df, scratch()).collect()}
    left = 0
    for k in range(40):
        first, words = rows[2 * k][1], set(rows[2 * k][1].split())
        assert got[k] == first
        here = sum(w in words for w in got[1000 + k].split())
        assert here < 40, k
        left += here
    assert left <= 0.15 * total


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abΣİ .!?,\n。", max_size=80), min_size=1, max_size=4))
def test_sentences_join_to_the_text(texts):
    texts.append(" ".join(texts).replace(".", ""))
    parts = [sentence_spans.sentences(t) for t in texts]
    assert ["".join(p) for p in parts] == texts
    cut = sentence_spans.Cut(texts, 2, 3)
    assert cut.n_pieces.tolist() == [len(p) for p in parts]
    for k, p in enumerate(parts):
        assert cut.place[cut.head[k] : cut.head[k + 1]].tolist() == [i for i, x in enumerate(p) if x.split()]


# ---------------------------------------------------------------- 10
def _edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=25), st.binary(max_size=25))
def test_edit_distance(a, b):
    assert fuzzy_lines.edits(a, b) == _edits(a, b)


def _plain_lines(rows):
    spots, sims = collections.defaultdict(list), {}
    for d, t in sorted({(r.doc_id, r.text) for r in rows if r.text}):
        for i, line in enumerate(fuzzy_lines.normalised(t)):
            if len(line) >= fuzzy_lines.MIN_CHARS:
                spots[line].append((d, t, i))
    lines = list(spots)
    sims = fuzzy_lines.simhashes(lines)
    up = list(range(len(lines)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(lines)):
        near = np.flatnonzero(np.bitwise_count(sims ^ sims[i]) <= fuzzy_lines.DISTANCE)
        for j in near[near > i].tolist():
            if fuzzy_lines.similar(lines[i], lines[j], fuzzy_lines.SIMILARITY):
                up[find(j)] = find(i)
    groups = collections.defaultdict(list)
    for i, line in enumerate(lines):
        groups[find(i)] += spots[line]
    gone = collections.defaultdict(set)
    for g in groups.values():
        for d, t, i in sorted(g)[1:]:
            gone[d, t].add(i)
    return gone


@pytest.mark.parametrize("size", [1024, 2])
def test_lines_equal_plain_python(spark, documents, scratch, monkeypatch, size):
    monkeypatch.setattr(fuzzy_lines, "TILE_SIZE", size)  # 2: every key of three lines is cut into tiles
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    long_lines = [x for _, t in rows for x in t.split("\n") if len(x) > 200][:20]
    for k, line in enumerate(long_lines):  # one letter changed, far inside
        at = rng.randrange(60, len(line) - 60)
        rows.append((50_000 + k, "A line of its own number " + "abcdefghijklmnopqrstuvwxyz"[k] * 30 + "\n" + line[:at] + "q" + line[at + 1 :]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = _plain_lines(df.collect())
    got = {(r.doc_id, r.text): r.lines for r in fuzzy_lines.dedup(df, scratch()).collect()}
    for (d, t), r in got.items():
        assert r.text == ("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t])), d
        assert r.n_removed == len(gone[d, t])


def test_changed_lines_are_found_at_every_length(spark, documents, scratch):
    """Recall against edit similarity alone: no SimHash on the side that checks."""
    rng = random.Random(9)
    distinct = sorted({x for r in documents.collect() for x in fuzzy_lines.normalised(r.text or "") if x.isascii()})
    rng.shuffle(distinct)
    rows, planted = [], collections.defaultdict(list)
    for low, high in ((20, 60), (60, 120), (120, 200), (200, 400), (400, 800)):
        for line in [x for x in distinct if low <= len(x) < high][:60]:
            for share in (0, 0.02, 0.05):
                other = bytearray(line)
                for i in rng.sample([i for i, c in enumerate(line) if c != 32], max(1, int(share * len(line)))):
                    other[i] = rng.choice([c for c in b"abcdefghijklmnopqrstuvwxyz" if c != other[i]])
                assert _edits(line, bytes(other)) <= (1 - fuzzy_lines.SIMILARITY) * len(line) if len(line) < 100 else True
                planted[low, share].append(10_000 + len(rows))
                rows.append((10_000 + len(rows), bytes(other).decode()))
            rows.append((len(rows), line.decode()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r.doc_id for r in fuzzy_lines.dedup(df, scratch()).collect() if r.lines.n_removed}
    for key, ids in planted.items():
        assert len(ids) >= 10 and len(gone.intersection(ids)) >= 0.9 * len(ids), key


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.lists(st.tuples(st.integers(0, 60), st.binary(max_size=3), st.integers(0, 3)), max_size=4))
def test_plain_way_is_never_shorter(a, changes):
    b = a
    for at, new, gone in changes:
        b = b[:at] + new + b[at + gone :]
    assert fuzzy_lines.edits_at_most(a, b, 10**6) >= _edits(a, b)
    assert fuzzy_lines.edits_at_most(a, a, 0) == 0


def test_blocks_meet_for_similar_lines_only():
    """One block of ten bytes and more is seldom shared by chance, and every pair of short lines within the limit shares one."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))
    common = [word() for _ in range(60)]  # few words, as in lines of one kind
    lines = [" ".join(rng.choice(common) for _ in range(rng.randrange(30, 60))).encode() for _ in range(2000)]
    line, key = fuzzy_lines.blocks(lines, fuzzy_lines.SIMILARITY)
    key = key & (1 << fuzzy_lines.KEY_BITS) - 1
    keys, n = np.unique(key >> 1, return_counts=True)
    assert len(key) <= 18 * len(lines) and n[n > 1].sum() <= 0.5 * len(key)
    for size in range(10, 20):
        for _ in range(20):
            a = bytes(rng.choice(b"abcdefghij") for _ in range(size))
            at = rng.randrange(size)
            b = rng.choice([a[:at] + b"z" + a[at + 1 :], a[:at] + a[at + 1 :], a[:at] + b"z" + a[at:]])
            if 1 <= 0.1 * max(len(a), len(b)) + 1e-9:
                who, key = fuzzy_lines.blocks([a, b], fuzzy_lines.SIMILARITY)
                key = (key & (1 << fuzzy_lines.KEY_BITS) - 1) >> 1
                assert set(key[who == 0].tolist()) & set(key[who == 1].tolist()), (a, b)


def test_edits_of_many_pairs_at_once(monkeypatch):
    """The steps for all pairs at once decide as ``similar`` does, at every length and on both sides of the limit."""
    monkeypatch.setattr(fuzzy_lines, "ENOUGH", 1)
    rng = random.Random(3)
    lines, i, j = [], [], []
    for size in [1, 5, 63, 64, 65, 128, 129, 200, 300, 600] * 8:
        line = bytes(rng.choice(b"abcd ") for _ in range(size))
        lines.append(line)
        for share in (0.02, 0.09, 0.12):
            other = bytearray(line)
            for _ in range(max(1, int(share * size))):
                at = rng.randrange(len(other) + 1)
                other[at : at + rng.randrange(2)] = rng.choice([b"", b"x", b"\xff"])
            i.append(len(lines) - 1 if share == 0.02 else i[-1])
            j.append(len(lines))
            lines.append(bytes(other))
    got = fuzzy_lines.all_similar(lines, np.array(i), np.array(j), 0.9).tolist()
    assert got == [fuzzy_lines.similar(lines[x], lines[y], 0.9) for x, y in zip(i, j)] and 0 < sum(got) < len(got)


def test_links_grow_with_the_lines_of_a_group(spark, scratch, monkeypatch):
    """Forty lines of one group are joined by a few links a line, not by one for each of their 780 pairs."""
    rng, counts, components = random.Random(8), [], fuzzy_lines.connected_components
    line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))
    rows = [(k, line[: 5 + 7 * k] + "9" + line[6 + 7 * k :] + "\nown " + chr(97 + k % 26) * 40 + str(rng.random())) for k in range(40)]

    def counted(scratch, edges, *args):
        counts.append(edges.where("a <> b").count())
        return components(scratch, edges, *args)
    monkeypatch.setattr(fuzzy_lines, "connected_components", counted)
    gone = {r.doc_id for r in fuzzy_lines.dedup(spark.createDataFrame(rows, "doc_id long, text string"), scratch()).collect()
            if line[-40:].strip() not in r.lines.text}
    assert gone == set(range(1, 40)) and max(counts) <= 4 * 40


def test_edits_of_a_pair_are_counted_once(spark, scratch):
    """Lines that share many blocks but are not similar: each pair is looked at once, however many blocks it shares."""
    rng, saved, to = random.Random(6), {}, scratch()
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(40)]
    rows = []
    for k in range(30):
        own = list(words)
        for at in rng.sample(range(40), 6):
            own[at] = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12))
        rows.append((k, " ".join(own)))
    save = to.save
    to.save = lambda df, name, codec=None: saved.setdefault(name, save(df, name, codec))
    out = fuzzy_lines.dedup(spark.createDataFrame(rows, "doc_id long, text string"), to).collect()
    assert sum(r.lines.n_removed for r in out) == 0
    pairs = [(r.a, r.b) for name, df in saved.items() if name.startswith("pairs") for r in df.collect()]
    assert 200 < len(pairs) == len(set(pairs)) <= 30 * 29 // 2


def test_lines_are_split_once_a_document(spark, scratch):
    """A split inside the lambda over the lines that stay would run again for each of them."""
    df = spark.createDataFrame([(1, "one line of it\nanother one"), (2, "one line of it\na third")], "doc_id long, text string")
    out = fuzzy_lines.dedup(df, scratch())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(" in plan and plan.count("split(") == 1, plan
    assert {r.doc_id: (r.lines.text, r.lines.n_lines, r.lines.n_removed) for r in out.collect()} == {
        1: (df.first().text, 2, 0), 2: ("a third", 2, 1)}


def test_packed_lengths_and_places():
    n = np.r_[np.arange(5000), np.geomspace(5000, 2**31 - 1, 2000).astype(np.int64)]
    back = fuzzy_lines.unscaled(fuzzy_lines.scaled(n))
    assert (back[n < fuzzy_lines.EXACT] == n[n < fuzzy_lines.EXACT]).all() and (np.abs(back - n) <= fuzzy_lines.OFF / 2 * n + 1).all()
    assert fuzzy_lines.scaled(n).max() < 8191


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=100, max_size=160), st.lists(st.tuples(st.integers(0, 160), st.binary(max_size=2), st.integers(0, 2)), max_size=8))
def test_pairs_ruled_out_are_not_similar(a, changes):
    b = a
    for at, new, gone in changes:
        b = b[:at] + new + b[at + gone :]
    most = np.array([0.1 * max(len(a), len(b)) + 1e-9])
    if fuzzy_lines.ruled_out([a, b], np.array([0]), np.array([1]), most)[0]:
        assert _edits(a, b) > most[0]


def test_short_lines_repeat_too(spark, scratch):
    rows = [(1, "Ok.\nAll rights reserved.\n\n--"), (2, "ok\nall rights reserved\n\n--\nNo 7"), (3, "a\n\nNO 8!"), (4, "b\nA"), (5, "bc")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.lines.text for r in fuzzy_lines.dedup(df, scratch()).collect()}
    assert got == {1: rows[0][1], 2: "\n--\nNo 7", 3: "a\n", 4: "b", 5: "bc"}


def test_lines_odd_rows(odd_documents, no_documents, scratch):
    out = fuzzy_lines.dedup(odd_documents, scratch(), name="result")
    got = {r.doc_id: r.result for r in out.collect()}
    assert out.columns == [*odd_documents.columns, "result"] and out.count() == N_ODD
    assert got[2].text is None and got[3].text == "" and got[4].n_removed == 0 and got[10].text == ""
    assert fuzzy_lines.dedup(no_documents, scratch(), name="result").count() == 0


def test_components_of_chains_and_stars(spark, scratch):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in common.connected_components(
        scratch(), spark.createDataFrame(edges, "a long, b long"), "cc").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
