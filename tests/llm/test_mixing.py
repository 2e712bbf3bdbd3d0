"""Mixing: targets against the sharing rule itself, cuts against a plain walk, odd rows."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from fleetcast.llm import mixing
from fleetcast.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, total, weights=(5, 2, 1), most=3):
    """Share by weight, fix those above their limit, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, left = {}, Fraction(total)
    while True:
        open_ = [s for s in order if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return fixed | share
        for s in above:
            fixed[s] = Fraction(most * sizes[s])
        left = total - sum(fixed.values())
        if len(fixed) == len(order):
            return fixed


def plain_mix(docs, **how):
    """Sorted (doc_id, source, size, source_size, target, taken)."""
    per, out = defaultdict(list), []
    for doc_id, source, text in docs:
        per[source].append((hashlib.sha256(f"mix:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:15], doc_id is not None, doc_id or 0,
                            len(WORD.findall(text or ""))))
    sizes = {s: sum(r[3] for r in rows) for s, rows in per.items()}
    goal = plain_targets(sizes, how.pop("total", sum(sizes.values())), **how)
    for s, rows in per.items():
        budget, size, before = int(goal[s]), sizes[s], 0
        for _, has, doc_id, n in sorted(rows):
            taken = 0 if size == 0 else budget // size * n + max(0, min(n, budget % size - before))
            before += n
            out.append((doc_id if has else None, s, n, size, float(goal[s]), taken))
    return out


def same(got, expected):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r if not isinstance(x, str)) + (str(r[1]),)
    got, expected = sorted(got, key=key), sorted(expected, key=key)
    assert [(*r[:4], r[5]) for r in got] == [(*r[:4], r[5]) for r in expected]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in expected])


ODD = [(1, "a", "one two three"), (2, "a", None), (3, "a", ""), (4, "b", "w " * 40_000), (5, None, "no source at all"), (None, "b", "no id"),
       (6, "c", "x y z w"), (7, "c", " \t\n\x0b\x0c\r "), (8, "d", ""), (9, "\U0001f600", "above the basic plane"), (9, "�", "same id"),
       *[(10, "a", "repeated row of five") for _ in range(30)], (10, "a", "another text five words"), *[(i, "e", "hot " * (i % 7)) for i in range(20, 400)]]
SCHEMA = "doc_id long, source string, text string, part string, `before` int, target string, mid long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in ODD], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "size", "source_size", "target", "taken").collect()]


@pytest.mark.parametrize("how", [{}, {"total": 700}, {"total": 10**9}, {"weights": (1,), "most": 2}, {"weights": (7, 1), "most": 1}])
def test_odd_rows_are_a_plain_walk(spark, odd, how):
    if how.get("most") == 1:
        how = how | {"total": 500}
    same(rows_of(mixing.budgeted(odd, Scratch(spark, "t11"), **how)), plain_mix(ODD, **how))


def test_documents_are_a_plain_walk(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "source", "text").collect()]
    got = rows_of(mixing.budgeted(documents, Scratch(spark, "t11")))
    same(got, plain_mix(docs))
    again = rows_of(mixing.budgeted(documents.repartition(5), Scratch(spark, "t11")))
    same(again, got)
    assert all(r[5] <= 3 * r[2] for r in got)


def test_the_mix_holds_the_words_taken(spark, odd):
    """Whole texts once a pass, the cut one up to its last word; words of a source are its budget exactly."""
    out = mixing.mix(odd, Scratch(spark, "t11")).collect()
    texts = defaultdict(set)
    for doc_id, source, text in ODD:
        texts[doc_id, source].add(text)
    taken = defaultdict(int)
    for r in out:
        words = WORD.findall(r["text"])
        assert len(words) == r["words"] > 0
        assert any(t and t.startswith(r["text"]) for t in texts[r["doc_id"], r["source"]])
        taken[r["source"]] += len(words)
    sizes = defaultdict(int)
    for _, source, text in ODD:
        sizes[source] += len(WORD.findall(text or ""))
    goal = plain_targets(sizes, sum(sizes.values()))
    assert {s: taken[s] for s in sizes} == {s: int(goal[s]) for s in sizes}


def test_empty_tables(spark, odd):
    assert mixing.budgeted(odd.where("false"), Scratch(spark, "t11")).count() == 0
    silent = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert sorted(rows_of(mixing.budgeted(silent, Scratch(spark, "t11")))) == [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)]
    assert mixing.mix(silent, Scratch(spark, "t11")).count() == 0


def test_no_python_in_the_plan(spark, documents):
    plan = mixing.budgeted(documents, Scratch(spark, "t11"), carry=("text",))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
