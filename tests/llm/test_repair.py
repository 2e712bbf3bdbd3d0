"""Conversation repair against an exhaustive search written apart from it."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetcast.llm import repair
from fleetcast.llm.common import Scratch

SF = "/root/testdata/sf0.001"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"


def plain_faults(rows):
    """(initial, fault) of (role, text) rows."""
    out = []
    for i, (role, text) in enumerate(rows):
        bare = text.strip(SPACE)
        fault = ("blank" if not bare else "duplicate" if (role, text) in rows[:i] else "truncated" if bare[-1] not in ".!?" else "none")
        out.append((role[:1], fault))
    return out


def plain_repair(rows):
    """(cost, audit, lines): a table over all prefixes of the grammar, values compared as (cost, audit) pairs."""
    cells = plain_faults(rows)

    def best(i, last):
        """Lightest (cost, audit, lines) of rows from i on, after initials ending in ``last`` ('' at the start)."""
        options = []
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        if i == len(cells) and last in ("", "a"):
            options.append((0, "", ()))
        if inserts[0] < 4:
            inserts[0] += 1
            for x in follow:
                if x != "s":
                    c, a, w = best_after(i, x)
                    options.append((c + 3, "I" + a, (("user" if x == "u" else "assistant") + ":", *w)))
            inserts[0] -= 1
        if i < len(cells):
            initial, fault = cells[i]
            c, a, w = best_after(i + 1, last)
            options.append((c + 4, "D" + a, w))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if initial and initial in follow:
                    c, a, w = best_after(i + 1, initial)
                    options.append((c + more, "K" + a, (":".join(rows[i]), *w)))
                for x in follow:
                    if x != "s":
                        c, a, w = best_after(i + 1, x)
                        options.append((c + 3 + more, "R" + a, (("user:" if x == "u" else "assistant:") + rows[i][1], *w)))
        return min(options) if options else (10**9, "", ())

    inserts = [0]
    memo = {}

    def best_after(i, last):
        key = (i, last, inserts[0])
        if key not in memo:
            memo[key] = best(i, last)
        return memo[key]

    return best_after(0, "")


def exhaustive(cells):
    """(cost, audit) over every edit of every row and up to two inserts in each place, checked by the grammar itself."""
    found = []
    per_row = []
    for initial, fault in cells:
        o = [("D", "", 4)]
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            o += [("K", initial, more), ("R", "u", 3 + more), ("R", "a", 3 + more)]
        per_row.append(o)
    ins = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*per_row):
        if any(e == "K" and not r for e, r, _ in edits):
            continue
        for gaps in itertools.product(ins, repeat=len(cells) + 1):
            roles = gaps[0] + "".join(r + g for (_, r, _), g in zip(edits, gaps[1:]))
            if GRAMMAR.match(roles):
                cost = sum(c for _, _, c in edits) + 3 * sum(map(len, gaps))
                found.append((cost, "I" * len(gaps[0]) + "".join(e + "I" * len(g) for (e, _, _), g in zip(edits, gaps[1:]))))
    return min(found)


FAULTS = st.sampled_from(["none", "none", "truncated", "blank", "duplicate"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suatx"), FAULTS), min_size=1, max_size=4))
def test_agenda_is_exhaustive_search(cells):
    steps = [[m[:4] for m in repair.summary(repair.row_deductions(cells), len(cells), [0])]]
    audits = sorted({m[4] for m in repair.summary(repair.row_deductions(cells), len(cells), [0])})
    cost, audit = repair.lightest((0, 0), repair.step_deductions(steps), (2, 0).__eq__)[2, 0]
    assert (cost, audits[ord(audit[0]) - ord("A")] + audit[1:]) == exhaustive(cells)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), FAULTS), min_size=1, max_size=30), st.integers(1, 5))
def test_chunks_derive_what_one_agenda_derives(cells, size):
    """Two levels of steps give the value of one agenda over all rows."""
    def goal(parts):
        found = [repair.summary(repair.row_deductions(c), len(c), range(4)) for c in parts]
        steps = [[m[:4] for m in f] for f in found]
        cost, audit = repair.lightest((0, 0), repair.step_deductions(steps), (len(steps) + 1, 0).__eq__)[len(steps) + 1, 0]
        words = [sorted({m[4] for m in f}) for f in found]
        return cost, "".join(w[ord(x) - ord("A")] for w, x in zip(words, audit)) + audit[len(steps):]
    assert goal([cells]) == goal([cells[i : i + size] for i in range(0, len(cells), size)])


def test_pops_never_decrease_and_stop_at_the_goal():
    cells = [("u", "none"), ("u", "truncated"), ("a", "blank"), ("s", "none"), ("a", "none")] * 20
    popped = []
    rules = repair.row_deductions(cells)
    final = repair.lightest((0, 0), rules, lambda item: popped.append(item) or item == (len(cells), 3))
    keys = [(final[i][0], i[0], final[i][1]) for i in popped]
    assert keys == sorted(keys) and popped[-1] == (len(cells), 3)
    assert len(popped) == len(set(popped)) <= 4 * (len(cells) + 1)


def expected(rows):
    """conv_id -> result row, from undamaged (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        blank = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        cells = plain_faults([r[1:] for r in rows])
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = lambda kind: sum(f == kind for _, f in cells)
        bad = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(cells, cells[1:]))
        cost, audit, lines = plain_repair([r[1:] for r in rows])
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), bad, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(repair.op12_repair(spark, SF)) == expected(rows)


ODD = [(1, None, "user", "Hello."), (1, None, "user", "Hello."), (1, 0, None, "Tied!"), (1, 0, "assistant", None), (2, 3, "", "No role."),
       (2, 7, "tool", "x" * 50_000 + "."), (2, 9, "assistant", "Far on"), (None, 1, "user", "null id?"), (None, 2, "assistant", "Yes."),
       (3, 1, "system", "Be kind."), (3, 2, "system", "Twice."), (3, 2, "system", "Twice."), (4, 1, "assistant", " \n\t "), (5, None, None, None),
       *[(6, t, "user" if t % 3 else "assistant", f"Turn {t}." if t % 5 else f"turn {t}") for t in range(40)]]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, "x", 1) for r in ODD]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cid string, seq int")


@pytest.mark.parametrize("size,fan", [(128, 64), (3, 2)])
def test_odd_rows(spark, odd, size, fan):
    """Nulls, ties, repeats, clashing columns; small chunks need several levels."""
    got = results(repair.report(odd, repair.Repaired(repair.damaged(odd), Scratch(spark, "t12"), size, fan)))
    assert got == expected(ODD)
    assert got[4][6] in ("", "D", "DD") and got[4][7] == hashlib.sha256(b"").hexdigest()


def test_repaired_lines_fit_the_grammar(spark, odd):
    lines = repair.Repaired(odd, Scratch(spark, "t12"), 4, 3).lines.collect()
    convs = {}
    for r in sorted(lines, key=lambda r: (r["cid"], r["at"], r["line"])):
        convs.setdefault(r["cid"], []).append(r["role"][0])
    assert convs and all(GRAMMAR.match("".join(v)) for v in convs.values())


def test_no_rows(spark, odd):
    none = odd.where("false")
    out = repair.report(none, repair.Repaired(repair.damaged(none), Scratch(spark, "t12")))
    assert out.count() == 0 and out.columns[0] == "conv_id"
    # all rows dropped: zeros, empty audit, hash of nothing
    gone = next((c, t) for c in range(100) for t in range(5) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(*gone, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    out = repair.report(one, repair.Repaired(repair.damaged(one), Scratch(spark, "t12")))
    assert [tuple(r) for r in out.collect()] == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
