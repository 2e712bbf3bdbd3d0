"""Operator 12: conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is repaired by edits of its rows so that its role initials read
``(s?(ua)+)?``: nothing, or an optional system turn and pairs of user and
assistant.  The initials so far are one of four states, and an *item* (place,
state) is derivable in many ways: by deductions that keep, rerole or delete the
next row or insert one.  Deductions are weighted by (cost, audit), audit being
the initials of the edits (Keep, Rerole, Delete, Insert); an item's value is its
lightest derivation.  The agenda pops items by (cost, place, audit).  That is
monotone: a deduction either costs something or moves on, and audits of one
item and one cost never begin one another (inserts stand before a row, so an
audit ends with its last row), so appending keeps their order.  The first pop of
an item is therefore final, and the search ends when the goal is popped.

A conversation may hold any share of all rows.  Its rows are numbered over a
range sort and cut into chunks; an agenda for each entry state gives a chunk's
lightest derivations from every entry to every exit state.  Chunks are then
steps of the same agenda, whose deductions are those entry and exit states,
with the rank of the chunk's audit among its own as letter.  ``FAN`` chunks make
a larger step, until a conversation is one short list whose goal is derived; the
states chosen there go back down to the chunks, where rows are edited.

Edge cases: a null role or text is one space, a null ``conv_id`` is a
conversation of its own; null turns come first; rows of one turn are ordered by
role and a hash of the text, so repeated rows are next to each other and every one
but the first is a duplicate; an empty role has no initial and cannot stay as it is; a conversation
without rows left has no repaired rows; an empty table gives no rows; texts of
any length are hashed as a stream; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, groups_of, table
from .running import running

CHUNK, FAN = 128, 64
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
#: State 0: nothing yet; 1: after system; 2: a user waits for an answer; 3: answered.
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
#: The role an inserted or reroled row takes in a state.
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLES = {"u": "user", "a": "assistant"}
#: What ends a conversation in a state: inserts only.
TAIL = {0: "", 1: "II", 2: "I", 3: ""}
#: Neighbouring initials that need no repair.
LEGAL = ("su", "ua", "au")
GAP, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"

Item = tuple[int, int]
Deduction = tuple[int, int, int, str]


def lightest(start: Item, deductions: Callable[[int, int], Iterable[Deduction]], done: Callable[[Item], bool]) -> dict[Item, tuple[int, str]]:
    """Final values (cost, audit) of the items popped from the agenda, ``done`` (told of every pop) ends it.

    ``deductions(place, state)`` gives (place, state, cost, letters) of the
    items that follow from an item.
    """
    agenda, final = [(0, start[0], "", start[1])], {}
    while agenda:
        cost, place, audit, state = heapq.heappop(agenda)
        item = (place, state)
        if item in final:
            continue
        final[item] = (cost, audit)
        if done(item):
            break
        for to, other, more, letters in deductions(place, state):
            if (to, other) not in final:
                heapq.heappush(agenda, (cost + more, to, audit + letters, other))
    return final


def row_deductions(rows: list[tuple[str, str]]) -> Callable[[int, int], Iterable[Deduction]]:
    """Edits of ``rows`` (initial, fault); inserts stand before a row."""
    def of(place: int, state: int) -> Iterable[Deduction]:
        if place == len(rows):
            return
        initial, fault = rows[place]
        new = NEXT[state]
        yield place, MOVES[state][new], COSTS["I"], "I"
        yield place + 1, state, COSTS["D"], "D"
        if fault in ("blank", "duplicate"):
            return
        more = TRUNCATED if fault == "truncated" else 0
        if initial in MOVES[state]:
            yield place + 1, MOVES[state][initial], COSTS["K"] + more, "K"
        if initial != new:
            yield place + 1, MOVES[state][new], COSTS["R"] + more, "R"
    return of


def step_deductions(steps: list[list[tuple[int, int, int, str]]]) -> Callable[[int, int], Iterable[Deduction]]:
    """A step is a list of (entry, exit, cost, letter); after the last one the goal, one place on, in state 0."""
    def of(place: int, state: int) -> Iterable[Deduction]:
        if place < len(steps):
            yield from ((place + 1, q, cost, letter) for p, q, cost, letter in steps[place] if p == state)
        elif place == len(steps):
            yield place + 1, 0, COSTS["I"] * len(TAIL[state]), TAIL[state]
    return of


def summary(deductions, length: int, entries: Iterable[int]) -> list[tuple[int, int, int, str, str]]:
    """(entry, exit, cost, letter, audit) over all ``length`` places: the letter orders the audits."""
    found = []
    for p in entries:
        exits = set()

        def done(item, exits=exits):
            if item[0] == length:
                exits.add(item[1])
            return len(exits) == len(MOVES)
        final = lightest((0, p), deductions, done)
        found += [(p, q, *final[length, q]) for q in sorted(exits)]
    letters = {audit: chr(ord("A") + i) for i, audit in enumerate(sorted({f[3] for f in found}))}
    return [(p, q, cost, letters[audit], audit) for p, q, cost, audit in found]


MOVE = "array<struct<p:int,q:int,cost:long,letter:string>>"
LEVEL = f"cid string, at long, moves {MOVE}"


def _chunks(rows: DataFrame, size: int) -> DataFrame:
    """(cid, at, moves, audits, illegal, first, last): the chunks of ``rows`` (cid, seq, initial, fault)."""
    r = rows.select("cid", F.floor(F.col("seq") / size).alias("at"), "seq", "initial", "fault")
    r = r.repartition("cid", "at").sortWithinPartitions("cid", "at", "seq")

    def run(batches):
        out = []
        for pdf in groups_of(batches, ["cid", "at"]):
            initials, at = pdf["initial"].tolist(), int(pdf["at"].iloc[0])
            cells = list(zip(initials, pdf["fault"].tolist()))
            found = summary(row_deductions(cells), len(cells), [0] if at == 0 else sorted(MOVES))
            bad = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
            out.append((pdf["cid"].iloc[0], at, [{"p": p, "q": q, "cost": c, "letter": x} for p, q, c, x, _ in found],
                        sorted({f[4] for f in found}), bad, initials[0], initials[-1]))
            if len(out) == 512:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    names = ["cid", "at", "moves", "audits", "illegal", "first", "last"]
    return r.mapInPandas(run, f"{LEVEL}, audits array<string>, illegal long, first string, last string")


def legal(a: str, b: str) -> bool:
    return a + b in LEGAL


def _fan_in(level: DataFrame, fan: int) -> DataFrame:
    """``fan`` steps of a conversation as one; ``inner`` keeps the letters of each audit."""
    up = level.select("cid", F.floor(F.col("at") / fan).alias("over"), "at", "moves").repartition("cid", "over").sortWithinPartitions("cid", "over", "at")

    def run(batches):
        for pdf in groups_of(batches, ["cid", "over"]):
            steps = [_moves(m) for m in pdf["moves"]]
            over = int(pdf["over"].iloc[0])
            found = summary(step_deductions(steps), len(steps), [0] if over == 0 else sorted(MOVES))
            yield pd.DataFrame({"cid": pdf["cid"].iloc[:1].tolist(), "at": [over], "audits": [sorted({f[4] for f in found})],
                                "moves": [[{"p": p, "q": q, "cost": c, "letter": x} for p, q, c, x, _ in found]]})[["cid", "at", "moves", "audits"]]

    return up.mapInPandas(run, f"{LEVEL}, audits array<string>")


def _moves(cells) -> list[tuple[int, int, int, str]]:
    return [(int(m["p"]), int(m["q"]), int(m["cost"]), m["letter"]) for m in cells]


def _goals(level: DataFrame) -> DataFrame:
    """(cid, over, p, word, tail, cost): each conversation's goal, from at most a fan of steps."""
    top = level.select("cid", "at", "moves").repartition("cid").sortWithinPartitions("cid", "at")

    def run(batches):
        out = []
        for pdf in groups_of(batches, ["cid"]):
            steps = [_moves(m) for m in pdf["moves"]]
            goal = (len(steps) + 1, 0)
            cost, audit = lightest((0, 0), step_deductions(steps), goal.__eq__)[goal]
            out.append((pdf["cid"].iloc[0], 0, 0, audit[: len(steps)], audit[len(steps):], cost))
            if len(out) == 4096:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    names = ["cid", "over", "p", "word", "tail", "cost"]
    return top.mapInPandas(run, "cid string, over long, p int, word string, tail string, cost long")


def _descend(choices: DataFrame, level: DataFrame, fan: int | None) -> DataFrame:
    """(cid, at, p, word, tail): entry state and audit of every step below ``choices`` (all steps of a conversation if ``fan`` is None)."""
    over = F.lit(0).cast("long") if fan is None else F.floor(F.col("at") / fan)
    chosen = choices.select("cid", "over", "p", "word", "tail")
    below = level.select("cid", over.alias("over"), "at", "moves", "audits").join(chosen, ["cid", "over"])
    below = below.repartition("cid", "over").sortWithinPartitions("cid", "over", "at")

    def run(batches):
        out = []
        for pdf in groups_of(batches, ["cid", "over"]):
            state, word, last = int(pdf["p"].iloc[0]), pdf["word"].iloc[0], len(pdf) - 1
            for i, (cid, at, moves, audits, tail) in enumerate(zip(pdf["cid"], pdf["at"], pdf["moves"], pdf["audits"], pdf["tail"])):
                out.append((cid, int(at), state, audits[ord(word[i]) - ord("A")], tail if i == last else ""))
                # an entry state and an audit lead to one exit: every edit's effect follows from the state
                state = next(q for p, q, _, x in _moves(moves) if p == state and x == word[i])
            if len(out) >= 4096:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    names = ["cid", "at", "p", "word", "tail"]
    return below.mapInPandas(run, "cid string, at long, p int, word string, tail string")


def _edited(rows: DataFrame, plan: DataFrame, size: int) -> DataFrame:
    """(cid, at, line, edit, role, text): rows that stay or come in, in order; a chunk's plan travels ahead of its rows."""
    ahead = plan.select("cid", "at", F.lit(-1).cast("long").alias("seq"), F.lit("").alias("role"), F.concat("word", "tail").alias("text"), "p")
    both = rows.select("cid", F.floor(F.col("seq") / size).alias("at"), "seq", "role", "text", F.lit(0).alias("p")).unionByName(ahead)
    both = both.repartition("cid", "at").sortWithinPartitions("cid", "at", "seq")

    def run(batches):
        state, line, edits = 0, 0, []  # of the chunk at hand, which may run over several batches
        for pdf in batches:
            out = []
            for cid, at, seq, role, text, p in zip(*(pdf[c] for c in ("cid", "at", "seq", "role", "text", "p"))):
                if seq < 0:
                    # a row's edits end at its own letter; what follows the last row goes with it
                    state, line, edits = int(p), 0, re.findall("I*[DKR](?:I+$)?", text)[::-1]
                    continue
                for edit in edits.pop():
                    if edit == "D":
                        continue
                    initial = role[0] if edit == "K" else NEXT[state]
                    state = MOVES[state][initial]
                    out.append((cid, at, line, edit, role if edit == "K" else ROLES[initial], "" if edit == "I" else text))
                    line += 1
            yield pd.DataFrame(out, columns=names)

    names = ["cid", "at", "line", "edit", "role", "text"]
    return both.mapInPandas(run, "cid string, at long, line long, edit string, role string, text string")


class Repaired:
    """The tables of a repair, all keyed by ``cid`` (a conversation's id as text, 'n' for null, 'c' before others).

    ``rows`` (cid, seq, turn, role, text, fault), ``plan`` (cid, at, p, word,
    tail: a chunk's audit), ``lines`` (cid, at, line, edit, role, text: the
    repaired conversation) and ``verdicts`` (cid, cost, illegal).
    """

    def __init__(self, turns: DataFrame, scratch: Scratch, size: int = CHUNK, fan: int = FAN):
        self.rows = scratch.save(faults(numbered(turns, scratch), scratch), "rows")
        chunks = scratch.save(_chunks(self.rows, size), "chunks")
        levels = [chunks]
        while (levels[-1].agg(F.max("at")).first()[0] or 0) >= fan:
            levels.append(scratch.save(_fan_in(levels[-1], fan), f"level-{len(levels)}"))
        goals = scratch.save(_goals(levels[-1]), "goals")
        plan = _descend(goals, levels[-1], None)
        for level in reversed(levels[:-1]):
            plan = _descend(scratch.save(plan, f"choices-{len(levels)}-{levels.index(level)}").withColumnRenamed("at", "over"), level, fan)
        self.plan = scratch.save(plan, "plan")
        self.lines = _edited(self.rows, self.plan, size)
        before = F.lag("last").over(Window.partitionBy("cid").orderBy("at"))  # a row for every chunk
        joints = chunks.withColumn("joint", F.concat(before, "first"))
        bad = F.col("illegal") + F.when(F.col("joint").isin(*LEGAL), 0).when(F.col("at") > 0, 1).otherwise(0)
        illegal = joints.groupBy("cid").agg(F.sum(bad).alias("illegal"))
        self.verdicts = goals.select("cid", "cost").join(illegal, "cid")


def conversation(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit("n"))


def numbered(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(cid, turn, role, text, print, seq) of ``turns`` (conv_id, turn, role, text): seq counts a conversation's rows from 0."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    t = turns.select(conversation(F.col("conv_id")).alias("cid"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"), F.md5(text).alias("print"),
                     F.monotonically_increasing_id().alias("mid"))  # parts equal rows
    return running(t, ["cid"], ["turn", "role", "print", "mid"], {"seq": F.lit(1)}, scratch, "numbered").drop("mid")


def faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``initial`` and the first ``fault`` of each: blank, duplicate, truncated or none."""
    same = ["cid", "role", "print"]
    again = rows.groupBy(*same).agg(F.min("seq").alias("first_seq"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = scratch.save(again, "again")
    fault = (F.when(~F.col("text").rlike(WORD), "blank").when(F.col("seq") > F.col("first_seq"), "duplicate")
             .when(~F.col("text").rlike(rf"[.!?]{GAP}*\z"), "truncated").otherwise("none"))
    return (rows.join(again, same, "left").withColumns({"fault": fault, "initial": F.substring("role", 1, 1)}).drop("first_seq", "print"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults planted by a checksum of conversation and turn."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(F.col("conv_id")), F.lit(":"), blank(F.col("turn")))) % 20
    role, text = blank(F.col("role")), blank(F.col("text"))
    return (turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                         F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), kind.alias("kind"))
            .where("kind <> 0").withColumn("copy", F.explode(F.expr("sequence(1, if(kind = 3, 2, 1))"))).drop("kind", "copy"))


def digests(lines: DataFrame) -> DataFrame:
    """(cid, repaired_sha256): sha256 of each conversation's ``role:text`` lines, read as a stream."""
    ordered = lines.select("cid", "at", "line", "role", "text").repartition("cid").sortWithinPartitions("cid", "at", "line")

    def run(batches):
        cid, h = None, None
        for pdf in batches:
            out = []
            for c, role, text in zip(pdf["cid"], pdf["role"], pdf["text"]):
                if c != cid:
                    if h is not None:
                        out.append((cid, h.hexdigest()))
                    cid, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            yield pd.DataFrame(out, columns=["cid", "repaired_sha256"])
        if h is not None:
            yield pd.DataFrame([(cid, h.hexdigest())], columns=["cid", "repaired_sha256"])

    return ordered.mapInPandas(run, "cid string, repaired_sha256 string")


def report(turns: DataFrame, repaired: Repaired) -> DataFrame:
    """One row for every conversation of ``turns``: its gaps, faults, cost, audit and digest."""
    number = lambda kind: F.sum((F.col("fault") == kind).cast("long")).alias(kind)
    wide = lambda c: c.cast("decimal(38,0)")
    per_turn = repaired.rows.groupBy("cid", "turn").agg(*[number(k) for k in ("blank", "duplicate", "truncated")])
    counts = per_turn.groupBy("cid").agg(
        (wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count("turn")).cast("long").alias("gaps"),
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    audits = repaired.plan.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("at", F.concat("word", "tail").alias("audit")))).alias("audits"))
    audits = audits.select("cid", F.array_join("audits.audit", "").alias("audit"))
    ids = turns.select("conv_id").distinct().withColumn("cid", conversation(F.col("conv_id")))
    out = ids
    for part in (counts, repaired.verdicts, audits, digests(repaired.lines)):
        out = out.join(part, "cid", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a fixed rule and repaired."""
    turns = table(spark, sf_dir, "conversations")
    return report(turns, Repaired(damaged(turns), Scratch(spark, "op12")))


#: An agenda of derivations has no SQL form; the tests hold it against an exhaustive search.
ORACLE: dict[str, str] = {}
QUERIES = {"op12_repair": op12_repair}
