"""Repairs against all edits of short conversations, and against whole audits kept as strings."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import turn_repair
from tidemark.llm.turn_repair import BLANK, DUPLICATE, FINE, TRUNCATED

SCHEMA = "conv_id long, turn long, role string, text string, fault string, dropped int, case string, copy int"
LEGAL = re.compile("(s?(ua)+)?")
ROLES = ["system", "user", "assistant", "tool", "", "s", "agent"]


def digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def every_repair(rows):
    """All edits with up to two inserted turns at each place, by trying everything."""
    inserts = [(3 * len(w), "I" * len(w), [(r, "") for r in w]) for n in range(3) for w in itertools.product(["user", "assistant"], repeat=n)]
    found = list(inserts)
    for role, text, fault in rows:
        extra = 3 if fault == TRUNCATED else 0
        edits = [(4, "D", [])]
        if fault not in (BLANK, DUPLICATE):
            edits += [(extra, "K", [(role, text)])] + [(3 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        found = [(c + d + e, a + b + i, t + u + v) for c, a, t in found for d, b, u in edits for e, i, v in inserts]
    legal = [f for f in found if LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in f[2]))]
    cost, audit, turns = min(legal, key=lambda f: f[:2])
    return cost, audit, digest(turns)


def with_strings(rows):
    """One best audit per state as a whole string."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    def better(held, state, option):
        if state not in held or option[:2] < held[state][:2]:
            held[state] = option

    def inserted(held):
        for _ in range(3):
            for state, (cost, audit, turns) in list(held.items()):
                for initial, to in moves[state].items():
                    if initial in names:
                        better(held, to, (cost + 3, audit + "I", [*turns, (names[initial], "")]))
        return held

    best = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        extra, fresh = (3 if fault == TRUNCATED else 0), {}
        for state, (cost, audit, turns) in best.items():
            better(fresh, state, (cost + 4, audit + "D", turns))
            if fault in (BLANK, DUPLICATE):
                continue
            if role[:1] in moves[state]:
                better(fresh, moves[state][role[:1]], (cost + extra, audit + "K", [*turns, (role, text)]))
            for initial, to in moves[state].items():
                if initial in names:
                    better(fresh, to, (cost + 3 + extra, audit + "R", [*turns, (names[initial], text)]))
        best = inserted(fresh)
    cost, audit, turns = min((best[s] for s in ("", "a") if s in best), key=lambda f: f[:2])
    return cost, audit, digest(turns)


def random_rows(rng, n):
    return [(rng.choice(ROLES), f"t{i}", rng.choice([FINE, FINE, FINE, BLANK, DUPLICATE, TRUNCATED])) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_all_edits_of_short_conversations(n):
    rng = random.Random(n)
    for _ in range(25 if n == 3 else 150):
        rows = random_rows(rng, n)
        assert turn_repair.repaired(rows) == every_repair(rows) == with_strings(rows), rows


@pytest.mark.parametrize("settle, modulus", [(2048, None), (1, None), (3, None), (5, 3), (2048, 2), (2048, 7)])
def test_longer_conversations(monkeypatch, settle, modulus):
    """Also when letters are settled all the time, and when nearly all hashes collide."""
    monkeypatch.setattr(turn_repair, "SETTLE_EVERY", settle)
    if modulus:
        monkeypatch.setattr(turn_repair, "_MODULUS", modulus)
    rng = random.Random(settle)
    for n in [*range(4, 40), 300]:
        kinds = rng.choice([ROLES, ["user"], ["assistant", "user"], ["system", "user"], ["assistant"]])
        rows = [(rng.choice(kinds), f"t{i}", rng.choice([FINE, FINE, FINE, FINE, TRUNCATED, BLANK])) for i in range(n)]
        assert turn_repair.repaired(rows) == with_strings(rows), rows


def test_settled_letters_leave_few_nodes(monkeypatch):
    monkeypatch.setattr(turn_repair, "SETTLE_EVERY", 16)
    search = turn_repair.Repair()
    for i in range(2000):
        search.row(("user", "assistant")[i % 2], "x", FINE)
    assert max(p.node.depth for p in search.best if p) < 40
    assert search.result()[1] == "K" * 2000


def plain(rows):
    """The whole query in plain Python: damage, faults, counts and repair."""
    groups = {}
    for conv_id, number, role, text, *_ in rows:
        shown = [" " if v is None else str(v) for v in (conv_id, number)]
        case = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        kept = groups.setdefault(conv_id, [])
        if case:
            kept += [(number, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    out = {}
    for conv_id, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in kept:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = BLANK if not solid else DUPLICATE if (role, text) in seen else TRUNCATED if solid[-1] not in ".!?" else FINE
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {n for n, _, _ in kept if n is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [sum(f == k for _, _, f in marked) for k in (BLANK, DUPLICATE, TRUNCATED)]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        out[conv_id] = (gaps, *counts, illegal, *with_strings(marked))
    return out


def got(frame):
    return {r["conv_id"]: tuple(r)[1:] for r in frame.collect()}


def repaired(frame):
    return got(turn_repair.repair(turn_repair.damaged(frame.select("conv_id", "turn", "role", "text")), F.col("dropped")))


def test_the_query_on_the_table(spark, folder):
    frame = spark.read.parquet(f"{folder}/conversations.parquet")
    assert repaired(frame) == plain([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def turn(conv_id, number, role, text):
    return (conv_id, number, role, text, "x", 1, "y", 2)


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = [
        turn(1, None, "user", None), turn(1, None, None, "x."), turn(1, 0, "user", "a"), turn(1, 0, "user", "a"), turn(1, 5, "", ""),
        turn(None, 0, "user", "null id."), turn(None, None, "assistant", None), turn(2, -5, "assistant", "x" * 500_000 + ". \n"), turn(2, 10**12, "user", " \x0b"),
        turn(3, None, "assistant", "."), turn(4, 0, "user", "　"), turn(5, 0, "user", " end!　"),
    ]
    rows += [turn(100 + i % 60, rng.choice([None, *range(40)]), rng.choice([*ROLES, None]), rng.choice(["a.", "b", " ", "c!", "", None, "d?\n"])) for i in range(900)]
    rows += [turn(500, n, "user", "once.") for n in range(300)]  # a third of all rows says the same
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert repaired(frame) == plain(rows)
    assert turn_repair.repair(turn_repair.damaged(frame.limit(0)), F.col("dropped")).count() == 0


def test_conversations_without_rows_after_damage(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([turn(lost, 0, "user", "gone")], SCHEMA)
    assert repaired(frame) == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    kept = turn_repair.repair(frame.select("conv_id", "turn", "role", "text")).collect()
    assert kept[0]["audit"] == "D"
