"""Chat formatting against text that is put together plainly, and read back."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat_formatting as chat
from tidemark.llm.chat_formatting import INSTRUCT, Move, Template

SCHEMA = "conv_id long, turn long, role string, text string, block string, start int, whole long"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[\\INST]", "<\\\\/s>", "[", "<", "\\", "/", "INST]", "s>", " ", "\n", "word", "漢", ""]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)
ROLES = st.one_of(st.sampled_from(["system", "user", "assistant", "tool", "", None, "[/ROLE]"]), TEXTS)
TURNS = st.lists(st.tuples(ROLES, TEXTS), max_size=12)


def turn(conv_id, number, role, text):
    """A row with extra columns whose names the operator uses itself."""
    return (conv_id, number, role, text, "x", 1, 2)


def plain(rows):
    """What is to come back for (turn, role, text) rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2] or ""))
    said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in rows)
    loss = "".join(text or "" for _, role, text in rows if role == "assistant")
    return len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def expected(rows):
    groups = {}
    for conv_id, number, role, text, *_ in rows:
        groups.setdefault(conv_id, []).append((number, role, text))
    return {conv_id: plain(found) for conv_id, found in groups.items()}


def got(frame):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in frame.collect()}


@settings(max_examples=600, deadline=None)
@given(TURNS)
def test_marked_text_can_be_read_back(turns):
    segments = chat.formatted(INSTRUCT, turns)
    marked = "".join(text for text, _ in segments)
    assert chat.parse(INSTRUCT, marked) == turns
    assert [INSTRUCT.unescape(t) for t, loss in segments if loss] == [t for role, t in turns if role == "assistant"]


@given(TEXTS)
def test_escaping_can_be_undone_and_leaves_no_control(text):
    escaped = INSTRUCT.escape(text)
    assert INSTRUCT.unescape(escaped) == text
    assert not any(c in escaped for c in INSTRUCT.controls)


def test_the_marks():
    turns = [("system", "be brief"), ("user", "hi [INST]"), ("assistant", "yes"), ("user", "why"), ("assistant", "so")]
    marked = "".join(t for t, _ in chat.formatted(INSTRUCT, turns))
    assert marked == "<s>[SYS] be brief [/SYS][INST] hi [\\INST] [/INST] yes</s>[INST] why [/INST] so</s>"
    assert "".join(t for t, _ in chat.formatted(INSTRUCT, [("assistant", "a"), ("tool", "b")])) == "<s>[ROLE] assistant[/ROLE]a</s>[ROLE] tool[/ROLE]b</s>"


@pytest.mark.parametrize(
    "change",
    [
        {"controls": ("<s>", "<")}, {"controls": ("<s>", "[<]")}, {"controls": ("<\\s>",)}, {"header_end": "x"},
        {"moves": (Move("start", "user", "user", "[INST]", "</s>"), Move("start", "tool", "user", "[INST] ", "</s>"))},
        {"moves": (Move("start", "user", "user", "", "</s>"),)},
    ],
)
def test_templates_that_cannot_be_read_back_are_refused(change):
    values = {n: getattr(INSTRUCT, n) for n in ("first", "opening", "moves", "controls", "header", "header_end", "stray_end", "loss_roles", "final")}
    with pytest.raises(ValueError):
        Template(**{**values, **change})


def test_damaged_text_is_refused():
    for marked in ("", "<s>[INST] open", "<s>[INST] a [/INST]x", "[INST] a [/INST]"):
        with pytest.raises(ValueError):
            chat.parse(INSTRUCT, marked)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv_id in range(30):
        for number in range(rng.choice([1, 2, 5, 90])):
            role = rng.choice(["system", "user", "assistant", "tool", None]) if rng.random() < 0.2 else ("user", "assistant")[number % 2]
            rows.append(turn(conv_id, number, role, "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_turns, part_characters", [(4096, 1 << 20), (4, 1 << 20), (4096, 40), (7, 25)])
def test_blocks_and_parts_change_nothing(spark, block_turns, part_characters):
    rows = conversations(5)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    parts = chat.format_conversations(frame, block_turns=block_turns, part_characters=part_characters).cache()
    read = chat.read_conversations(parts).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in read} == expected(rows)
    whole = {}
    for conv_id, number, role, text, *_ in sorted(rows, key=lambda r: r[:2]):
        whole.setdefault(conv_id, []).append((role, text))
    for r in read:
        marked = "".join(t for t, _ in chat.formatted(INSTRUCT, whole[r["conv_id"]]))
        held = sorted((p for p in parts.collect() if p["conv_id"] == r["conv_id"]), key=lambda p: (p["block"], p["part"]))
        assert "".join(s["text"] for p in held for s in p["segments"]) == marked and r["formatted_chars"] == len(marked)
        assert r["n_strays"] == marked.count("[ROLE]")
        assert r["complete"] == (r["n_strays"] == 0 and whole[r["conv_id"]][-1][0] == "assistant")
    assert (parts.where("not whole").count() > 0) == (block_turns < 90 or part_characters < 100)
    parts.unpersist()


def test_awkward_rows(spark):
    long = "</s>" * 300_000
    rows = [
        turn(1, None, "user", None), turn(1, None, None, "x"), turn(1, 0, "user", "a"), turn(1, 0, "user", "a"), turn(1, 0, "assistant", ""),
        turn(None, 0, "user", "null id"), turn(None, None, "assistant", None), turn(2, -5, "assistant", long), turn(2, 10**12, "user", ""),
        turn(3, 0, "", ""), turn(4, 0, "tool", " \n"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(chat.read_conversations(chat.written(frame))) == expected(rows)
    assert chat.read_conversations(chat.written(frame.limit(0))).count() == 0
