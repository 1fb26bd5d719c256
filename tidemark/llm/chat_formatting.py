"""Chat formatting: a finite-state machine over roles turns conversations into marked text with loss flags.

A template declares the moves of the machine. Each turn takes the move that its role has in the present state,
or the template's stray move if there is none: then the turn is out of order, is counted, and is written under a
header with its role's name. So every turn is kept. A move writes its marks and the text as segments, and says
which segment counts in the loss.

Control strings inside texts are escaped by a backslash after their first character, next to any backslashes
that stand there already. That can be undone exactly, so `parse` gets roles and texts back from the marked text.

A conversation is written in parts: rows of at most about PART_CHARACTERS, cut between turns. Long conversations are
dealt over blocks of turns, which are formatted apart: what a block does to the machine is a small table from
state to state, and these tables, one after another, give the state in which each block begins.

Defined cases: null texts are empty texts; a null role is a stray one without a name. Turns go by number, nulls first, then by
role and text. Repeated rows are turns like any other. Rows with a null conversation id are one conversation. Empty
tables give an empty result. Other columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, small_batches, stored, streamed_rows

#: Turns of one block, by number, and characters after which a part ends with its turn.
BLOCK_TURNS = 4096
PART_CHARACTERS = 1 << 20


@dataclass(frozen=True)
class Move:
    """From a state, a role leads to another state; the text stands between two marks."""

    state: str
    role: str
    to: str
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """The machine: its first state, its moves, and the control strings that texts must not hold.

    A stray turn is written as `header`, the role, `header_end`, the text and `stray_end`; it leads to the state
    named in `after_stray`, or to the role's name. `final` are the states in which a conversation is complete.
    """

    first: str
    opening: str
    moves: tuple[Move, ...]
    controls: tuple[str, ...]
    header: str
    header_end: str
    stray_end: str
    loss_roles: frozenset[str]
    final: frozenset[str]
    after_stray: str = "stray"
    escaped: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        for c in self.controls:
            if len(c) < 2 or "\\" in c or any(c[0] in other[1:] for other in self.controls):
                raise ValueError(f"control string {c!r}: first characters stand only in front, without backslashes")
            if any(other != c and other.startswith(c) for other in self.controls):
                raise ValueError(f"control string {c!r} begins another")
        for move in self.moves:
            rivals = [m.before for m in self.moves if m.state == move.state and m is not move] + [self.header]
            if not move.before or any(r.startswith(move.before) or move.before.startswith(r) for r in rivals):
                raise ValueError(f"marks of state {move.state!r} cannot be told apart")
        for mark in [*(m.after for m in self.moves), self.header_end, self.stray_end]:
            if not any(c in mark for c in self.controls):
                raise ValueError(f"mark {mark!r} holds no control string")
        forms = "|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in self.controls)
        object.__setattr__(self, "escaped", re.compile(forms))

    @property
    def states(self) -> list[str]:
        named = [self.first, *(m.state for m in self.moves), *(m.to for m in self.moves), self.after_stray]
        return list(dict.fromkeys(named))

    def machine(self) -> dict[tuple[str, str | None], Move]:
        return {(m.state, m.role): m for m in self.moves}

    def next_state(self, state: str, role: str | None) -> str:
        move = self.machine().get((state, role))
        return move.to if move else self._stray_to(role)

    def _stray_to(self, role: str | None) -> str:
        return role if role in {m.to for m in self.moves} else self.after_stray

    def escape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


#: The instruction template: `[INST]` and `[/INST]` around the user's text, `</s>` after the assistant's.
INSTRUCT = Template(
    first="start",
    opening="<s>",
    moves=(
        Move("start", "system", "system", "[SYS] ", " [/SYS]"),
        Move("start", "user", "user", "[INST] ", " [/INST]"),
        Move("system", "user", "user", "[INST] ", " [/INST]"),
        Move("user", "assistant", "assistant", " ", "</s>", loss=True),
        Move("assistant", "user", "user", "[INST] ", " [/INST]"),
    ),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]"),
    header="[ROLE]",
    header_end="[/ROLE]",
    stray_end="</s>",
    loss_roles=frozenset({"assistant"}),
    final=frozenset({"assistant"}),
)

Segment = tuple[str, bool]


class Formatter:
    """The machine at work on one conversation."""

    def __init__(self, template: Template, state: str | None = None):
        self.template, self.state = template, template.first if state is None else state
        self.moves, self.strays = template.machine(), 0

    def turn(self, role: str | None, text: str) -> list[Segment]:
        """The segments of the next turn."""
        template = self.template
        move = self.moves.get((self.state, role))
        if move:
            before, after, loss, self.state = move.before, move.after, move.loss, move.to
        else:
            # A space sets a role without letters apart from no role.
            name = "" if role is None else " " + template.escape(role)
            before, after = template.header + name + template.header_end, template.stray_end
            loss, self.state = role in template.loss_roles, template._stray_to(role)
            self.strays += 1
        return [(before, False), (template.escape(text), loss), (after, False)]


class Parser:
    """Reads marked text turn by turn; parts of one conversation may follow one another."""

    def __init__(self, template: Template):
        self.template, self.state, self.opened = template, template.first, False
        self.by_state: dict[str, list[Move]] = {}
        for move in template.moves:
            self.by_state.setdefault(move.state, []).append(move)
        self.control = re.compile("|".join(map(re.escape, template.controls)))

    def turns(self, marked: str) -> Iterator[tuple[str | None, str]]:
        """(role, text) of each turn in a part."""
        template, at = self.template, 0
        if not self.opened:
            at = self._past(marked, template.opening, 0)
            self.opened = True
        while at < len(marked):
            move = next((m for m in self.by_state.get(self.state, []) if marked.startswith(m.before, at)), None)
            if move:
                role, at, after, self.state = move.role, at + len(move.before), move.after, move.to
            else:
                at = self._past(marked, template.header, at)
                name, at = self._until(marked, at, template.header_end)
                role = template.unescape(name[1:]) if name else None
                after, self.state = template.stray_end, template._stray_to(role)
            text, at = self._until(marked, at, after)
            yield role, template.unescape(text)

    @staticmethod
    def _past(marked: str, mark: str, at: int) -> int:
        if not marked.startswith(mark, at):
            raise ValueError(f"no {mark!r} at character {at}")
        return at + len(mark)

    def _until(self, marked: str, at: int, mark: str) -> tuple[str, int]:
        """The text up to a mark, whose control string is the next in the marked text, and the place after the mark."""
        found = self.control.search(marked, at)
        lead = self.control.search(mark).start()
        if found is None or found.start() - lead < at:
            raise ValueError(f"no {mark!r} after character {at}")
        end = found.start() - lead
        return marked[at:end], self._past(marked, mark, end)


def formatted(template: Template, turns: Iterable[tuple[str | None, str | None]]) -> list[Segment]:
    """All segments of one conversation."""
    machine = Formatter(template)
    found = [(template.opening, False)]
    for role, text in turns:
        found += machine.turn(role, text or "")
    return found


def parse(template: Template, marked: str) -> list[tuple[str | None, str]]:
    return list(Parser(template).turns(marked))


_PART = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("whole", pa.bool_()), ("turns", pa.int64()),
        ("strays", pa.int64()), ("state", pa.string()),
        ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
    ]
)
_PARTS = "conv_id long, block long, part int, whole boolean, turns long, strays long, state string, segments array<struct<text: string, loss: boolean>>"


def _written(template: Template, part_characters: int):
    """From rows in order to parts. `start` is null where the conversation is one block."""

    def parts(rows):
        for (conv_id, block), turns in groupby(rows, key=lambda r: r[:2]):
            machine, part, held, chars, n, alone = None, 0, [], 0, 0, True
            for _, _, start, first, role, text in turns:
                if machine is None:
                    machine, alone = Formatter(template, start), start is None
                    if first:
                        held.append((template.opening, False))
                elif chars >= part_characters:
                    yield conv_id, block, part, False, n, machine.strays, machine.state, held
                    part, held, chars, n, machine.strays = part + 1, [], 0, 0, 0
                found = machine.turn(role, text)
                chars += sum(len(t) for t, _ in found)
                held += found
                n += 1
            yield conv_id, block, part, alone and part == 0, n, machine.strays, machine.state, held

    def run(batches):
        made = ((*row, [{"text": t, "loss": x} for t, x in held]) for *row, held in parts(streamed_rows(batches)))
        yield from arrow_batches(made, _PART, lambda r: 1 + sum(len(s["text"]) for s in r[7]), 4 * PART_CHARACTERS)

    return run


def _block_tables(template: Template):
    """For every block the state it ends in, by the state it begins in."""
    states = template.states
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("ends", pa.list_(pa.string()))])

    def run(batches):
        step = {}

        def tables():
            for (conv_id, block), rows in groupby(streamed_rows(batches), key=lambda r: r[:2]):
                ends = states
                for _, _, role in rows:
                    if role not in step:
                        if len(step) > 10_000:
                            step.clear()
                        step[role] = {s: template.next_state(s, role) for s in states}
                    ends = [step[role][e] for e in ends]
                yield conv_id, block, ends

        yield from arrow_batches(tables(), schema)

    return run, "conv_id long, block long, ends array<string>"


def _block_starts(template: Template):
    """The state in which every block begins, blocks of a conversation coming in order."""
    place = {s: i for i, s in enumerate(template.states)}
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("start", pa.string()), ("first", pa.bool_())])

    def run(batches):
        def starts():
            for conv_id, blocks in groupby(streamed_rows(batches), key=lambda r: r[0]):
                state, first = template.first, True
                for _, block, ends in blocks:
                    yield conv_id, block, state, first
                    state, first = ends[place[state]], False

        yield from arrow_batches(starts(), schema)

    return run, "conv_id long, block long, start string, first boolean"


def format_conversations(
    rows: DataFrame, template: Template = INSTRUCT, block_turns: int = BLOCK_TURNS, part_characters: int = PART_CHARACTERS
) -> DataFrame:
    """The marked parts of all conversations: conv_id, block, part, whole, turns, strays, state, segments.

    Parts of a conversation go by block (nulls first) and part; `whole` marks the only part of a conversation, `state` is the
    machine's state after the part, and the segments' texts one after another are the marked text.
    """
    small_batches(rows.sparkSession)
    block = F.floor(F.col("turn") / F.lit(block_turns))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), block.cast("long").alias("block"), F.col("turn").alias("turn"), "role",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # Conversations of several blocks; null turns are a block of their own.
    sizes = turns.groupBy("conv_id").agg(F.min("block").alias("low"), F.max("block").alias("high"), F.count("block").alias("known"), F.count(F.lit(1)).alias("all"))
    several = sizes.where("low < high or (known > 0 and known < all)").select(F.col("conv_id").alias("long_id"))
    if several.isEmpty():
        placed = turns.select("*", F.lit(None).cast("string").alias("start"), F.lit(True).alias("first"))
    else:
        run, schema = _block_tables(template)
        roles = turns.join(several, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi").select("conv_id", "block", "turn", "role")
        roles = roles.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role")
        tables = roles.select("conv_id", "block", "role").mapInArrow(run, schema)
        run, schema = _block_starts(template)
        starts = tables.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, schema)
        starts = starts.select(*[F.col(c).alias(f"_{c}") for c in starts.columns])
        same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("block").eqNullSafe(F.col("_block"))
        placed = turns.join(starts, same, "left").select(*turns.columns, F.col("_start").alias("start"), F.coalesce("_first", F.lit(True)).alias("first"))
    ordered = placed.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    return ordered.select("conv_id", "block", "start", "first", "role", "text").mapInArrow(_written(template, part_characters), _PARTS)


def _read(template: Template):
    """One row per conversation from its parts in order."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_strays", pa.int64()), ("complete", pa.bool_()),
        ]
    )

    def run(batches):
        def digests():
            for conv_id, parts in groupby(streamed_rows(batches), key=lambda r: r[0]):
                parser, turns, loss = Parser(template), hashlib.sha256(), hashlib.sha256()
                n, loss_chars, chars, strays, state = 0, 0, 0, 0, template.first
                for _, part_strays, state, segments in parts:
                    for role, text in parser.turns("".join(s["text"] for s in segments)):
                        turns.update(f"{role or ''}\n{text}\n".encode())
                        n += 1
                    for segment in segments:
                        chars += len(segment["text"])
                        if segment["loss"]:
                            text = template.unescape(segment["text"])
                            loss_chars += len(text)
                            loss.update(text.encode())
                    strays += part_strays
                yield conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, strays, not strays and state in template.final

        yield from arrow_batches(digests(), schema)

    return run, (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_strays long, complete boolean"
    )


def read_conversations(parts: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What the parts hold, read back from their marked text, one row per conversation.

    Only conversations in several parts are brought together; a digest over a whole conversation goes through one task,
    part by part.
    """
    small_batches(parts.sparkSession)
    run, schema = _read(template)
    columns = ["conv_id", "strays", "state", "segments"]
    alone = parts.where("whole").select(columns).mapInArrow(run, schema)
    split = parts.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")
    return alone.unionByName(split.select(columns).mapInArrow(run, schema))


def written(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """The parts, written to the shared folder and read from there."""
    return stored(format_conversations(rows, template), "chat")
