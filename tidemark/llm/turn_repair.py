"""Conversation structure repair: the cheapest edits that give every conversation a legal order of turns.

A legal order is nothing, or an optional system turn followed by pairs of a user's and an assistant's turn. Rows may
be kept, given another role, deleted, and empty turns may be inserted, each at a price. Among the cheapest edits, those count
whose audit, the edits' initials in order, comes first by its characters.

The search goes row by row over the four states of the order (nothing yet, after system, after user, after assistant). Each
state keeps its best audit as a node: a letter linked to the node before. Audits share their beginnings, so a
step adds a few nodes and copies nothing. A node knows its ancestors at distances 1, 2, 4, ... and a rolling hash of its
audit. Audits of equal cost are compared at their first difference, found by lifting both while the hashes agree.
Equal hashes of different nodes are checked letter by letter, so a collision cannot change a result.

A digest of the repaired conversation goes along with each state, so texts are read once and never held. Letters that
all states share are settled from time to time and their nodes dropped. Rows come sorted to the task of their conversation;
which rows are repeated is found before, by role and text.

Defined cases: a role's initial is its first character; null roles and texts count as one space. Turns go by number, nulls first, then by
role and text. Repeated rows are duplicates. Rows with a null conversation id are one conversation. A conversation whose rows are all marked as
dropped has an empty repair. Empty tables give an empty result. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, small_batches, streamed_rows

#: Prices of the edits, and what a truncated row costs unless it is deleted.
RETITLE, DELETE, INSERT, TRUNCATED_TURN = 3, 4, 3, 3
FINE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: Steps after which letters shared by all states are settled.
SETTLE_EVERY = 2048

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The states that a turn with this initial may follow, and the state it leads to.
FOLLOWS = {"s": ((NOTHING,), SYSTEM), "u": ((NOTHING, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
#: The turn that may be inserted, or a row retitled to, in each state: its role and the state after it.
NEXT = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
LEGAL_PAIRS = frozenset({"su", "ua", "au"})

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


class Node:
    """The last letter of an audit; `up[i]` is the node 2^i letters before."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter: str, parent: Node | None):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * _BASE + ord(letter)) % _MODULUS
        up, i = [parent], 0
        while i < len(up[i].up):
            up.append(up[i].up[i])
            i += 1
        self.up = tuple(up)

    def lifted(self, steps: int) -> Node:
        node, i = self, 0
        while steps:
            if steps & 1:
                node = node.up[i]
            steps >>= 1
            i += 1
        return node

    def letters(self, root: Node) -> str:
        """The letters after the root, which is an ancestor."""
        found, node = [], self
        while node is not root:
            found.append(node.letter)
            node = node.up[0]
        return "".join(reversed(found))


def same_audit(a: Node, b: Node) -> bool:
    """Whether audits of equal length are equal. Nodes of unequal hash differ; nodes of equal hash are walked back together."""
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def first_difference(a: Node, b: Node) -> tuple[Node, Node] | None:
    """The nodes of the first letters that differ, of audits of equal length; none if they are equal."""
    if same_audit(a, b):
        return None
    for i in reversed(range(len(a.up))):
        if i < len(a.up) and i < len(b.up) and not same_audit(a.up[i], b.up[i]):
            a, b = a.up[i], b.up[i]
    return a, b


def before(a: Node, b: Node) -> bool:
    """Whether audit a comes before audit b; a beginning comes before the whole."""
    x, y = a.lifted(max(0, a.depth - b.depth)), b.lifted(max(0, b.depth - a.depth))
    differing = first_difference(x, y)
    if differing is None:
        return a.depth < b.depth
    return differing[0].letter < differing[1].letter


@dataclass(slots=True)
class Path:
    """The best way into a state: its cost, its audit, and the digest of the turns it leaves."""

    cost: int
    node: Node
    turns: int
    digest: object

    def with_turn(self, cost: int, letter: str, role: str, text: str) -> Path:
        digest = self.digest.copy()
        digest.update(f"{'\n' if self.turns else ''}{role}:{text}".encode())
        return Path(self.cost + cost, Node(letter, self.node), self.turns + 1, digest)

    def without(self, cost: int) -> Path:
        return Path(self.cost + cost, Node("D", self.node), self.turns, self.digest)


class Repair:
    """The search over one conversation."""

    def __init__(self):
        self.root = Node("", None)
        self.settled: list[str] = []
        self.best: list[Path | None] = [Path(0, self.root, 0, hashlib.sha256()), None, None, None]
        self.steps = 0
        self._insert()

    @staticmethod
    def _better(cost: int, letter: str, path: Path, held: tuple | None) -> bool:
        """Whether the way through `path` beats the held one, before either gets a node."""
        if held is None or cost != held[0]:
            return held is None or cost < held[0]
        return before(Node(letter, path.node), Node(held[1], held[2].node))

    def _insert(self) -> None:
        """Inserted turns lead from state to state; twice reaches every state, a third would only go round."""
        for _ in range(2):
            for state, path in enumerate(list(self.best)):
                if path is None:
                    continue
                role, to = NEXT[state]
                held = self.best[to]
                cost = path.cost + INSERT
                if held is None or cost < held.cost or cost == held.cost and before(Node("I", path.node), held.node):
                    self.best[to] = path.with_turn(INSERT, "I", role, "")

    def row(self, role: str, text: str, fault: int) -> None:
        extra = TRUNCATED_TURN if fault == TRUNCATED else 0
        chosen: list[tuple | None] = [None] * 4

        def offer(to: int, cost: int, letter: str, path: Path, title: str | None) -> None:
            if self._better(cost, letter, path, chosen[to]):
                chosen[to] = (cost, letter, path, title)

        for state, path in enumerate(self.best):
            if path is None:
                continue
            offer(state, path.cost + DELETE, "D", path, None)
            if fault in (BLANK, DUPLICATE):
                continue
            origins, to = FOLLOWS.get(role[:1], ((), 0))
            if state in origins:
                offer(to, path.cost + extra, "K", path, role)
            title, to = NEXT[state]
            offer(to, path.cost + RETITLE + extra, "R", path, title)
        fresh: list[Path | None] = [None] * 4
        for to, choice in enumerate(chosen):
            if choice:
                cost, letter, path, title = choice
                fresh[to] = path.without(DELETE) if title is None else path.with_turn(cost - path.cost, letter, title, text)
        self.best = fresh
        self._insert()
        self._prune()
        self.steps += 1
        if self.steps % SETTLE_EVERY == 0:
            self._settle()

    def _prune(self) -> None:
        """Drop states that cannot win. Whatever follows a system turn may follow an assistant's; whatever follows
        nothing may too, once a system turn kept first is deleted instead."""
        held = self.best[ASSISTANT].cost
        for state, more in ((SYSTEM, 0), (NOTHING, DELETE)):
            if self.best[state] is not None and self.best[state].cost > held + more:
                self.best[state] = None

    def _settle(self) -> None:
        """Move the root to the last node that all states share, and build the nodes after it anew."""
        live = [p for p in self.best if p is not None]
        depth = min(p.node.depth for p in live)
        nodes = [p.node.lifted(p.node.depth - depth) for p in live]

        def apart(found: list[Node]) -> bool:
            return any(n is not found[0] for n in found)

        if apart(nodes):
            for i in reversed(range(len(nodes[0].up))):
                if i < len(nodes[0].up) and apart(lifted := [n.up[i] for n in nodes]):
                    nodes = lifted
            nodes = [n.up[0] for n in nodes]
        shared = nodes[0]
        if shared is self.root:
            return
        self.settled.append(shared.letters(self.root))
        root = Node("", None)
        made = {id(shared): root}

        def rebuilt(node: Node) -> Node:
            path = []
            while id(node) not in made:
                path.append(node)
                node = node.up[0]
            fresh = made[id(node)]
            for old in reversed(path):
                fresh = made[id(old)] = Node(old.letter, fresh)
            return fresh

        for path in live:
            path.node = rebuilt(path.node)
        self.root = root

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the best repair."""
        ends = [p for p in (self.best[NOTHING], self.best[ASSISTANT]) if p is not None]
        best = ends[0]
        for path in ends[1:]:
            if path.cost < best.cost or path.cost == best.cost and before(path.node, best.node):
                best = path
        return best.cost, "".join(self.settled) + best.node.letters(self.root), best.digest.hexdigest()


def repaired(rows: Iterable[tuple[str, str, int]]) -> tuple[int, str, str]:
    """Cost, audit and digest for (role, text, fault) in order."""
    search = Repair()
    for role, text, fault in rows:
        search.row(role, text, fault)
    return search.result()


_RESULT = pa.schema(
    [("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_RESULTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _conversations(batches) -> Iterator[pa.RecordBatch]:
    def results():
        for conv_id, rows in groupby(streamed_rows(batches), key=lambda r: r[0]):
            search, faults, illegal, initial = Repair(), [0] * 4, 0, None
            low = high = last = None
            distinct = 0
            for _, turn, dropped, role, text, fault in rows:
                if dropped:
                    continue
                if turn is not None:
                    low, high = turn if low is None else low, turn
                    distinct += turn != last
                    last = turn
                faults[fault] += 1
                if initial is not None and initial + role[:1] not in LEGAL_PAIRS:
                    illegal += 1
                initial = role[:1]
                search.row(role, text, fault)
            gaps = 0 if low is None else high - low + 1 - distinct
            yield conv_id, gaps, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, *search.result()

    yield from arrow_batches(results(), _RESULT, lambda r: 64 + len(r[7]), 1 << 22)


def faults(rows: DataFrame) -> DataFrame:
    """The rows with `fault`, the first that holds: blank, a repetition of an earlier role and text, or truncated."""
    end = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    seen = F.row_number().over(earlier) > 1
    fault = F.when(end == "", BLANK).when(seen, DUPLICATE).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    return rows.withColumn("fault", fault)


def repair(rows: DataFrame, dropped: Column | None = None) -> DataFrame:
    """Figures, audit and digest of the repaired turns for every conversation in (conv_id, turn, role, text).

    Rows where `dropped` holds do not count, but their conversations appear in the result.
    """
    small_batches(rows.sparkSession)
    gone = F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))

    def filled(name: str) -> Column:
        return F.when(~F.col("dropped"), F.coalesce(F.col(name).cast("string"), F.lit(" "))).alias(name)

    made = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), gone.alias("dropped"), "role", "text")
    made = made.select("conv_id", "turn", "dropped", filled("role"), filled("text"))
    # A dropped row counts only for its conversation: one of them is enough.
    lost = made.where("dropped").select("conv_id").distinct()
    lost = lost.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(True).alias("dropped"), *[F.lit(None).cast("string").alias(c) for c in ("role", "text")], F.lit(FINE).alias("fault"))
    every = faults(made.where("not dropped")).unionByName(lost)
    ordered = every.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.select("conv_id", "turn", "dropped", "role", "text", "fault").mapInArrow(_conversations, _RESULTS)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of conversation and turn modulo 20, with `dropped`: 0 drops a row, 1 empties its text, 2
    takes full stops, exclamation and question marks out, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), case.alias("case"))
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("case") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("case") == 3, 2).otherwise(1)))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("case") == 0).alias("dropped"), copies.alias("copy")).drop("copy")
