"""Best-fit packing of token pieces into sequences of at most `most` tokens.

Lengths are whole numbers up to `most`, so the packing problem is the number of pieces of each length, which is
all that reaches the driver: `most` rows at any size of corpus. There, sets that provably
dominate all alternatives are fixed first (Martello and Toth): a piece nothing fits beside; a piece and
its exact complement; a piece with the one or two others that no feasible set can better. Then the
remainder is packed best fit, longest first. Both work on whole groups of equal pieces. The plan says which
ranks of each length go to which sequences; pieces are ranked within their length on the executors, so
a third of all rows having one length is dealt over many tasks.

Defined cases: a null text is empty and has only the end id. Repeated rows are packed each. Null ids are ids like any other. An
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, small_batches, stored
from tidemark.llm.tokenising import ID, encoder

ROWS_PER_PART = 200_000
Pattern = tuple[tuple[int, ...], int]


def _cut(path: str, end_id: int, most: int, with_ids: bool):
    end = np.array([end_id], dtype=ID).tobytes()
    step = most * ID.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(path).encode_all
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for number, ids in enumerate(encode_all(text or "" for text in batch.column("text").to_pylist())):
                ids += end
                cuts = [0, *range(len(ids) % step or step, len(ids) + 1, step)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[a:b]
                    held = (number, piece, a // ID.itemsize, len(part) // ID.itemsize, zlib.crc32(part), part)
                    for column, value in zip(rows, held, strict=True):
                        column.append(value)
            columns = [batch.column("doc_id").take(pa.array(rows[0], pa.int64()))]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns += [pa.array(values, kind) for values, kind in zip(rows[1:], kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(columns if with_ids else columns[:-1], names=names if with_ids else names[:-1])

    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int, most: int, with_ids: bool = False) -> DataFrame:
    """One row per piece of (doc_id, text): only documents longer than `most` are cut, into pieces of
    `most` tokens after a first one that may be shorter."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_cut(tokenizer, end_id, most, with_ids), schema)


def _companions(size: int, held: list[int], counts: Counter, most: int) -> tuple[int, ...] | None:
    """Companions of a piece of `size` that dominate every other feasible set, None if there are none
    such. `held` are the lengths left, ascending, one piece of `size` being taken out of counts."""
    room = most - size
    fitting = [s for s in held[: bisect_right(held, room)] if counts[s]]
    if not fitting:
        return ()
    best = fitting[-1]
    if best == room:
        return (best,)
    smallest: list[int] = []
    for s in fitting[:3]:
        smallest += [s] * min(counts[s], 3)
    if sum(smallest[:2]) > room or len(smallest) < 2:
        return (best,)
    if len(smallest) >= 3 and sum(smallest[:3]) <= room:
        return None
    # At most two companions fit. For each greater one the largest lesser one is enough to look at.
    pairs = []
    for x in fitting:
        y = bisect_right(fitting, min(x, room - x)) - 1
        if y >= 0 and fitting[y] == x and counts[x] < 2:
            y -= 1
        if y >= 0:
            pairs.append((x, fitting[y]))
    if all(x + y <= best for x, y in pairs):
        return (best,)
    lesser = max((y for x, y in pairs if x == best), default=None)
    if lesser is not None and all(y <= lesser or x + y <= best for x, y in pairs):
        return (best, lesser)
    return None


def reduced(counts: Counter, most: int) -> tuple[list[Pattern], Counter]:
    """Sequences fixed by dominance, and what is left."""
    left, fixed = Counter({s: n for s, n in counts.items() if n}), []
    again = True
    while again:
        again = False
        for size in sorted(left, reverse=True):
            while left[size]:
                left[size] -= 1
                held = sorted(s for s in left if left[s])
                found = _companions(size, held, left, most)
                left[size] += 1
                if found is None:
                    break
                need = Counter((size, *found))
                times = min(left[s] // n for s, n in need.items())
                for s, n in need.items():
                    left[s] -= n * times
                fixed.append(((size, *found), times))
                again = True
        left = +left
    return fixed, left


def best_fit(counts: Counter, most: int) -> list[Pattern]:
    """Longest first, each into the fullest sequence that has room; equal sequences move together."""
    rooms: dict[int, list[list]] = defaultdict(list)
    for size in sorted(counts, reverse=True):
        n = counts[size]
        for room in sorted(r for r in rooms if r >= size):
            groups, rooms[room] = rooms[room], []
            for pattern, times in groups:
                each = room // size
                full = min(times, n // each)
                if full:
                    rooms[room - each * size].append([pattern + (size,) * each, full])
                    n, times = n - full * each, times - full
                if times and 0 < n < each:
                    rooms[room - n * size].append([pattern + (size,) * n, 1])
                    n, times = 0, times - 1
                if times:
                    rooms[room].append([pattern, times])
            if not n:
                break
        each = most // size
        if n // each:
            rooms[most - each * size].append([(size,) * each, n // each])
        if n % each:
            rooms[most - n % each * size].append([(size,) * (n % each), 1])
    return [(tuple(pattern), times) for groups in rooms.values() for pattern, times in groups]


def plan(counts: Counter, most: int) -> list[Pattern]:
    """(lengths in a sequence, number of such sequences) for all pieces."""
    fixed, left = reduced(counts, most)
    return fixed + best_fit(left, most)


def _placed(patterns: list[Pattern]):
    """Looks up (sequence, offset) by length and rank within the length."""
    used: Counter = Counter()
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for size in pattern:
            slots[size].append((used[size], sequence, offset))
            used[size] += times
            offset += size
        sequence += times
    tables = {size: np.array(rows, dtype=np.int64).T for size, rows in slots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for size in np.unique(lengths):
                rows = np.flatnonzero(lengths == size)
                first, begin, offset = tables[int(size)]
                at = np.searchsorted(first, ranks[rows], "right") - 1
                sequences[rows] = begin[at] + ranks[rows] - first[at]
                offsets[rows] = offset[at]
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(sequences), pa.array(offsets)], names=[*kept, "sequence_id", "offset"]
            )

    return run


def pack(cut: DataFrame, most: int) -> DataFrame:
    """The pieces (without ids) with sequence_id and offset."""
    slim = stored(cut.drop("ids"), "pack-pieces")
    counts = Counter({r["length"]: r["n"] for r in slim.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()})
    order = [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")]
    rows = ranked(slim, ["length"], order, F.xxhash64("doc_id", "piece", "ids_crc32"), ROWS_PER_PART, "rank")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(plan(counts, most)), schema)


def sequences(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from pieces with ids and their places; a group holds `most` tokens at most."""
    keys = ["doc_id", "piece", "ids_crc32"]
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    once = cut.select(*keys, "ids").dropDuplicates(keys)
    joined = once.alias("c").join(packed.alias("p"), same[0] & same[1] & same[2]).select("sequence_id", "offset", "ids")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")
    )
