"""Shards of nearly equal size by longest-processing-time scheduling.

Rows with equal texts form a group that stays together. Groups, largest first, go to the least-loaded shard, which a
heap gives. Groups of one size are interchangeable, so the driver schedules the number of groups of
each size class: every size below 4096 is a class, above that 12 leading bits make one (under 100,000 classes for any corpus). The plan says which ranks
within a class go to which shard; groups are ranked on the executors. Classes of large groups are scheduled at their mean size; then the
loads they really make are added up, and the small groups, whose sizes are exact, are scheduled on top of these.

Defined cases: a null text has size 1, checksum 0 and a group of its own; an empty text likewise. Repeated rows are a
group. Null ids are ids like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, stored

LEADING_BITS = 12
ROWS_PER_PART = 100_000


def size_class(size: Column) -> Column:
    drop = F.greatest(F.length(F.bin(size)) - LEADING_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def schedule(classes: list[tuple[float, int]], shards: int, loads: list[float] | None = None) -> list[list[int]]:
    """Groups per shard for every (size, number of groups), given largest first, on top of the loads."""
    loads = [0.0] * shards if loads is None else list(loads)
    result = []
    for size, n in classes:
        given = [0] * shards
        if n > 2 * shards:
            # Most of a long run in one step: as many as every shard certainly gets.
            level = _level(loads, size, n - shards)
            for i, load in enumerate(loads):
                given[i] = max(0, int((level - load) // size))
        heap = [(load + g * size, i) for i, (load, g) in enumerate(zip(loads, given, strict=True))]
        heapq.heapify(heap)
        for _ in range(n - sum(given)):
            load, i = heap[0]
            given[i] += 1
            heapq.heapreplace(heap, (load + size, i))
        loads = [load + g * size for load, g in zip(loads, given, strict=True)]
        result.append(given)
    return result


def _level(loads: list[float], size: float, n: int) -> float:
    """A load up to which shards can be filled with at most n groups."""
    low, high = min(loads), max(loads) + size * (n + 1)
    for _ in range(100):
        middle = (low + high) / 2
        if sum(max(0, int((middle - load) // size)) for load in loads) <= n:
            low = middle
        else:
            high = middle
    return low


def _homes(groups: DataFrame, classes: list, shards: int, loads: list[float] | None) -> DataFrame:
    """print, group_size and shard of groups whose classes are given largest first."""
    planned = schedule([(r["bytes"] / r["n"], r["n"]) for r in classes], shards, loads)
    plan = groups.sparkSession.createDataFrame(
        [(r["class"], list(accumulate(given))) for r, given in zip(classes, planned, strict=True)], "class long, ends array<long>"
    )
    order = [F.desc("group_size"), F.col("print")]
    placed = ranked(groups, ["class"], order, F.xxhash64("print"), ROWS_PER_PART, "rank").join(plan, "class")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("rank"))).cast("int")
    return stored(placed.select("print", "group_size", shard.alias("shard")), "shard-homes")


def assign(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row."""
    whole = F.col(text).cast("string")
    size = F.coalesce(F.octet_length(whole), F.lit(0)).cast("long") + 1
    print_ = F.coalesce(F.unhex(F.sha2(whole, 256)), F.lit(b"null"))
    checksum = F.coalesce(F.crc32(whole), F.lit(0).cast("long"))
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), size.alias("size"), checksum.alias("text_crc32"), print_.alias("print")), "shard-rows")
    groups = rows.groupBy("print").agg(F.sum("size").alias("group_size"))
    groups = stored(groups.withColumn("class", size_class(F.col("group_size"))), "shard-groups")
    classes = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("group_size").alias("bytes")).orderBy(F.desc("class")).collect()
    exact = F.col("class") < 1 << LEADING_BITS
    large = _homes(groups.where(~exact), [r for r in classes if r["class"] >= 1 << LEADING_BITS], shards, None)
    loads = [0.0] * shards
    for r in large.groupBy("shard").agg(F.sum("group_size").alias("load")).collect():
        loads[r["shard"]] = float(r["load"])
    homes = large.unionByName(_homes(groups.where(exact), [r for r in classes if r["class"] < 1 << LEADING_BITS], shards, loads)).drop("group_size")
    housed = rows.join(homes, "print")
    slotted = ranked(housed, ["shard"], [F.col("doc_id"), F.col("print")], F.xxhash64("doc_id", "print"), ROWS_PER_PART, "slot")
    return slotted.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
