"""Dense surrogate keys that continue an existing table, without a single-task window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

# monotonically_increasing_id(): partition number above this bit, row number in it below.
_ROW_BITS = 33


def next_key(table: DataFrame, key: str) -> DataFrame:
    """One row: the smallest unused number after the largest key, 1 for an empty table."""
    return table.agg((F.coalesce(F.max(key), F.lit(0)) + F.lit(1)).alias("next_key"))


def number_rows(rows: DataFrame, table: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Rows with `key` counting on from the largest one in `table`, in the given order.

    Rows are range-partitioned and numbered inside each partition. The checkpoint fixes which row
    is where; the partitions' first numbers are a small table, joined back.
    """
    checkpoint_root(rows.sparkSession)
    placed = (
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    start = next_key(table, key).first()["next_key"]
    firsts = accumulate((r["n"] for r in sizes), initial=start)
    known = rows.sparkSession.createDataFrame(
        [(r["_part"], first) for r, first in zip(sizes, firsts)], "_part long, _first long"
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("long"))
    return (
        placed.withColumn("_part", part)
        .join(known, "_part")
        .withColumn(key, F.col("_first") + within)
        .drop("_place", "_part", "_first")
    )
