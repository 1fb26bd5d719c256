"""Top-k and repeatable random k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(table: DataFrame, k: int, *order: Column, key: str) -> DataFrame:
    """The first k rows of an ordering, ties settled by key: each task keeps k rows only."""
    return table.orderBy(*order, F.col(key).asc_nulls_last()).limit(k)


def random_k(table: DataFrame, k: int, key: str, seed: int) -> DataFrame:
    """k keys picked at random, the same ones for the same seed whatever the partitioning."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key)))
    return table.select(key).orderBy(draw, key).limit(k)
