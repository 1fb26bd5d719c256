"""Exact sums and means of amounts."""

from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import money


def summed(spark, values, weights=None):
    weights = weights or [1] * len(values)
    rows = [(float(v) if v is not None else None, w) for v, w in zip(values, weights)]
    frame = spark.createDataFrame(rows, "x double, w long").repartition(3)
    x = F.col("x")
    grouped = frame.agg(*money.sum_parts(x, "m", F.col("w")), F.sum(F.when(x.isNotNull(), F.col("w"))).alias("n"))
    return tuple(grouped.select(money.total("m"), money.mean("m", F.col("n"))).first())


@pytest.mark.parametrize("seed", range(3))
def test_against_decimals(spark, seed):
    rng = random.Random(seed)
    values = [rng.randrange(-10**9, 10**10) / 100 for _ in range(500)]
    weights = [rng.randrange(1, 9) for _ in values]
    exact = sum(Decimal(repr(v)) * w for v, w in zip(values, weights))
    mean = (exact / sum(weights)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert summed(spark, values, weights) == (float(exact), float(mean))


def test_empty_and_null_groups(spark):
    assert summed(spark, [None, None]) == (None, None)
    assert summed(spark, [None, 2.0]) == (2.0, 2.0)
    assert summed(spark, []) == (None, None)


def test_other_amounts_are_added_as_doubles(spark):
    assert summed(spark, [0.004] * 1000 + [1.25])[0] == 5.25
    assert summed(spark, [1e30, 1.0])[0] == 1e30
    assert summed(spark, [math.inf, 1.0])[0] == math.inf
    assert math.isnan(summed(spark, [math.nan, 1.0])[0])


def test_sums_beyond_a_long_of_cents(spark):
    # 4e12 * 1e5 lines are 4e19 cents, more than a long holds.
    assert summed(spark, [4e12], [10**5])[0] == 4e17


def test_parts_can_be_added_in_stages(spark):
    frame = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") / 100).alias("x"))
    once = frame.agg(*money.sum_parts(F.col("x"), "m"))
    twice = frame.groupBy("a").agg(*money.sum_parts(F.col("x"), "m")).agg(*money.resum_parts("m"))
    assert once.select(money.total("m")).first() == twice.select(money.total("m")).first()
