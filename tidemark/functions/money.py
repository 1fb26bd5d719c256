"""Sums and means of two-decimal amounts that do not depend on row order.

Amounts are stored as doubles, so adding them directly gives a different last digit for each
partitioning. Every amount below 9e12 that is a whole number of cents is added as an integer instead. The
integer is split at bit 20 into two long sums. The low one stays in range for 8e12 rows per group; the
high one for 1e10 rows if all amounts are near 9e12, and for 9e15 / (largest amount) * 1e6 rows below that.
A decimal sum would be exact too, but costs roughly three times as much per row. Larger amounts and those
not in whole cents (or not finite) are added as doubles in a third sum, which is 0 otherwise; a
group with such amounts is exact to the last digits only, in an order that partitions decide.

The three sums can be added up again, so a total can be built in stages: per customer first, then
per city.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT_BITS = 20
_LOW_MASK = (1 << _SPLIT_BITS) - 1
_MAX_EXACT = 9e12
_SUFFIXES = ("__hi", "__lo", "__rest")


def cents(amount: Column) -> Column:
    return F.floor(amount * F.lit(100.0) + F.lit(0.5))


def sum_parts(amount: Column, name: str, weight: Column | None = None) -> list[Column]:
    """Aggregates that hold sum(amount * weight) in columns derived from `name`.

    All three are NULL for a group without a non-null amount, as sum() would be.
    """
    whole = cents(amount)
    exact = (F.abs(amount) < F.lit(_MAX_EXACT)) & (whole / F.lit(100.0) == amount)
    present = amount.isNotNull()
    zero = F.lit(0).cast("long")
    parts = (
        F.when(exact, F.shiftright(whole, _SPLIT_BITS)).when(present, zero),
        F.when(exact, whole.bitwiseAND(F.lit(_LOW_MASK).cast("long"))).when(present, zero),
        F.when(exact, F.lit(0.0)).when(present, amount),
    )
    if weight is not None:
        parts = tuple(part * weight for part in parts)
    return [F.sum(part).alias(name + suffix) for part, suffix in zip(parts, _SUFFIXES)]


def resum_parts(name: str) -> list[Column]:
    """Aggregates that add up the parts of already grouped rows."""
    return [F.sum(name + suffix).alias(name + suffix) for suffix in _SUFFIXES]


def part_columns(name: str) -> list[str]:
    return [name + suffix for suffix in _SUFFIXES]


def _cents_total(name: str) -> Column:
    high, low = F.col(name + "__hi").cast("double"), F.col(name + "__lo").cast("double")
    return high * F.lit(float(1 << _SPLIT_BITS)) + low


def total(name: str) -> Column:
    """The sum, rounded to two decimals."""
    rest = F.col(name + "__rest")
    whole = _cents_total(name) / F.lit(100.0)
    return F.when(rest == 0.0, whole).otherwise(F.round(whole + rest, 2))


def mean(name: str, count: Column) -> Column:
    """The sum divided by `count`, rounded half up to two decimals; NULL for a count of zero."""
    rest = F.col(name + "__rest")
    rows = F.nullif(count.cast("double"), F.lit(0.0))
    whole = _cents_total(name)
    return F.when(rest == 0.0, F.round(whole / rows) / F.lit(100.0)).otherwise(
        F.round((whole / F.lit(100.0) + rest) / rows, 2)
    )
