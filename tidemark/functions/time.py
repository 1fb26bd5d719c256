"""Zone-free timestamp helpers: none of them reads the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
# Fixed value: first second of year 1.
MIN_SECOND = -62_135_596_800


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def from_millis(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, _epoch())


def to_micros(ts: Column) -> Column:
    # timestampdiff() would go through the zoned type; a difference of zone-free times does not.
    seconds = (ts - _epoch()).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(MICROS)).cast("long")


def to_millis(ts: Column) -> Column:
    micros = to_micros(ts)
    return F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))


def day_start(ts: Column) -> Column:
    # date_trunc() would go through the zoned type and so depend on the session zone.
    return F.to_date(ts).cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return day_start(ts) + F.make_dt_interval(F.lit(0), F.hour(ts))


def plus_minutes(ts: Column, minutes: Column | int) -> Column:
    minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def now() -> Column:
    """Current UTC wall clock without a zone."""
    return from_micros(F.unix_micros(F.current_timestamp()))
