"""Lenient readings of JSON values (variants) as ids, amounts and timestamps.

Each function takes a variant column and gives NULL for what it cannot read. A missing field is a
SQL NULL, a JSON null is a variant null; callers that must tell them apart test isNull().
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import time

# Fixed patterns: the accepted spellings of numbers and times in text.
INTEGER_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"
NUMBER_TEXT = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?|nan)$"
ISO_TEXT = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?)?$"
)
_WEEK_DATE = r"^\d{4}-W(0[1-9]|[1-4]\d|5[0-3])-[1-7]([Tt ].*)?$"
PLAIN_TEXT = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:(?:\s+|[Tt])(\d{1,2}):(\d{1,2}):(\d{1,2}))?$"
EDGE_SPACE = r"^\s+|\s+$"


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _text(value: Column) -> Column:
    return F.regexp_replace(F.try_variant_get(value, "$", "string"), EDGE_SPACE, "")


def to_id(value: Column, bits: int = 64) -> Column:
    """Whole number: fractions are cut off, "7" is read, "7.9" is not, true is 1."""
    text = _text(value)
    spelled = F.when(_is_text(value) & text.rlike(INTEGER_TEXT), F.replace(text, F.lit("_"), F.lit("")))
    # The plain reading covers all but underscores and comes first, as telling kinds apart costs more.
    number = F.coalesce(F.try_variant_get(value, "$", "bigint"), spelled.try_cast("bigint"))
    if bits == 64:
        return number
    return F.when(number.between(-(1 << (bits - 1)), (1 << (bits - 1)) - 1), number)


def to_amount(value: Column) -> Column:
    """Double from a number, a boolean or numeric text (underscores between digits allowed)."""
    text = F.replace(_text(value), F.lit("_"), F.lit(""))
    parsed = F.when(text.rlike(NUMBER_TEXT), text).try_cast("double")
    return F.when(_is_text(value), parsed).otherwise(F.try_variant_get(value, "$", "double"))


def to_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def json_text(value: Column) -> Column:
    """The trimmed text of a JSON string; NULL for any other kind of value."""
    return F.when(_is_text(value), _text(value))


def whole_number(value: Column) -> Column:
    """The whole part of a JSON number; NULL for text.

    Text is kept away from the cast: a failing one throws and catches an exception per row.
    """
    return F.when(~_is_text(value), F.try_variant_get(value, "$", "bigint"))


def to_time(text: Column, number: Column) -> Column:
    """Timestamp from text or else from an epoch number; a zone offset in text is dropped.

    Takes what json_text() and whole_number() give. They belong in an earlier select: both are
    used several times here, and inlined the generated code outgrows what the JVM compiles.
    """
    return F.when(text.isNotNull(), text_to_time(text)).otherwise(epoch_to_time(number))


def epoch_to_time(number: Column) -> Column:
    """The unit follows from the number of digits: 18+ ns, 15+ us, 12+ ms, fewer s.

    Times before year 1 give NULL; no number of these sizes reaches beyond year 9999.
    """

    def scaled(per_second: int) -> Column:
        micros = number * F.lit(time.MICROS // per_second)
        return F.when(number >= F.lit(time.MIN_SECOND * per_second), micros)

    micros = (
        F.when(_at_least(number, 10**17), _whole_thousands(number))
        .when(_at_least(number, 10**14), scaled(time.MICROS))
        .when(_at_least(number, 10**11), scaled(1000))
        .otherwise(scaled(1))
    )
    return time.from_micros(micros)


def _at_least(number: Column, size: int) -> Column:
    # Not abs(): it fails on the smallest long.
    return (number >= F.lit(size)) | (number <= F.lit(-size))


def _whole_thousands(number: Column) -> Column:
    # Stays in integers: a quotient through a double would lose digits.
    return F.call_function("div", number, F.lit(1000).cast("long"))


def text_to_time(text: Column) -> Column:
    """ISO 8601 text, or else a plain date and time in the first 19 characters."""
    zoned = F.replace(_week_date(text), F.lit("Z"), F.lit("+00:00"))
    return F.coalesce(
        _rewritten(zoned, ISO_TEXT, "$1-$3-$4 $5:$7:$8.$9"),
        _rewritten(F.substring(text, 1, 19), PLAIN_TEXT, "$1-$2-$3 $4:$5:$6."),
    )


def _week_date(text: Column) -> Column:
    """The date in front of an ISO week date, YYYY-Www-D, as YYYY-MM-DD; other text unchanged."""
    year, week = F.substring(text, 1, 4).try_cast("int"), F.substring(text, 7, 2).try_cast("int")
    day = F.substring(text, 10, 1).try_cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always in week 1
    monday = F.date_sub(fourth, F.weekday(fourth))
    found = F.date_add(monday, (week - 1) * 7 + day - 1)
    # Week 53 exists where the year's last Thursday is in it.
    real = (week <= 52) | (F.year(F.date_add(monday, 52 * 7 + 3)) == year)
    shown = F.concat(F.date_format(found, "yyyy-MM-dd"), F.substring(text, 11, 1 << 20))
    return F.when(text.rlike(_WEEK_DATE), F.when(real, shown)).otherwise(text)


def _rewritten(text: Column, pattern: str, layout: str) -> Column:
    # The added alternative turns text that does not match into one that is no timestamp. Absent
    # parts leave gaps, for example "10::." for "10"; they become zeros.
    spelled = F.regexp_replace(text, f"(?s){pattern}|^.*$", layout)
    for gap, filled in ((" :", " 00:"), ("::", ":00:"), (":.", ":00.")):
        spelled = F.replace(spelled, F.lit(gap), F.lit(filled))
    return F.concat(spelled, F.lit("0")).try_cast("timestamp_ntz")
