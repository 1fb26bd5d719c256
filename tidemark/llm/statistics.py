"""Counts over whole texts, from built-in functions only and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bind, bound, squeezed, words

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]+"
#: Words in a window that is looked for twice in a text.
WINDOW = 5

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_upper", "n_marks", "n_digits",
]


def _without(pattern: str) -> Column:
    return F.length(F.regexp_replace("_text", pattern, ""))


def _windows(hashes: Column) -> Column:
    """One hash for every window of words, in order of position."""
    whole = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
    return F.transform(whole, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + n) for n in range(1, WINDOW)]))


def _repeated(windows: Column) -> Column:
    """Positions of the windows that occur twice or more, ascending."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(ordered: Column) -> Column:
        def same(i: Column, step: int) -> Column:
            return F.coalesce(F.get(ordered, i + step)["h"] == F.get(ordered, i)["h"], F.lit(False))

        return F.transform(F.filter(ordered, lambda _, i: same(i, 1) | same(i, -1)), lambda w: w["i"])

    return F.sort_array(bind(placed, twice))


def _covered(starts: Column) -> Column:
    """Words inside at least one of the windows that begin at the ascending positions."""
    steps = F.transform(
        starts,
        lambda s, i: F.when(i == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), s - F.get(starts, i - 1))),
    )
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def _repeat_words(windows: Column) -> Column:
    """Most texts repeat no window; only the others are sorted."""
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        bind(_repeated(windows), _covered)
    )


def text_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the counts of each row's whole text; a null text counts as empty.

    A text's words and windows are arrays inside its row, so nothing is shuffled, and the largest
    thing held is one text. Arrays pass through generators, which keeps the optimizer from copying
    their expressions into every use.
    """
    kept = [f"_k{i}" for i in range(len(keep))]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, kept, strict=True)], whole.alias("_text"))
    length = F.length("_text")
    counted = bound(
        rows, kept,
        _hashes=F.transform(words(F.col("_text")), lambda w: F.xxhash64(w)),
        _lines=F.filter(F.split("_text", "\n"), lambda line: F.length(squeezed(line)) > 0),
        word_chars=F.length(squeezed(F.col("_text"))).cast("long"),
        n_symbols=(length - _without(SYMBOLS)).cast("long"),
        n_upper=(length - _without(r"\p{Lu}+")).cast("long"),
        n_marks=(length - _without("[!?]+")).cast("long"),
        n_digits=(length - _without("[0-9]+")).cast("long"),
    )
    plain = ["word_chars", "n_symbols", "n_upper", "n_marks", "n_digits"]
    done = bound(
        counted, [*kept, *plain],
        n_words=F.size("_hashes").cast("long"),
        n_distinct_words=F.size(F.array_distinct("_hashes")).cast("long"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        n_repeat_words=bind(_windows(F.col("_hashes")), _repeat_words).cast("long"),
    )
    return done.select(*[F.col(n).alias(k) for k, n in zip(keep, kept, strict=True)], *COUNTS)
