"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

A document's vector holds five transformed statistics: the root of the mean word length and the roots of
the shares of symbols, repeated lines, repeated words and capitals. For each (language, source), and for
each language, the minimum covariance determinant estimate is found by concentration steps: distances from
the present centre and covariance, then mean and covariance of the `SHARE` of documents that lie nearest. Steps
start from medians and from lower quartiles, each with the median deviations from them, and from mean and
covariance of all rows. A group's steps from a start end once its determinant falls no more; the least
determinant of all steps wins. A document whose squared Mahalanobis distance exceeds `cutoff` is rejected, also when junk
is up to almost half of its group, copies of one text or not.

Only DataFrame operations. Vectors are fixed-point integers, so all sums are exact and do not depend on
how rows are dealt. A concentration step is one aggregation: moments are summed per group and distance
class, the classes below the h-th document are added up, and of the class that holds it a share that makes
h documents. A group is never brought together.

Defined cases: null texts count as empty and fail the base rules. Null languages and sources are groups
like any other. Groups below `min_rows` are judged by their language; a language below that rejects
nothing. Repeated rows each count and get equal verdicts. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.statistics import COUNTS, text_statistics

DIMS = 5
#: Vectors are whole multiples of 1 / SCALE.
SCALE = 1024
#: Share of a group's documents that the estimate rests on. Junk stays out of it while the other documents
#: are more than this share: at one half, as much junk as any estimate can bear.
SHARE = 0.5
#: A start's steps go on while its determinant falls below this share of the one before. It has a lower bound, by
#: the floors, so steps end; as many as `MOST_STEPS` are an error, not a silent end.
FALLS, MOST_STEPS = 0.99, 200
#: Standard deviations below which differences mean nothing: without them, a source whose documents
#: have no repeats at all would reject the first that has one.
FLOORS = (0.15, 0.05, 0.13, 0.13, 0.1)
#: Distance classes per unit of the fourth root of a squared distance.
CLASSES = 64
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
_X = [f"x{i}" for i in range(DIMS)]
_SUMS = [f"s{i}" for i in range(DIMS)] + [f"q{i}{j}" for i, j in _PAIRS]


def chi_square_cdf(x: float, dof: int) -> float:
    """Share of a chi-square distribution below x, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = dof / 2, x / 2
    term = total = 1 / a
    for n in range(1, 500):
        term *= half / (a + n)
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi_square_quantile(share: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dof) < share else (low, middle)
    return low


#: A covariance of the nearest SHARE is too small by this factor, were the data normal.
CONSISTENCY = SHARE / chi_square_cdf(chi_square_quantile(SHARE, DIMS), DIMS + 2)
CUTOFF = chi_square_quantile(0.9999, DIMS)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def vectors(stats: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and x0 to x4 as long integers."""
    def share(part: str, whole: Column) -> Column:
        return F.floor(SCALE * F.sqrt(F.col(part) / F.greatest(whole, F.lit(1)))).cast("long")

    return stats.select(
        *keep,
        share("word_chars", F.col("n_words")).alias("x0"),
        share("n_symbols", F.col("word_chars")).alias("x1"),
        share("n_dup_lines", F.col("n_lines")).alias("x2"),
        share("n_repeat_words", F.col("n_words")).alias("x3"),
        share("n_upper", F.col("word_chars")).alias("x4"),
    )


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    sums = {f"s{i}": f"n * x{i}" for i in range(DIMS)} | {f"q{i}{j}": f"n * x{i} * x{j}" for i, j in _PAIRS}
    return rows.groupBy(*by).agg(F.sum("n").alias("n"), *[F.expr(f"sum({each}) AS {name}") for name, each in sums.items()])


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    """Centre m, inverse Cholesky factor w and root of the determinant of each group's covariance."""
    floors = {(i, i): FLOORS[i] ** 2 for i in range(DIMS)}
    return _factored(sums.selectExpr(
        "grp", "start",
        *[f"s{i} / n / {SCALE} AS m{i}" for i in range(DIMS)],
        *[
            f"{factor!r}D * (q{i}{j} / n - s{i} / n * (s{j} / n)) / {SCALE * SCALE} + {floors.get((i, j), 0.0)!r}D AS c{i}{j}"
            for i, j in _PAIRS
        ],
    ))


def _held(frame: DataFrame, keep: list[str], columns: dict[str, str]) -> DataFrame:
    """`bound` of SQL expressions: a step has hundreds, and as text they are sent to the engine in one call each."""
    fresh = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return frame.selectExpr(*keep, f"inline(array(struct({fresh})))")


def _dot(terms: Iterable[str]) -> str:
    return "(" + " + ".join(["0D", *terms]) + ")"


def _factored(cov: DataFrame) -> DataFrame:
    """Adds w, the inverse of the lower Cholesky factor, row by row, and det; drops c."""
    keys = ["grp", "start", *[f"m{i}" for i in range(DIMS)]]
    left = [f"c{i}{j}" for i, j in _PAIRS]
    done: list[str] = []
    frame = cov
    for j in range(DIMS):  # column j of the factor needs the columns before it
        square = _dot(f"l{j}{k} * l{j}{k}" for k in range(j))
        frame = _held(frame, [*keys, *left, *done], {f"l{j}{j}": f"sqrt(greatest(c{j}{j} - {square}, 1e-9D))"})
        done.append(f"l{j}{j}")
        below = {
            f"l{i}{j}": f"(c{i}{j} - {_dot(f'l{i}{k} * l{j}{k}' for k in range(j))}) / l{j}{j}" for i in range(j + 1, DIMS)
        }
        if below:
            frame = _held(frame, [*keys, *left, *done], below)
            done += below
    for i in range(DIMS):
        row = {f"w{i}{i}": f"1D / l{i}{i}"}
        for j in range(i):
            row[f"w{i}{j}"] = f"-{_dot(f'l{i}{k} * w{k}{j}' for k in range(j, i))} / l{i}{i}"
        frame = _held(frame, [*keys, *done], row)
        done += row
    det = " * ".join(f"l{i}{i}" for i in range(DIMS))
    return frame.selectExpr(*keys, *[f"w{i}{j}" for i, j in _PAIRS], f"{det} AS det")


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. from m0.. by w."""
    rows = [" + ".join(f"w{i}{j} * (x{j} / {SCALE} - m{j})" for j in range(i + 1)) for i in range(DIMS)]
    return F.expr(" + ".join(f"({r}) * ({r})" for r in rows))


def _starts(points: DataFrame) -> DataFrame:
    """Three first estimates per group: medians and lower quartiles, each with median deviations, and plain moments."""
    weights = F.col("n")
    shares = {0: 0.5, 2: 0.25}
    # Stored, its size is known: a small table of groups is sent to the points, so that no group meets in one task.
    middles = stored(points.groupBy("grp").agg(
        *[F.percentile(x, F.lit(share), weights).alias(f"a{start}{x}") for start, share in shares.items() for x in _X]
    ), "rules-middles")
    off = points.join(middles, "grp").select("grp", "n", *[
        F.abs(F.col(x) - F.col(f"a{start}{x}")).cast("long").alias(f"o{start}{x}") for start in shares for x in _X
    ])
    spread = off.groupBy("grp").agg(
        *[F.percentile(f"o{start}{x}", F.lit(0.5), weights).alias(f"d{start}{x}") for start in shares for x in _X]
    ).join(middles, "grp")
    each = [F.struct(
        F.lit(start).alias("start"), *[F.col(f"a{start}{x}").alias(f"a{x}") for x in _X], *[F.col(f"d{start}{x}").alias(f"d{x}") for x in _X]
    ) for start in shares]
    robust = _factored(spread.select("grp", F.inline(F.array(*each))).selectExpr(
        "grp", "start", *[f"a{x} / {SCALE} AS m{i}" for i, x in enumerate(_X)],
        *[
            f"pow(1.4826D * d{_X[i]} / {SCALE}, 2) + {FLOORS[i] ** 2!r}D AS c{i}{j}" if i == j else f"0D AS c{i}{j}"
            for i, j in _PAIRS
        ],
    ))
    plain = _estimate(_moments(points, ["grp"]).withColumn("start", F.lit(1)), 1.0)
    return robust.unionByName(plain)


def _concentrated(points: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: the moments of each group's nearest documents."""
    near = F.floor(CLASSES * F.sqrt(F.sqrt(distance()))).cast("long")
    classed = points.join(params, "grp").select("grp", "start", near.alias("near"), "n", *_X)
    classes = _moments(classed, ["grp", "start", "near"])
    whole = Window.partitionBy("grp", "start")
    before = whole.orderBy("near").rowsBetween(Window.unboundedPreceding, -1)
    held = classes.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("_all", F.sum("n").over(whole))
    left = F.ceil(SHARE * F.col("_all")) - F.col("_before")
    # Sums of whole classes are exact integers and one class per group is taken in part, so the order of rows has no influence.
    taken = held.withColumn("_left", left).where("_left > 0").groupBy("grp", "start").agg(
        F.expr("coalesce(max(CASE WHEN n > _left THEN _left / n END), 0D) AS _part"),
        *[
            F.expr(f"coalesce(sum(CASE WHEN n {sign} _left THEN {c} END), 0) AS {name}{c}")
            for name, sign in (("_full_", "<="), ("_some_", ">")) for c in ("n", *_SUMS)
        ],
    )
    return taken.selectExpr("grp", "start", *[f"_full_{c} + _part * _some_{c} AS {c}" for c in ("n", *_SUMS)])


def estimates(points: DataFrame) -> DataFrame:
    """The minimum covariance determinant estimate per group: grp, m0.., w00.., det.

    `points` has grp, x0 to x4 and n, the number of documents with that vector. Groups whose starts have come to
    rest take no further steps.
    """
    moving = stored(_starts(points), "rules-start").withColumn("last", F.lit(float("inf")))
    found = None
    for _ in range(MOST_STEPS):
        step = _estimate(_concentrated(points, moving), CONSISTENCY).join(moving.select("grp", "start", "last"), ["grp", "start"])
        step = stored(step, "rules-step")
        found = step if found is None else found.unionByName(step)
        moving = step.where(F.col("det") < FALLS * F.col("last")).withColumn("last", F.col("det"))
        if moving.isEmpty():
            break
    else:
        raise RuntimeError(f"concentration steps did not end after {MOST_STEPS}")
    columns = [c for c in found.columns if c not in ("grp", "last")]
    best = found.groupBy("grp").agg(F.min_by(F.struct(*columns), F.struct("det", "start", "last")).alias("_b"))
    return best.select("grp", *[F.col(f"_b.{c}").alias(c) for c in columns if c != "start"])


def _group(*names: str) -> Column:
    return F.to_json(F.struct(*[F.col(n) for n in names]))


def judge(
    docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source",
    cutoff: float = CUTOFF, min_rows: int = 50,
) -> DataFrame:
    """The kept columns, all counts, base_failed, distance2 (null: no estimate) and kept, per document."""
    kept = [f"_r{i}" for i in range(len(keep))]
    named = docs.select(
        *[F.col(k).alias(n) for k, n in zip(keep, kept, strict=True)],
        F.col(text).alias("_t"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
    )
    stats = stored(text_statistics(named, [*kept, "lang", "source"], "_t"), "rules-stats")
    rows = vectors(stats, [*kept, *COUNTS, "lang", "source"]).select(
        *kept, *COUNTS, *_X, _group("lang", "source").alias("fine"), _group("lang").alias("coarse")
    )
    # Equal vectors are added up first; most documents of a hot source share one with others.
    points = rows.groupBy("fine", "coarse", *_X).agg(F.count(F.lit(1)).alias("n"))
    both = points.select("n", *_X, F.explode(F.array(
        F.concat(F.lit("s"), "fine"), F.concat(F.lit("l"), "coarse"))).alias("grp"))
    grouped = stored(both.groupBy("grp", *_X).agg(F.sum("n").alias("n")), "rules-points")
    large = stored(grouped.groupBy("grp").agg(F.sum("n").alias("_n")).where(F.col("_n") >= min_rows).select("grp"), "rules-large")
    best = stored(estimates(grouped.join(large, "grp", "left_semi")), "rules-best")
    params = [c for c in best.columns if c != "grp"]

    def level(prefix: str, name: str) -> DataFrame:
        mine = best.where(F.col("grp").startswith(prefix))
        return mine.select(F.substring("grp", 2, 1 << 20).alias(name), F.struct(*params).alias(f"_{name}"))

    joined = rows.join(level("s", "fine"), "fine", "left").join(level("l", "coarse"), "coarse", "left")
    chosen = F.coalesce("_fine", "_coarse")
    flat = joined.select(*kept, *COUNTS, *_X, *[chosen[p].alias(p) for p in params])
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    judged = flat.select(*kept, *COUNTS, failed.alias("base_failed"), distance().alias("distance2"))
    return judged.select(
        *[F.col(n).alias(k) for k, n in zip(keep, kept, strict=True)], *COUNTS, "base_failed", "distance2",
        (~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(True))).alias("kept"),
    )
