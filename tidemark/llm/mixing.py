"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: how often the mix takes it. Of all rates that give each source its target
of tokens and stay at `most` or below, those nearest to 1 in relative entropy are min(most, exp(l * size)), with one multiplier l per source:
the dual problem, convex in l, whose gradient is the source's tokens at these rates less its target. Newton
steps with a bracket solve it, one aggregation per step over all sources at once. Documents of a source that have one
size have one rate, so steps run over (source, size) classes. Rates then become whole copies: each class
takes the whole part, and the parts of a copy are carried from the larger sizes to the smaller; some classes then give or take one copy
to bring the source nearer to its target.

Only DataFrame operations. The one window without a key runs over the table of sources.

Defined cases: a null source is a source, the last in order. Null and empty texts have size 0 and are taken
0 times. Sources without words get a target of 0. Repeated rows each have copies. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, stored, words

#: Rates are whole multiples of 1 / SCALE, so that sums of them are exact.
SCALE = 1_000_000
NEWTON_STEPS = 40
#: Newton steps end when every source is this near to its target.
NEAR = 1e-9
REPAIRS = 3
ROWS_PER_PART = 200_000


def _key(source: str) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Adds target to (key, source, source_size): `share` of all sizes by weight, at most `most` times
    the source's size, the excess going to the others by weight.

    Sources stop in order of (limit / weight), so the final level is found by sums in that order.
    """
    whole = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(whole) - 1, F.lit(len(weights))))
    weighed = sources.withColumn("weight", weight).withColumn("most", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = weighed.withColumn("level", level).withColumn("place", F.row_number().over(order))
    open_place = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct("place", "level"))
    final = F.min(open_place).over(Window.partitionBy())["level"]
    return leveled.select("key", "source", "source_size", "most", F.least("most", F.col("weight") * F.coalesce(final, F.lit(float("inf")))).alias("target"))


def _newton(classes: DataFrame, most: float) -> DataFrame:
    """key and the multiplier of each source whose target lies below its limit."""
    spark = classes.sparkSession
    state = stored(
        classes.select("key").distinct().select("key", F.lit(0.0).alias("l"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(False).alias("done")),
        "mix-state",
    )
    rate = F.least(F.lit(most), F.exp(F.col("l") * F.col("x")))
    for _ in range(NEWTON_STEPS):
        mass = F.col("n") * F.col("size") * rate
        summed = classes.join(state, "key").groupBy("key", "l", "low", "high", "target").agg(
            F.sum(mass).alias("f"), F.sum(F.when(rate < most, mass * F.col("x"))).alias("slope")
        )
        over = F.col("f") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("l")), F.when(over, F.col("l")).otherwise(F.col("high"))
        step = F.col("l") + (F.col("target") - F.col("f")) / F.col("slope")
        wide = F.col("l") + F.when(over, -1.0).otherwise(1.0) * F.greatest(F.lit(1.0), F.abs(F.col("l")))
        inside = (F.col("low").isNull() | (step > F.col("low"))) & (F.col("high").isNull() | (step < F.col("high"))) & (F.abs(step - F.col("l")) <= F.abs(wide - F.col("l")))
        middle = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2).otherwise(wide)
        done = F.abs(F.col("f") - F.col("target")) <= NEAR * F.col("target")
        bracketed = summed.select("key", "l", "f", "slope", "target", low.alias("low"), high.alias("high"))
        moved = bracketed.select("key", F.when(done, F.col("l")).when(F.coalesce(inside, F.lit(False)), step).otherwise(middle).alias("l"), "low", "high", done.alias("done"))
        state = stored(moved, "mix-state")
        if state.where("not done").isEmpty():
            break
    return state.select("key", F.round("l", 9).alias("l"))


def _repaired(classes: DataFrame) -> DataFrame:
    """One class per source gives up or takes one copy where that brings the source nearer."""
    size, extra, n = F.col("size"), F.col("extra"), F.col("n")
    by_key = Window.partitionBy("key")
    missing = F.col("target") - F.sum((n * F.col("whole") + extra) * size).over(by_key)
    known = classes.withColumn("_missing", missing)
    able = F.when(F.col("_missing") > 0, F.col("room") > extra).otherwise(extra > 0)
    after = F.abs(F.abs("_missing") - size)
    gain = F.when(able & (after < F.abs("_missing")), F.struct(after.alias("after"), size.alias("size")))
    best = known.withColumn("_best", F.min(gain).over(by_key)["size"])
    step = F.when(F.col("_best") == size, F.signum("_missing").cast("long")).otherwise(F.lit(0))
    return best.withColumn("extra", extra + step).drop("_missing", "_best")


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, keep: list[str] | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken and the columns to keep for every row."""
    keep = keep or []
    size = F.size(words(F.coalesce(F.col(text).cast("string"), F.lit("")))).cast("long")
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), _key(source).alias("key"), size.alias("size"), *[F.col(k).alias(f"_r{i}") for i, k in enumerate(keep)]), "mix-sizes")
    classes = sized.groupBy("key", "size").agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("n"))
    per_source = classes.groupBy("key").agg(
        F.first("source").alias("source"), F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs"))
    aimed = stored(targets(per_source.drop("n_docs"), weights, share, most), "mix-targets")
    known = stored(
        classes.where("size > 0").select("key", "size", "n").join(aimed.drop("source"), "key").join(per_source.select("key", "n_docs"), "key")
        .withColumn("x", F.col("size") * F.col("n_docs") / F.col("source_size")), "mix-classes",
    )
    multipliers = _newton(known.where("target > 0 and target < most"), float(most))
    rate = F.when(F.col("target") >= F.col("most"), F.lit(float(most))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(
        F.least(F.lit(float(most)), F.exp(F.col("l") * F.col("x"))))
    rated = known.join(multipliers, "key", "left").withColumn("rate", F.round(rate * SCALE).cast("long"))
    down = Window.partitionBy("key").orderBy(F.desc("size"))
    part = F.col("n") * (F.col("rate") % SCALE)
    carried = rated.withColumn("_upto", F.sum(part).over(down)).withColumn("_part", part)
    def half_up(c: Column) -> Column:
        return F.floor((c + SCALE // 2) / SCALE).cast("long")
    copied = carried.select(
        "key", "size", "n", "target", F.floor(F.col("rate") / SCALE).cast("long").alias("whole"),
        (half_up(F.col("_upto")) - half_up(F.col("_upto") - F.col("_part"))).alias("extra"),
    ).withColumn("room", F.when(F.col("whole") < most, F.col("n")).otherwise(F.lit(0)).cast("long"))
    for _ in range(REPAIRS):
        copied = _repaired(copied)
    copied = stored(copied.select("key", "size", "whole", "extra"), "mix-copies")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    rows = ranked(sized, ["key", "size"], order, F.xxhash64("doc_id", F.lit(1)), ROWS_PER_PART, "rank")
    copies = F.coalesce(F.col("whole") + F.when(F.col("rank") < F.col("extra"), 1).otherwise(0), F.lit(0)).cast("long")
    return rows.join(copied, ["key", "size"], "left").join(aimed.select("key", "source_size", "target"), "key").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
        *[F.col(f"_r{i}").alias(k) for i, k in enumerate(keep)])
