"""Target-distribution importance resampling: documents drawn by how much their words look like a target's.

Words, or runs of up to `size` words, fall into buckets by checksum. A bucket's gain is the log ratio of its shares in the target
and in the documents, and a document's weight the sum of its features' gains, looked up in one array of gains. Random noise that
depends on the id alone turns taking the highest scores into drawing without replacement in proportion to the weights.

The cutoff is found without sorting the scores: a quantile sketch gives a bracket that should hold it, exact
counts of the scores above and inside say whether it does, and the bracket is widened until they do. Only the
bracket is sorted. Drawn documents are ranked within ranges of scores, after the exact counts of the
ranges before.

Defined cases: null and empty texts have no features and weight 0. A null id counts as an empty text in the noise and comes last among
ties. Repeated rows are documents of their own; their order among each other is open, and does not show. An empty target or empty
documents count as no features at all. Empty tables give an empty result. Other columns take no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, stored

#: Word characters are digits, small letters and all that is not ASCII; A-Z count as a-z.
_KEPT = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_BYTES = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Features whose bucket a worker keeps; then the store starts anew.
MOST_FEATURES = 500_000
#: Relative rank error of the sketch is 1 / ACCURACY; the bracket begins at so many errors on each side.
ACCURACY, ERRORS, WIDER = 10_000, 2, 8
#: Rows of a range that one task sorts, about.
PART_ROWS = 1 << 18


def words(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


class _Buckets(dict):
    """The bucket of a feature, kept between documents."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MOST_FEATURES:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def _features(found: list[bytes], size: int) -> list[bytes]:
    runs = found
    for n in range(2, size + 1):
        runs = runs + [b" ".join(found[i : i + n]) for i in range(len(found) - n + 1)]
    return runs


def _encoded(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The texts of a batch as bytes; null is empty."""
    for value in batch.column(name).cast(pa.large_binary()):
        yield value.as_py() or b""


def bucket_counts(texts: DataFrame, buckets: int, size: int) -> list[int]:
    """Features per bucket over all rows of (text): one array per task, added up by bucket."""

    def run(batches):
        known, totals = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _encoded(batch, "text"):
                found = _features(words(text), size)
                if found:
                    totals += np.bincount(np.fromiter(map(known.__getitem__, found), np.int64, len(found)), minlength=buckets)
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int32()), "n": pa.array(totals[held])})

    found = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = [0] * buckets
    for row in found:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(documents: list[int], target: list[int]) -> list[int]:
    """floor(1000 * ln(target share / document share)) per bucket, each bucket's counts raised by one."""
    n, all_documents, all_target = len(documents), sum(documents), sum(target)
    return [math.floor(1000 * math.log((t + 1) * (all_documents + n) / ((s + 1) * (all_target + n)))) for s, t in zip(documents, target, strict=True)]


def weighted(docs: DataFrame, gain: list[int], size: int, keep: list[str]) -> DataFrame:
    """The kept columns with n_words, n_features and weight of every document."""
    fields = [docs.schema[c] for c in keep]
    added = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    array = np.array(gain, np.int64)

    def run(batches):
        known = _Buckets(len(array))
        for batch in batches:
            counts = []
            for text in _encoded(batch, "text"):
                cut = words(text)
                found = _features(cut, size)
                places = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
                counts.append((len(cut), len(found), int(array[places].sum())))
            columns = np.array(counts, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(columns[:, i]) for i in range(3)]], names=[*keep, *[f.name for f in added]]
            )

    return docs.select(*keep, "text").mapInArrow(run, T.StructType([*fields, *added]))


def noise(doc_id: Column, seed: str) -> Column:
    """floor(-1000 * ln(-ln(u))) with u from the digest of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def bracket(scored: DataFrame, score: str, rows: int, wanted: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, above): the score of the row at place `wanted` from the top lies between low and high, and exactly `above` rows
    score higher than high. Needs 0 < wanted <= rows."""
    reach = ERRORS / accuracy
    place = 1 - wanted / rows
    while True:
        low, high = max(0.0, place - reach), min(1.0, place + reach)
        marks = scored.agg(F.percentile_approx(score, [low, high], accuracy).alias("q"), F.min(score).alias("least"), F.max(score).alias("most")).first()
        # The ends of the sketch are replaced by the true ends.
        low_score = marks["least"] if low <= 0 else marks["q"][0]
        high_score = marks["most"] if high >= 1 else marks["q"][1]
        counted = scored.agg(
            F.count(F.when(F.col(score) > high_score, 1)).alias("above"),
            F.count(F.when(F.col(score).between(low_score, high_score), 1)).alias("inside"),
        ).first()
        if counted["above"] < wanted <= counted["above"] + counted["inside"]:
            return low_score, high_score, counted["above"]
        reach *= WIDER


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id")]


def placed(scored: DataFrame, rows: int, first: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Adds `rank` from first + 1 on, by score and id: rows are sorted in ranges, numbered there, and moved up by the exact
    number of rows in the ranges before."""
    ranges = scored.repartitionByRange(max(1, -(-rows // part_rows)), *_order()).sortWithinPartitions(*_order())
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    local = stored(ranges.select("*", F.spark_partition_id().alias("_part"), within.alias("_within")), "resample-ranges")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    firsts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"))
    return local.join(firsts, "_part").select(*scored.columns, (F.lit(first + 1) + F.col("_first") + F.col("_within")).alias("rank"))


def draw(scored: DataFrame, rows: int, wanted: int, accuracy: int = ACCURACY, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, score, ...) with the rank of the `wanted` best by score and id; the others' rank is null."""
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", none)
    low, high, above = bracket(scored, "score", rows, wanted, accuracy)
    sure = scored.where(F.col("score") > high)
    inside = scored.where(F.col("score").between(low, high))
    near = placed(inside, inside.count(), above, part_rows)
    drawn = placed(sure, above, 0, part_rows) if above else sure.select("*", none)
    rest = scored.where(F.col("score") < low).select("*", none)
    return drawn.unionByName(near.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, size: int = 1, buckets: int = 10_000, seed: str = "2024", percent: int = 10, least_words: int = 20,
    accuracy: int = ACCURACY, part_rows: int = PART_ROWS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of docs (doc_id, text); undrawn rows have no rank.

    Drawn are floor(percent * n / 100) of the n documents with `least_words` words or more.
    """
    small_batches(docs.sparkSession)
    source = docs.select("doc_id", "text")
    gain = gains(bucket_counts(source, buckets, size), bucket_counts(target, buckets, size))
    found = weighted(source, gain, size, ["doc_id"])
    scored = stored(found.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample")
    fit, unfit = scored.where(F.col("n_words") >= least_words), scored.where(F.col("n_words") < least_words)
    rows = fit.count()
    every = draw(fit, rows, percent * rows // 100, accuracy, part_rows).unionByName(unfit.withColumn("rank", F.lit(None).cast("long")))
    return every.select("doc_id", "n_features", "weight", "score", "rank")
