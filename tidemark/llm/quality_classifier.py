"""Quality scores by regularised quadratic discriminant analysis.

A document is a vector of transformed counts over its whole text. Each class has its mean and a covariance
shrunk towards the pooled one and the identity; a score is the logistic of the difference of the two log densities, each
from a Mahalanobis distance by the class's Cholesky factor, plus the log of the classes' ratio. All
labelled training rows count: their moments are summed on the executors, in exact integers, so fits do not
depend on how rows are dealt. Only class moments reach the driver.

Defined cases: null and empty texts are scored like any other, with counts of 0. Rows without a label
are scored, not learnt from; null labels and labels without a document are ignored, repeated ones count each. If
a class has fewer than two rows, every score is the share of label 1, or 0.5 without labels. Repeated rows get equal scores. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.statistics import text_statistics

#: Vectors are whole multiples of 1 / SCALE.
SCALE = 1024
TO_POOLED = 0.1
TO_IDENTITY = 0.02
FEATURES = ["length", "word_length", "symbols", "repeated_lines", "repeated_words", "capitals", "marks", "digits", "variety", "line_words"]


def features() -> list[Column]:
    """The transformed counts as long integers."""
    n_words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = [
        F.log1p("n_words"), F.sqrt(F.col("word_chars") / n_words), F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / n_words),
        F.sqrt(F.col("n_upper") / chars), F.sqrt(F.col("n_marks") / chars), F.sqrt(F.col("n_digits") / chars),
        F.sqrt(F.col("n_distinct_words") / n_words), F.log1p(F.col("n_words") / F.greatest("n_lines", F.lit(1))),
    ]
    return [F.floor(v * SCALE).cast("long").alias(name) for v, name in zip(values, FEATURES, strict=True)]


@dataclass(frozen=True)
class Discriminant:
    """Centre and scale of the features; per class mean, inverse Cholesky factor and log determinant."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    log_dets: tuple[float, ...]
    log_odds: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(rows), 1 / (1 + np.exp(-self.log_odds)))
        x = (rows / SCALE - self.centre) / self.scale
        density = [
            -0.5 * (((x - mean) @ factor.T) ** 2).sum(1) - 0.5 * det
            for mean, factor, det in zip(self.means, self.factors, self.log_dets, strict=True)
        ]
        odds = np.clip(density[1] - density[0] + self.log_odds, -500, 500)
        return 1 / (1 + np.exp(-odds))


def moments(rows: DataFrame, label: str) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per class: rows, sums and sums of products of the features."""
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]
    summed = rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(name).cast("double").alias(f"s{i}") for i, name in enumerate(FEATURES)],
        *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("double").alias(f"q{i}_{j}") for i, j in pairs],
    ).collect()
    found = {}
    for r in summed:
        sums = np.array([r[f"s{i}"] for i in range(len(FEATURES))]) / SCALE
        products = np.zeros((len(FEATURES), len(FEATURES)))
        for i, j in pairs:
            products[i, j] = products[j, i] = r[f"q{i}_{j}"] / SCALE**2
        found[int(r[label])] = (r["n"], sums, products)
    return found


def fit(held: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> Discriminant:
    rows = [held.get(c, (0,))[0] for c in (0, 1)]
    odds = float(np.log((rows[1] + 0.5) / (rows[0] + 0.5)))
    if min(rows) < 2:
        return Discriminant(np.zeros(1), np.ones(1), (), (), (), odds)
    means = [held[c][1] / held[c][0] for c in (0, 1)]
    spreads = [held[c][2] / held[c][0] - np.outer(m, m) for c, m in zip((0, 1), means, strict=True)]
    share = np.array(rows) / sum(rows)
    centre = share @ np.array(means)
    within = share[0] * spreads[0] + share[1] * spreads[1]
    scale = np.sqrt(np.maximum(np.diag(within), 1e-4))
    pooled = within / np.outer(scale, scale)
    factors, dets = [], []
    for spread in spreads:
        own = spread / np.outer(scale, scale)
        shrunk = (1 - TO_POOLED - TO_IDENTITY) * own + TO_POOLED * pooled + TO_IDENTITY * np.eye(len(own))
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        dets.append(float(2 * np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, tuple((m - centre) / scale for m in means), tuple(factors), tuple(dets), odds)


def _scored(model: Discriminant, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            columns = [batch.column(k) for k in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.scores(rows))], names=[*keep, "score"])

    return run


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a document is kept from training, by the checksum of its id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, keep: list[str], label: str = "quality", text: str = "text", doc_id: str = "doc_id",
          parts: int = 3, part: int = 1) -> DataFrame:
    """The kept columns, score and predicted per document; learns from labelled rows outside `part`."""
    kept = [f"_r{i}" for i in range(len(keep))]
    named = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, kept, strict=True)], F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
    stats = text_statistics(named, [*kept, "_id"], "_t")
    rows = stored(stats.select(*kept, "_id", *features()), "classifier-features")
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).where(F.col("_label").isin(0, 1))
    training = rows.where(~held_out(F.col("_id"), parts, part)).join(known, "_id")
    model = fit(moments(training, "_label"))
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in kept)
    scored = rows.select(*kept, *FEATURES).mapInArrow(_scored(model, kept), f"{kinds}, score double")
    return scored.select(
        *[F.col(n).alias(k) for k, n in zip(keep, kept, strict=True)], "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
