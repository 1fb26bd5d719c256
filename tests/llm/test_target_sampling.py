"""Resampling against plain Python that sorts everything."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.conftest import AWKWARD, SCHEMA, doc, prose
from tidemark.llm import target_sampling as sampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, size):
    found = WORD.findall((text or "").translate(LOWER))
    return len(found), [" ".join(found[i : i + n]) for n in range(1, size + 1) for i in range(len(found) - n + 1)]


def plain(docs, target, size=1, buckets=10_000, percent=10):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    held = [(i, *plain_features(t, size)) for i, t in docs]
    s = Counter(bucket(f) for _, _, found in held for f in found)
    t = Counter(bucket(f) for text in target for f in plain_features(text, size)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, n_words, found in held:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    fit = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = [(*r[:4], i + 1) for i, r in enumerate(fit[: percent * len(fit) // 100])]
    rest = [(*r[:4], None) for r in fit[len(ranks) :]] + [(*r[:4], None) for r in rows if r[4] < 20]
    return Counter(ranks + rest)


def got(frame):
    assert frame.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return Counter(tuple(r) for r in frame.collect())


def test_words():
    text = "Ab-c\tÄB9\x7fß 漢字,É_x\0y"
    assert [w.decode() for w in sampling.words(text.encode())] == WORD.findall(text.translate(LOWER)) == ["ab", "c", "Äb9", "ß", "漢字", "É", "x", "y"]


@pytest.mark.parametrize("size, buckets, percent, part_rows", [(1, 10_000, 10, 1 << 18), (2, 97, 35, 16), (3, 10_000, 100, 40), (1, 5, 1, 7)])
def test_against_sorting(spark, size, buckets, percent, part_rows):
    rng = random.Random(size)
    docs = [(i, prose(i % 90, rng.randrange(5, 60))) for i in range(400)]
    target = [prose(i, 30) for i in range(20)]
    frame = spark.createDataFrame([doc(i, t) for i, t in docs], SCHEMA).repartition(4)
    result = sampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), size, buckets, percent=percent, part_rows=part_rows)
    assert got(result) == plain(docs, target, size, buckets, percent)


@pytest.mark.parametrize("scores", [[5] * 500, list(range(500)), [1] * 400 + [9] * 100, [-(2**40), *[0] * 498, 2**40]])
def test_bracket_holds_the_place(spark, scores):
    """Also with a coarse sketch, where brackets must be widened."""
    frame = spark.createDataFrame([(s,) for s in scores], "score long").cache()
    for wanted in (1, 2, 50, 100, 101, 499, 500):
        low, high, above = sampling.bracket(frame, "score", len(scores), wanted, accuracy=5)
        place = sorted(scores, reverse=True)[wanted - 1]
        assert low <= place <= high and above == sum(s > high for s in scores) < wanted
    frame.unpersist()


def test_a_wrong_bracket_is_widened(spark, monkeypatch):
    """With no reach at all the sketch alone decides; counts find out, and widening ends."""
    monkeypatch.setattr(sampling, "ERRORS", 0.0005)
    frame = spark.range(1000).selectExpr("id * id as score").repartition(7)
    for wanted in (1, 333, 1000):
        low, high, above = sampling.bracket(frame, "score", 1000, wanted, accuracy=3)
        assert low <= (1000 - wanted) ** 2 <= high and above < wanted


def test_draw_takes_exactly_as_many_among_ties(spark):
    rows = [(i % 50, 7) for i in range(300)] + [(None, 7)] * 5 + [(1000 + i, 8) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, score long")
    found = sampling.draw(frame, len(rows), 20, part_rows=8).collect()
    assert len(found) == len(rows)
    drawn = sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["rank"])
    assert [r for r, _, _ in drawn] == list(range(1, 21))
    assert [(i, s) for _, i, s in drawn] == [(1000, 8), (1001, 8), (1002, 8), *[(0, 7)] * 6, *[(1, 7)] * 6, *[(2, 7)] * 5]


def test_awkward_rows(spark, awkward, nothing):
    target = spark.createDataFrame([(None,), ("",), ("one two",), ("x" * 200_000,)], "text string")
    docs = [(r[0], r[1]) for r in AWKWARD] + [(20 + i, prose(i, 25)) for i in range(40)]
    frame = awkward.unionByName(spark.createDataFrame([doc(20 + i, prose(i, 25)) for i in range(40)], SCHEMA))
    assert got(sampling.resample(frame, target)) == plain(docs, [None, "", "one two", "x" * 200_000])
    assert got(sampling.resample(frame, target.limit(0))) == plain(docs, [])
    assert got(sampling.resample(awkward, target)) == plain([(r[0], r[1]) for r in AWKWARD], [None, "", "one two", "x" * 200_000])
    assert sampling.resample(nothing, target).count() == 0
