from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from tests.llm.conftest import AWKWARD, doc, prose
from tidemark.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, label int, digest string, rank int"


def n_words(row):
    return len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, free = {}, set(order)
    while True:
        left = share * sum(sizes.values()) - sum(fixed.values())
        over = [s for s in free if left * weight[s] / sum(weight[f] for f in free) > most * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        for s in over:
            fixed[s] = most * sizes[s]
            free.discard(s)


def check(rows, got):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for row in rows:
        sizes[row[3]] += n_words(row)
    assert len(got) == len(rows)
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"] and r["source_size"] == sizes[r["source"]]
    expected = plain_targets(sizes)
    for s, n in sizes.items():
        assert target[s] == pytest.approx(expected[s])
        largest = max(n_words(r) for r in rows if r[3] == s)
        assert abs(taken[s] - expected[s]) <= max(largest / 2, 0.5), (s, n, taken[s], expected[s])


def corpus():
    rng = random.Random(2)
    # one source holds most rows, some are small, names need code point order
    sources = ["big"] * 200 + ["Zed"] * 40 + ["zed"] * 30 + ["éa"] * 20 + [None] * 25 + ["a"] * 10
    return [doc(i, prose(i % 150, 1 + int(rng.lognormvariate(3, 1))), "en", s) for i, s in enumerate(sources)]


def test_targets_and_copies(spark):
    rows = corpus()
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)
    again = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in got}


def test_rates_are_exponential_in_size(spark):
    rows = [doc(i, " ".join(["w"] * (10 if i % 2 else 30)), "en", "a" if i < 1000 else "b") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)
    rate = defaultdict(list)
    for r in got:
        if r["source"] == "b":
            rate[r["size"]].append(r["copies"])
    short, long = (sum(v) / len(v) for v in (rate[10], rate[30]))
    assert long == pytest.approx(min(2, short**3), rel=0.02)


def test_awkward_rows(awkward, nothing):
    check(AWKWARD, mixing.mix(awkward).collect())
    assert mixing.mix(nothing).count() == 0
    kept = mixing.mix(awkward, keep=["kept", "size"])
    assert kept.columns[-2:] == ["kept", "size"]


def test_only_empty_texts(spark):
    got = mixing.mix(spark.createDataFrame([doc(1, ""), doc(2, None, "en", None)], SCHEMA)).collect()
    assert [(r["taken"], r["target"]) for r in got] == [(0, 0.0), (0, 0.0)]
