from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import AWKWARD, doc, prose
from tidemark.llm import quality_classifier as classifier
from tidemark.llm import quality_rules as rules
from tidemark.llm.common import table
from tidemark.llm.statistics import COUNTS, text_statistics

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_distinct_words": len(set(words)),
        "n_upper": sum(c.isupper() for c in text), "n_marks": sum(c in "!?" for c in text), "n_digits": sum(c in "0123456789" for c in text),
    }


def test_counts(spark):
    rng = random.Random(1)
    texts = [r[1] for r in AWKWARD] + ["a b c d e a b c d e f", "a a a a a a a", "x # *| <b>\n\nx # *| <b>\nÀ É 12 34!", "\v\f\ra"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for row in text_statistics(frame, ["i"]).collect():
        assert {c: row[c] for c in COUNTS} == plain_counts(texts[row["i"]]), texts[row["i"]]


def plain_vector(c):
    pairs = [
        ("word_chars", c["n_words"]), ("n_symbols", c["word_chars"]), ("n_dup_lines", c["n_lines"]), ("n_repeat_words", c["n_words"]),
        ("n_upper", c["word_chars"]),
    ]
    return [math.floor(1024 * math.sqrt(c[a] / max(b, 1))) for a, b in pairs]


def plain_estimate(x):
    """The estimate of a group's vectors (rows of x), one row per document."""
    floor = np.diag(np.square(rules.FLOORS))
    y = x / rules.SCALE
    starts = [(y.mean(0), np.cov(y.T, bias=True) + floor)]
    for share in (25, 50):
        middle = np.percentile(x, share, axis=0)
        spread = np.median(np.floor(np.abs(x - middle)), axis=0)
        starts.append((middle / rules.SCALE, np.diag((1.4826 * spread / rules.SCALE) ** 2) + floor))
    found = []
    for centre, cov in starts:
        last, root = math.inf, 0.0
        while root < rules.FALLS * last:
            last = root or last
            d = np.einsum("ij,ij->i", (y - centre) @ np.linalg.inv(cov), y - centre)
            near = np.floor(rules.CLASSES * np.sqrt(np.sqrt(d)))
            h = math.ceil(rules.SHARE * len(y))
            crossing = np.sort(near)[h - 1]
            weight = (near < crossing) + (near == crossing) * (h - (near < crossing).sum()) / (near == crossing).sum()
            centre = weight @ y / h
            cov = rules.CONSISTENCY * ((y - centre).T * weight) @ (y - centre) / h + floor
            root = math.sqrt(np.linalg.det(cov))
            found.append((root, centre, cov))
    return min(found, key=lambda f: f[0])[1:]


def points(spark, x):
    """Vectors of one group as `estimates` takes them."""
    rows = [("g", *map(int, v), n) for v, n in Counter(map(tuple, x)).items()]
    return spark.createDataFrame(rows, "grp string, " + ", ".join(f"x{i} long" for i in range(rules.DIMS)) + ", n long")


@pytest.mark.parametrize("seed", [3, 4])
def test_estimates_take_steps_until_they_rest(spark, seed):
    rng = np.random.default_rng(seed)
    clean = rng.normal(1500, 300, (130, rules.DIMS))
    junk = rng.normal(4600, 300, (90, rules.DIMS))
    x = np.floor(np.vstack([clean, junk]))
    x = np.vstack([x, x[:5]])
    centre, cov = plain_estimate(x)
    got = rules.estimates(points(spark, x)).first()
    assert [got[f"m{i}"] for i in range(rules.DIMS)] == pytest.approx(centre, rel=1e-9)
    assert got["det"] == pytest.approx(math.sqrt(np.linalg.det(cov)), rel=1e-6)
    off = junk / rules.SCALE - centre
    assert (np.einsum("ij,ij->i", off @ np.linalg.inv(cov), off) > rules.CUTOFF).all()


def test_estimates_of_no_rows_and_of_equal_rows(spark):
    assert rules.estimates(points(spark, np.zeros((60, rules.DIMS))).limit(0)).count() == 0
    got = rules.estimates(points(spark, np.full((60, rules.DIMS), 1024.0))).first()
    assert [got[f"m{i}"] for i in range(rules.DIMS)] == [1.0] * rules.DIMS
    assert got["det"] == pytest.approx(math.prod(rules.FLOORS))


def test_steps_without_an_end_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(rules, "MOST_STEPS", 1)
    with pytest.raises(RuntimeError, match="did not end"):
        rules.estimates(points(spark, np.arange(60 * rules.DIMS, dtype=float).reshape(60, rules.DIMS)))


def corpus(n=360):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        text = prose(i, rng.randrange(40, 160))
        if i % 12 == 1:
            text = " ".join(w + "***" for w in text.split())
        if i % 12 == 2:
            text = text.upper()
        rows.append(doc(i, text, "en" if i % 3 else "de", f"s{i % 2}"))
    return rows


def test_distances_match_plain_estimates(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, label int, digest string, rank int"), ["doc_id"], min_rows=80).collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[(r[2], r[3])].append(r)
        groups[(r[2],)].append(r)
    for r in rows:
        key = (r[2], r[3]) if len(groups[(r[2], r[3])]) >= 80 else (r[2],)
        centre, cov = plain_estimate(np.array([plain_vector(plain_counts(g[1])) for g in groups[key]], float))
        off = np.array(plain_vector(plain_counts(r[1]))) / rules.SCALE - centre
        assert got[r[0]]["distance2"] == pytest.approx(off @ np.linalg.inv(cov) @ off, rel=1e-6, abs=1e-9)
        assert got[r[0]]["kept"] == (not got[r[0]]["base_failed"] and got[r[0]]["distance2"] <= rules.CUTOFF)
    rejected = {r[0] for r in rows if not got[r[0]]["kept"]}
    assert rejected == {r[0] for r in rows if r[0] % 12 in (1, 2)}


@pytest.mark.parametrize("junk, copies", [(40, True), (40, False), (54, True), (54, False)])
def test_junk_below_half_of_a_source_is_rejected(spark, junk, copies):
    rows = [doc(i, prose(i, 40 + i % 100)) for i in range(120 - junk)]
    for i in range(junk):
        text = prose(1000 if copies else 1000 + i, 90 if copies else 40 + i)
        rows.append(doc(1000 + i, " ".join(w + "***" for w in text.split())))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, label int, digest string, rank int")
    got = rules.judge(frame, ["doc_id"]).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} == {r[0] for r in rows if r[0] >= 1000}


def test_chi_square():
    assert rules.chi_square_quantile(0.95, 1) == pytest.approx(3.841458820694, rel=1e-9)
    assert rules.chi_square_quantile(0.99, 5) == pytest.approx(15.08627246939, rel=1e-9)


def test_rules_on_awkward_rows(awkward, nothing):
    got = rules.judge(awkward, ["doc_id", "text"]).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        counts = plain_counts(r["text"])
        failed = counts["n_words"] < 10 or 100 * counts["n_repeat_words"] > 20 * counts["n_words"]
        assert (r["base_failed"], r["kept"]) == (failed, not failed)  # no group is large enough for an estimate
    assert rules.judge(nothing, ["doc_id"]).count() == 0


def test_rules_do_not_depend_on_partitions(spark):
    frame = spark.createDataFrame(corpus(150), "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, label int, digest string, rank int")
    one, other = (sorted(rules.judge(frame.repartition(n), ["doc_id"], min_rows=40).collect()) for n in (1, 5))
    assert one == other


def test_moments_and_fit_match_numpy():
    rng = np.random.default_rng(3)
    x = {c: np.floor(1024 * (rng.standard_normal((200, len(classifier.FEATURES))) * (1 + c) + c)) for c in (0, 1)}
    held = {c: (len(v), v.sum(0) / 1024, v.T @ v / 1024**2) for c, v in x.items()}
    model = classifier.fit(held)
    rows = np.concatenate([x[0], x[1]])
    y = [v / 1024 for v in x.values()]
    within = sum(np.cov(v.T, bias=True) for v in y) / 2
    scale = np.sqrt(np.diag(within))
    odds = []
    for v in y:
        own = (1 - classifier.TO_POOLED - classifier.TO_IDENTITY) * np.cov(v.T, bias=True) / np.outer(scale, scale)
        cov = own + classifier.TO_POOLED * within / np.outer(scale, scale) + classifier.TO_IDENTITY * np.eye(len(scale))
        off = (rows / 1024 - v.mean(0)) / scale
        odds.append(-0.5 * np.einsum("ij,ij->i", off @ np.linalg.inv(cov), off) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.scores(rows), 1 / (1 + np.exp(-np.clip(odds[1] - odds[0], -500, 500))))


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    known = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    scored = classifier.score(table(spark, folder, "documents"), table(spark, folder, "labels"), ["doc_id"]).collect()
    held = [(r["predicted"], known[r["doc_id"]]) for r in scored if r["doc_id"] in known and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 80 and np.mean([p == q for p, q in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored)


def test_classifier_on_awkward_rows(awkward, nothing, labels, no_labels):
    got = classifier.score(awkward, labels, ["doc_id", "kept"]).collect()
    assert len(got) == len(AWKWARD) and {r["kept"] for r in got} == {"x"}
    assert {r["score"] for r in classifier.score(awkward, no_labels, ["doc_id"]).collect()} == {0.5}
    assert classifier.score(nothing, labels, ["doc_id"]).count() == 0
