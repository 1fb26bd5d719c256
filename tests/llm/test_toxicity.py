from __future__ import annotations

import zlib

import tracemalloc

import numpy as np
import pytest

from tests.llm.conftest import AWKWARD, prose
from tidemark.llm import toxicity
from tidemark.llm.common import table


def test_gradients():
    p = {k: v.copy() for k, v in toxicity.initial().items()}
    p["v"], p["o"] = p["v"] * 3, p["o"] * 3
    vocabulary = toxicity._Vocabulary(["alpha", "beta", "gamma", "delta", "eps"])
    windows = np.random.default_rng(0).integers(0, 5, (6, toxicity.WINDOW))
    windows[0, 5:] = -1
    labels = np.array([1, 0, 1, 0, 1, 1], np.float32)
    _, grads = toxicity.gradients(p, vocabulary, windows, labels)
    for name, grad in grads.items():
        for i in np.argsort(-np.abs(grad).ravel())[:3]:
            sides = []
            for step in (1e-2, -1e-2):
                moved = {k: v.copy() for k, v in p.items()}
                moved[name].ravel()[i] += step
                sides.append(toxicity.gradients(moved, vocabulary, windows, labels)[0])
            assert grad.ravel()[i] == pytest.approx((sides[0] - sides[1]) / 2e-2, rel=0.03, abs=3e-4)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 10, 31, 500])
def test_a_window_begins_at_every_word(n):
    assert toxicity.window_starts(n).tolist() == ([0] if 0 < n < toxicity.WINDOW else list(range(n - toxicity.WINDOW + 1)))


def one_by_one(p, text):
    """The highest of all runs of words of a window's length, each scored alone."""
    words = text.lower().split()
    runs = [words[i : i + toxicity.WINDOW] for i in range(len(words)) if i == 0 or i + toxicity.WINDOW <= len(words)]
    return max((1 / (1 + np.exp(-float(toxicity.logits(p, toxicity.projections(p, run)[:, None, :])[0]))) for run in runs), default=0.0)


def test_batches_score_like_single_windows(monkeypatch):
    p = {k: v * 4 for k, v in toxicity.initial().items()}
    texts = [None, "", " ", "one", prose(1, 31), prose(2, 32), prose(3, 333), "x" * 9000, prose(4, 50), "É … ¿qué?"]
    expected = [one_by_one(p, t or "") for t in texts]
    assert np.allclose(toxicity.score_texts(p, texts), expected, atol=1e-5)
    monkeypatch.setattr(toxicity, "RUN_CHARS", 100)
    monkeypatch.setattr(toxicity, "MOST_WORDS", 40)
    monkeypatch.setattr(toxicity, "WINDOWS_AT_ONCE", 3)
    assert np.allclose(toxicity.score_texts(p, texts), expected, atol=1e-5)


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    known = {r["doc_id"]: r["toxic"] for r in table(spark, folder, "labels").collect()}
    scored = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"), ["doc_id"]).collect()
    held = [(r["predicted"], known[r["doc_id"]]) for r in scored if r["doc_id"] in known and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    toxic = [p for p, t in held if t]
    clean = [p for p, t in held if not t]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)


def test_awkward_rows(awkward, nothing, labels, no_labels):
    got = toxicity.score(awkward, labels, ["doc_id", "text", "kept"], part=3).collect()
    assert len(got) == len(AWKWARD)
    assert all(r["score"] == 0 for r in got if not (r["text"] or "").split())
    assert {r["score"] for r in toxicity.score(awkward, no_labels, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(nothing, labels, ["doc_id"]).count() == 0


def test_training_holds_words_not_windows(monkeypatch):
    """Memory of training grows by a few bytes a word; windows were held one by one, at some 170 bytes each."""
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 1)
    texts = [" ".join(f"w{(i * 7 + d * 13) % 300}" for i in range(6000)) for d in range(40)]
    labels = np.arange(40) % 2
    tracemalloc.start()
    try:
        toxicity.train(texts, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20
