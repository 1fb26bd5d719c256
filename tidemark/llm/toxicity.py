"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

A word enters as an embedding of its hash next to the summed embeddings of its character n-grams. The
network reads all overlapping windows of `WINDOW` words, one beginning at every word; a document scores as its highest
window. Training is in numpy on a bounded sample of labelled rows. Embeddings begin with how much oftener
than expected a word or n-gram stands in toxic documents of the sample. A document's label holds for its text, so its
window with the most such words stands for it at first, later the window that scores highest; clean
documents also contribute random windows.

Defined cases: null and empty texts, and texts of blanks only, score 0. Rows without a label are scored, not learnt from; null
labels and labels without a document are ignored. Without training rows of both labels every score is the share of
label 1, or 0. Repeated rows get equal scores. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.llm.quality_classifier import held_out
from tidemark.llm.shingles import mix, word_hashes

WINDOW = 8
HIDDEN, EMBEDDING = 8, 8
WORD_BUCKETS, GRAM_BUCKETS = 8192, 16384
GRAMS = (3, 5)
#: Labelled documents of each class that training may use, and the longest text among them.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 30_000
EPOCHS, LEAST_STEPS, BATCH, RATE = 10, 500, 128, 0.01
#: Words whose inputs are kept per Python worker, and windows that are scored together.
MOST_WORDS, WINDOWS_AT_ONCE = 400_000, 2048
#: Words of the sample whose inputs are put together at once.
WORDS_AT_ONCE = 1 << 15
RUN_CHARS = 1 << 18
_EDGES = string.punctuation + "¡¿«»„“”‘’…"
Params = dict[str, np.ndarray]


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its bucket; its n-gram buckets one after another; the first of each word's n-grams."""
    bare = [w.strip(_EDGES) or w for w in words]
    data = np.frombuffer("\n".join(f"<{w}>" for w in bare).encode() + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes, _ = word_hashes(data, np.zeros(1, np.int64))
    owner = np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(data))))
    grams, owners = [], []
    for n in GRAMS:
        rolled = np.full(max(len(data) - n, 0), n, np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(1099511628211) + data[k : k + len(rolled)]
        inside = (owner[: len(rolled)] == owner[n - 1 : n - 1 + len(rolled)]) & (data[n - 1 : n - 1 + len(rolled)] != 10)
        grams.append((mix(rolled[inside]) % np.uint64(GRAM_BUCKETS)).astype(np.int64))
        owners.append(owner[: len(rolled)][inside])
    order = np.argsort(np.concatenate(owners), kind="stable")
    held = np.concatenate(owners)[order]
    return (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), np.concatenate(grams)[order], np.searchsorted(held, np.arange(len(words)))


class _Vocabulary:
    """Features of the sample's words."""

    def __init__(self, words: list[str]):
        found = [word_features(words[at : at + WORDS_AT_ONCE]) for at in range(0, len(words), WORDS_AT_ONCE)]
        bases = np.cumsum([0] + [len(grams) for _, grams, _ in found])
        self.bucket = np.concatenate([bucket for bucket, _, _ in found]).astype(np.int32)
        self.grams = np.concatenate([grams for _, grams, _ in found]).astype(np.int32)
        self.first = np.concatenate([first + base for (_, _, first), base in zip(found, bases, strict=False)])
        self.count = np.diff(np.append(self.first, len(self.grams)))

    def projections(self, p: Params) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        edges, inputs = np.append(self.first, len(self.grams)), []
        for at in range(0, len(self.bucket), WORDS_AT_ONCE):
            first = edges[at : at + WORDS_AT_ONCE + 1]
            inputs.append(_inputs(p, self.bucket[at : at + WORDS_AT_ONCE], self.grams[first[0] : first[-1]], first[:-1] - first[0]))
        return _projected(p, np.concatenate(inputs))


def _inputs(p: Params, bucket: np.ndarray, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    count = np.diff(np.append(first, len(grams)))
    sums = np.add.reduceat(p["gram"][grams], np.minimum(first, max(len(grams) - 1, 0)), axis=0) if len(grams) else np.zeros((len(first), EMBEDDING), np.float32)
    sums[count == 0] = 0
    return np.concatenate([p["word"][bucket], sums / np.sqrt(np.maximum(count, 1))[:, None]], axis=1).astype(np.float32)


def initial(seed: int = 5) -> Params:
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    wide = 2 * EMBEDDING
    params = {"word": draw(WORD_BUCKETS, EMBEDDING, scale=0.1), "gram": draw(GRAM_BUCKETS, EMBEDDING, scale=0.1)}
    for side in "fb":
        params["w" + side] = draw(wide, 3 * HIDDEN, scale=wide**-0.5)
        params["u" + side] = draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
        params["b" + side] = np.zeros(3 * HIDDEN, np.float32)
    params |= {"a": draw(2 * HIDDEN, HIDDEN, scale=0.25), "v": draw(HIDDEN, scale=0.3), "o": draw(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32)}
    return params


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _run(projected: np.ndarray, u: np.ndarray, mask: np.ndarray | None, backward: bool, trace: list | None = None) -> np.ndarray:
    """States of one direction from projected inputs (time, window, gates): update, reset, candidate."""
    steps, rows, _ = projected.shape
    states = np.empty((steps, rows, HIDDEN), np.float32)
    h = np.zeros((rows, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        x, r = projected[t], h @ u
        gates = _sigmoid(x[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])
        z, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN :] + reset * r[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if trace is not None:
            trace.append((t, h, z, reset, n, r[:, 2 * HIDDEN :]))
        states[t] = h = new
    return states


def _pooled(p: Params, states: np.ndarray, mask: np.ndarray | None):
    energy = np.tanh(states @ p["a"])
    weight = energy @ p["v"]
    if mask is not None:
        weight = np.where(mask, weight, -1e9)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    context = np.einsum("tb,tbh->bh", weight, states)
    return context @ p["o"] + p["c"][0], energy, weight, context


def logits(p: Params, projected: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    """Scores of windows from inputs projected for both directions (time, window, 6 x hidden)."""
    half = 3 * HIDDEN
    ahead = _run(projected[:, :, :half], p["uf"], mask, False)
    back = _run(projected[:, :, half:], p["ub"], mask, True)
    return _pooled(p, np.concatenate([ahead, back], axis=2), mask)[0]


def _back_through(side: str, p: Params, grads: Params, trace: list, flow: np.ndarray, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Gradients of one direction; returns that of its inputs."""
    u, moved = p["u" + side], np.zeros_like(x)
    carried = np.zeros(flow.shape[1:], np.float32)
    for t, h, z, reset, n, rn in reversed(trace):
        d = (flow[t] + carried) * mask[t][:, None]
        skipped = (flow[t] + carried) * ~mask[t][:, None]
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * rn * reset * (1 - reset)
        gates = np.concatenate([dz, dr, dn], axis=1)
        inner = np.concatenate([dz, dr, dn * reset], axis=1)
        grads["u" + side] += h.T @ inner
        carried = d * z + inner @ u.T + skipped
        grads["w" + side] += x[t].T @ gates
        grads["b" + side] += gates.sum(0)
        moved[t] = gates @ p["w" + side].T
    return moved


def gradients(p: Params, vocabulary: _Vocabulary, windows: np.ndarray, labels: np.ndarray) -> tuple[float, Params]:
    """Loss and its gradients over windows (window, time) of word numbers, -1 beyond a text's end."""
    mask = (windows >= 0).T
    unique, place = np.unique(np.maximum(windows, 0), return_inverse=True)
    place = place.reshape(windows.shape).T
    counts = vocabulary.count[unique]
    firsts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    grams = vocabulary.grams[np.repeat(vocabulary.first[unique] - firsts, counts) + np.arange(counts.sum())]
    known = _inputs(p, vocabulary.bucket[unique], grams, firsts)
    x = known[place]
    traces: dict[str, list] = {"f": [], "b": []}
    states = [_run(x @ p["w" + s] + p["b" + s], p["u" + s], mask, s == "b", traces[s]) for s in "fb"]
    both = np.concatenate(states, axis=2)
    logit, energy, weight, context = _pooled(p, both, mask)
    chance = _sigmoid(logit)
    loss = float(-np.mean(np.where(labels == 1, np.log(chance + 1e-7), np.log(1 - chance + 1e-7))))
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    dl = ((chance - labels) / len(labels)).astype(np.float32)
    grads["o"], grads["c"] = context.T @ dl, dl.sum(keepdims=True)
    dc = dl[:, None] * p["o"]
    dw = np.einsum("bh,tbh->tb", dc, both)
    dw = weight * (dw - (weight * dw).sum(0))
    de = dw[:, :, None] * p["v"] * (1 - energy * energy)
    grads["v"] = np.einsum("tb,tbk->k", dw, energy)
    grads["a"] = np.einsum("tbh,tbk->hk", both, de)
    flow = weight[:, :, None] * dc + de @ p["a"].T
    dx = _back_through("f", p, grads, traces["f"], flow[:, :, :HIDDEN], x, mask)
    dx += _back_through("b", p, grads, traces["b"], flow[:, :, HIDDEN:], x, mask)
    per_word = np.zeros_like(known)
    np.add.at(per_word, place.ravel(), (dx * mask[:, :, None]).reshape(-1, known.shape[1]))
    np.add.at(grads["word"], vocabulary.bucket[unique], per_word[:, :EMBEDDING])
    spread = per_word[:, EMBEDDING:] / np.sqrt(np.maximum(counts, 1))[:, None]
    np.add.at(grads["gram"], grams, np.repeat(spread, counts, axis=0))
    return loss, grads


def projections(p: Params, words: list[str]) -> np.ndarray:
    """What each word adds to the gates of both directions."""
    return _projected(p, _inputs(p, *word_features(words)))


def _projected(p: Params, x: np.ndarray) -> np.ndarray:
    return np.concatenate([x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]], axis=1)


def window_starts(n_words: int) -> np.ndarray:
    """Where the windows of a text begin: at every word that a whole window follows; short texts are one window."""
    return np.arange(min(n_words, max(1, n_words - WINDOW + 1)))


def _score_windows(p: Params, table: np.ndarray, windows: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Scores of windows, or of those windows that `starts` picks."""
    found = np.empty(len(windows if starts is None else starts), np.float32)
    for at in range(0, len(found), WINDOWS_AT_ONCE):
        part = (windows[at : at + WINDOWS_AT_ONCE] if starts is None else windows[starts[at : at + WINDOWS_AT_ONCE]]).T
        mask = part >= 0
        found[at : at + part.shape[1]] = logits(p, table[np.maximum(part, 0)], None if mask.all() else mask)
    return found


def _sliding(p: Params, table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of the windows that begin at each of the rows, as `logits` gives them. A step of all windows is one slice of the
    words' inputs; windows run along the last axis, so that every operation goes over long rows.
    """
    found = np.empty(len(rows) - WINDOW + 1, np.float32)
    half = 3 * HIDDEN
    for at in range(0, len(found), WINDOWS_AT_ONCE):
        n = min(WINDOWS_AT_ONCE, len(found) - at)
        inputs = np.ascontiguousarray(table[rows[at : at + n + WINDOW - 1]].T)
        states = np.empty((WINDOW, 2 * HIDDEN, n), np.float32)
        for side, steps, first in (("f", range(WINDOW), 0), ("b", reversed(range(WINDOW)), half)):
            u, h = np.ascontiguousarray(p["u" + side].T), np.zeros((HIDDEN, n), np.float32)
            for t in steps:
                x, r = inputs[first : first + half, t : t + n], u @ h
                gates = x[: 2 * HIDDEN] + r[: 2 * HIDDEN]
                gates *= 0.5
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                new = gates[HIDDEN:] * r[2 * HIDDEN :]
                new += x[2 * HIDDEN :]
                np.tanh(new, out=new)
                h -= new
                h *= gates[:HIDDEN]
                h += new
                states[t, HIDDEN * first // half : HIDDEN * first // half + HIDDEN] = h
        weight = np.stack([p["v"] @ np.tanh(p["a"].T @ s) for s in states])
        weight = np.exp(weight - weight.max(0))
        context = sum(w * s for w, s in zip(weight, states, strict=True)) / weight.sum(0)
        found[at : at + n] = p["o"] @ context + p["c"][0]
    return found


def _excess(p: Params, vocabulary: _Vocabulary, words: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Puts into the first place of every embedding how far its documents are toxic beyond chance, in
    standard deviations; returns that by word."""
    share = toxic.mean()
    # Documents, and toxic ones, that hold each word, word bucket and n-gram bucket.
    seen, bad = ([np.zeros(n, np.int64) for n in (len(vocabulary.bucket), WORD_BUCKETS, GRAM_BUCKETS)] for _ in range(2))
    for w, is_toxic in zip(words, toxic, strict=True):
        counts = vocabulary.count[w]
        before = np.concatenate(([0], np.cumsum(counts)))[:-1]
        grams = vocabulary.grams[np.repeat(vocabulary.first[w] - before, counts) + np.arange(counts.sum())]
        for k, held in enumerate((w, np.unique(vocabulary.bucket[w]), np.unique(grams))):
            seen[k][held] += 1
            bad[k][held] += is_toxic
    by_word, by_bucket, by_gram = ((b - share * s) / np.sqrt(share * (1 - share) * s + 1) for b, s in zip(bad, seen, strict=True))
    p["word"][:, 0] = np.clip(by_bucket / 4, -1, 1)
    p["gram"][:, 0] = np.clip(by_gram / 4, -1, 1)
    return by_word


def train(texts: list[str], labels: np.ndarray, seed: int = 11) -> Params:
    """Fits the network to labelled texts; the sample must hold both labels.

    The texts lie end to end as word numbers, each at least a window long, and a window is the place it begins at: its words
    are looked up when it is read, so memory grows by a few bytes for every word of the sample.
    """
    numbers: dict[str, int] = {}
    ids, docs = [], []
    for d, text in enumerate(texts):
        words = np.array([numbers.setdefault(w, len(numbers)) for w in text.lower().split()], np.int32)
        if len(words):
            ids.append(words)
            docs.append(d)
    blocks = np.array([max(len(x), WINDOW) for x in ids])
    flat = np.full(blocks.sum(), -1, np.int32)
    for base, x in zip(np.cumsum(blocks) - blocks, ids, strict=True):
        flat[base : base + len(x)] = x
    starts = np.concatenate([base + window_starts(len(x)) for base, x in zip(np.cumsum(blocks) - blocks, ids, strict=True)]).astype(np.int32)
    sizes = np.array([len(window_starts(len(x))) for x in ids])
    begins = np.cumsum(sizes) - sizes
    windows = sliding_window_view(flat, WINDOW)
    vocabulary = _Vocabulary(list(numbers))
    del numbers
    p, rng = initial(), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    marks = labels[docs]
    toxic = marks == 1
    excess = _excess(p, vocabulary, [np.unique(x) for x in ids], toxic)
    highest = sliding_window_view(np.where(flat >= 0, excess[np.maximum(flat, 0)], -9.0), WINDOW)
    scored = np.concatenate([highest[starts[at : at + WINDOWS_AT_ONCE]].max(1) for at in range(0, len(starts), WINDOWS_AT_ONCE)])
    del ids, excess, highest
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // (3 * len(docs))))):
        if epoch > 1:
            scored = _score_windows(p, vocabulary.projections(p), windows, starts)
        best, next_best = np.array([b + np.argsort(scored[b : b + n], kind="stable")[[-1, max(n - 2, 0)]] for b, n in zip(begins, sizes, strict=True)]).T
        drawn = begins + (rng.random(len(docs)) * sizes).astype(np.int64)
        chosen = np.concatenate([best, next_best[~toxic], drawn[~toxic]])
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), BATCH):
            part = chosen[at : at + BATCH]
            owner = np.searchsorted(begins, part, "right") - 1
            _, grads = gradients(p, vocabulary, windows[starts[part]], marks[owner].astype(np.float32))
            step += 1
            pace = RATE / (1 + epoch / EPOCHS) ** 2 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                p[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return p


class _Words(dict):
    """Rows of the table of projections by word; rows of new words are filled in together."""

    def __init__(self, params: Params):
        super().__init__()
        self.params, self.fresh = params, []
        self.table = np.zeros((1024, 6 * HIDDEN), np.float32)

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = row = len(self)
        return row

    def rows(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.fresh:
            if len(self) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((2 * len(self) - len(self.table), 6 * HIDDEN), np.float32)])
            self.table[len(self) - len(self.fresh) : len(self)] = projections(self.params, self.fresh)
            self.fresh = []
        return found

    def trim(self) -> None:
        if len(self) > MOST_WORDS:
            self.clear()
            self.table = np.zeros((1024, 6 * HIDDEN), np.float32)


def score_texts(params: Params, texts: list[str | None], words: _Words | None = None) -> np.ndarray:
    """The highest window of each text as a chance, 0 for texts without words."""
    words = words if words is not None else _Words(params)
    best = np.full(len(texts), -np.inf)
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end] or "") <= RUN_CHARS):
            held += len(texts[end] or "")
            end += 1
        words.trim()
        split = [(t or "").lower().split() for t in texts[at:end]]
        rows = words.rows([w for s in split for w in s])
        lengths = np.array([len(s) for s in split])
        bases = np.cumsum(lengths) - lengths
        short = [(at + d, bases[d], n) for d, n in enumerate(lengths) if 0 < n < WINDOW]
        whole = np.flatnonzero(lengths >= WINDOW)
        if len(whole):
            # Windows go over the texts laid end to end; those that begin in one text and end in the next are not counted.
            scores = _sliding(params, words.table, rows)
            for d in whole:
                best[at + d] = scores[bases[d] : bases[d] + lengths[d] - WINDOW + 1].max()
        if short:
            window = np.full((len(short), WINDOW), -1)
            for k, (_, first, n) in enumerate(short):
                window[k, :n] = rows[first : first + n]
            best[[d for d, _, _ in short]] = _score_windows(params, words.table, window)
        at = end
    return np.where(np.isneginf(best), 0.0, 1 / (1 + np.exp(-np.maximum(best, -500))))


_known: dict[bytes, _Words] = {}


def _scored(params: Params | None, base: float, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        if params is not None:
            key = params["o"].tobytes() + params["v"].tobytes()
            if key not in _known:
                _known.clear()
                _known[key] = _Words(params)
            words = _known[key]
        for batch in batches:
            texts = batch.column("_t").to_pylist()
            scores = score_texts(params, texts, words) if params is not None else np.array([base if (t or "").split() else 0.0 for t in texts], float)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(scores, pa.float64())], names=[*keep, "score"])

    return run


def sample(docs: DataFrame, labels: DataFrame, label: str, used: Column) -> list[tuple[str, int]]:
    """Up to SAMPLE_DOCS labelled texts of each class, drawn by a hash of the id; equal texts once.

    Ids are drawn first, without texts; only those of the drawn ids, a bounded number, are sent on.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
    fits = docs.where(used & (F.length("_t") <= SAMPLE_CHARS))
    rows = fits.select("_id").join(known.where(F.col("_label").isin(0, 1)), "_id").distinct()
    found: dict[str, int] = {}  # copies of one text would teach its rare words
    for c in (0, 1):
        drawn = rows.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS)
        ids = docs.sparkSession.createDataFrame(drawn.select("_id").collect(), drawn.select("_id").schema)
        texts = fits.join(F.broadcast(ids), "_id").select("_id", "_t").distinct().orderBy(F.xxhash64("_id"), "_id", "_t")
        found |= {r["_t"]: c for r in texts.limit(SAMPLE_DOCS).collect() if r["_t"].split()}
    return list(found.items())


def score(docs: DataFrame, labels: DataFrame, keep: list[str], label: str = "toxic", text: str = "text", doc_id: str = "doc_id",
          parts: int = 4, part: int = 2, threshold: float = 0.3) -> DataFrame:
    """The kept columns, score and predicted per document; learns from labelled rows outside `part`."""
    small_batches(docs.sparkSession)
    kept = [f"_r{i}" for i in range(len(keep))]
    named = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, kept, strict=True)], F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_t"))
    drawn = sample(named, labels, label, ~held_out(F.col("_id"), parts, part))
    marks = np.array([c for _, c in drawn])
    params = train([t for t, _ in drawn], marks) if len(set(marks.tolist())) == 2 else None
    kinds = ", ".join(f"`{k}` {named.schema[k].dataType.simpleString()}" for k in kept)
    scored = named.select(*kept, "_t").mapInArrow(_scored(params, float(marks.mean()) if len(marks) else 0.0, kept), f"{kinds}, score double")
    return scored.select(
        *[F.col(n).alias(k) for k, n in zip(keep, kept, strict=True)], "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
