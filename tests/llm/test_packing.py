from __future__ import annotations

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import AWKWARD, prose
from tidemark.llm import packing
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.tokenising import TextEncoder

PATHS = [tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")]


SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext |>"]


@pytest.mark.parametrize("path", PATHS)
def test_ids_are_those_of_whole_texts(path):
    coder, plain = TextEncoder(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    texts = [r[1] or "" for r in AWKWARD] + [
        "a  b", " a", "a\n\n b", "don't we'll ,x", "\n\n\nx", "x \n", "ÉCOLE été, ﬁ ½ ² ٣ 漢字　漢", "á é", "tab\tx y", "x<|endoftext|> y",
        'a-b_c/d "q" (r) x... -- 3.5,2', "Ǆ ΣΑΣ. Σ", "ⅷ.", "x²,", "İi İ.",
    ]
    texts += ["".join(rng.choice("ab é\n .,'s　!1") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    for mark in SPECIAL:
        texts += [mark, f"{mark}at the start", f"{mark} apart", f"in the {mark} middle", f"at the end{mark}", f"in{mark}side\nété {mark}{mark}", f"{mark}\u0338 x"]
    for text in texts:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    end = plain.token_to_id("<|endoftext|>")
    assert end in np.frombuffer(coder.encode("a <|endoftext|> b"), "<u4")


@pytest.mark.parametrize("path", PATHS)
def test_special_strings_as_text(path):
    coder, plain = TextEncoder(path, as_text=True), Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for text in ["a <|endoftext|> b", "<|startoftext|>x", "y<|endoftext|>"]:
        ids = np.frombuffer(coder.encode(text), "<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids and plain.token_to_id("<|endoftext|>") not in ids


def fewest(sizes, most):
    """Sequences that any packing needs, by exhaustive search."""
    @cache
    def need(left):
        if not left:
            return 0
        first, rest = left[-1], left[:-1]
        best = len(left)

        def fill(room, at, chosen):
            nonlocal best
            best = min(best, 1 + need(tuple(s for i, s in enumerate(rest) if i not in chosen)))
            for i in range(at, -1, -1):
                if rest[i] <= room:
                    fill(room - rest[i], i - 1, chosen | {i})

        fill(most - first, len(rest) - 1, frozenset())
        return best

    return need(tuple(sorted(sizes)))


@pytest.mark.parametrize("seed", range(60))
def test_reduction_never_costs_a_sequence(seed):
    rng = random.Random(seed)
    most = rng.choice([10, 20, 30])
    sizes = [rng.randint(1, most) for _ in range(rng.randint(1, 8))]
    fixed, left = packing.reduced(Counter(sizes), most)
    rest = list(left.elements())
    assert sum(n for _, n in fixed) + fewest(rest, most) == fewest(sizes, most)
    patterns = packing.plan(Counter(sizes), most)
    assert all(sum(p) <= most for p, _ in patterns)
    assert Counter(s for p, n in patterns for s in p * n) == Counter(sizes)


def test_best_fit_by_groups_is_best_fit_one_by_one():
    rng = random.Random(8)
    for _ in range(30):
        sizes = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        rooms = []
        for s in sizes:
            fitting = [r for r in rooms if r >= s]
            room = min(fitting) if fitting else 40
            if fitting:
                rooms.remove(room)
            rooms.append(room - s)
        assert sum(n for _, n in packing.best_fit(Counter(sizes), 40)) == len(rooms)


def test_large_plans_are_near_the_bound():
    rng = random.Random(9)
    counts = Counter(min(1024, max(3, int(rng.lognormvariate(5.8, 1)))) for _ in range(200_000))
    used = sum(n for _, n in packing.plan(counts, 1024))
    assert used <= 1.002 * -(-sum(s * n for s, n in counts.items()) // 1024) + 1


def check(frame, rows, most):
    plain = Tokenizer.from_file(PATHS[0])
    cut = packing.pieces(frame, PATHS[0], 2, most, with_ids=True)
    packed = packing.pack(cut, most)
    got = packed.collect()
    expected = Counter()
    for row in rows:
        ids = [*plain.encode(row[1] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % most or most
        bounds = [0, *range(first, len(ids) + 1, most)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[(row[0], piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= most
    whole = {r["sequence_id"]: len(r["ids"]) // 4 for r in packing.sequences(cut, packed).collect()}
    assert whole == {s: sum(n for _, n in held) for s, held in places.items()}


def test_awkward_rows(awkward):
    check(awkward, AWKWARD, 64)


def test_nothing(nothing):
    assert packing.pack(packing.pieces(nothing, PATHS[0], 2, 64), 64).count() == 0


def test_one_length_for_most_rows(spark):
    rows = [(i, "same words here" if i % 3 else prose(i, 9)) for i in range(200)] + [(200, "hello <|endoftext|> world")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 16)
