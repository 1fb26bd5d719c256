"""What a worker keeps of the pieces it has met."""

import random
import sys

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, tokenising
from tidemark.llm.queries import tokenizer_path


def test_kept_pieces_stay_small_and_common_ones_stay(monkeypatch):
    coder = tokenising.TextEncoder(tokenizer_path("word_bpe_49k.json"))
    monkeypatch.setattr(tokenising, "MOST_PIECES", 500)
    plain = tokenising.TextEncoder(tokenizer_path("word_bpe_49k.json")).tokenizer
    for d in range(40):
        text = "the common words, and " + " ".join(f"{d * 100 + i}x" for i in range(100))
        assert list(memoryview(coder.encode(text)).cast("I")) == plain.encode(text, add_special_tokens=False).ids
    kept = set(coder.pieces) | set(coder.pieces.older)
    assert len(kept) < 1300 and {" common", " words", " and"} <= kept
    assert " words," not in kept


def test_long_pieces_count_by_their_length(monkeypatch):
    monkeypatch.setattr(tokenising, "MOST_CHARS", 100_000, raising=False)
    coder = tokenising.TextEncoder(tokenizer_path("word_bpe_49k.json"))
    for d in range(30):
        coder.encode(str(d) + "7" * 20_000)
    held = sum(sys.getsizeof(k) for store in (coder.pieces, coder.pieces.older) for k in store)
    assert held < 300_000


def test_words_with_marks_are_found_again(monkeypatch):
    """Of words met before, none is put together anew for each mark that follows it."""
    calls = []
    missing = tokenising._Pieces.__missing__
    monkeypatch.setattr(tokenising._Pieces, "__missing__", lambda self, piece: calls.append(piece) or missing(self, piece))
    monkeypatch.setattr(tokenising, "_encoders", {})
    texts = ["first words, second words. third words; first words!!\nsecond words, third words."] * 300
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": texts})
    (cut,) = packing._cut(tokenizer_path("byte_bpe_50k.json"), 2, 1024, True)(iter([batch]))
    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert all(list(memoryview(ids).cast("I")) == [*plain.encode(texts[0], add_special_tokens=False).ids, 2] for ids in cut.column("ids").to_pylist())
    assert len(calls) < 100


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_taken_together_keep_their_ids(monkeypatch, name):
    monkeypatch.setattr(tokenising, "TOGETHER", 200)
    coder, plain = tokenising.TextEncoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    rng = random.Random(4)
    parts = ["the", " word", " word,", "x-y_z.", " \u00e9t\u00e9.", " \u0130.", "\n", "\n\n", "  ", "!?", " don't.", "a.'s", "5,", "\0", "<|endoftext|>", "\u0338", "\u6f22\u5b57", "\xa0"]
    texts = ["", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)), "<|endoftext|>\u0338", ""]
    found = [list(memoryview(ids).cast("I")) for ids in coder.encode_all(texts)]
    assert found == [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert list(coder.encode_all([])) == []
