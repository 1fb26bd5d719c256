from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, label int, digest string, rank int"
_WORDS = [a + b + c for a in ("ba", "ke", "lo", "mu") for b in ("r", "n", "s", "ti", "") for c in ("a", "o", "e", "el", "um")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(_WORDS) + rng.choice(_WORDS) for _ in range(n)]
    return "".join(w + ("\n" if i % 12 == 11 else " ") for i, w in enumerate(words)).strip()


def doc(doc_id, text, lang="en", source="s0"):
    """A document with extra columns whose names operators use themselves."""
    return (doc_id, text, lang, source, None if text is None else len(text), 1, "x", 7, "d", 3)


AWKWARD = [
    doc(1, None), doc(2, ""), doc(3, " \n\t "), doc(4, "one"), doc(5, "two words", None, None), doc(6, "two words", None, None),
    doc(7, prose(1, 4000)), doc(8, prose(2, 60)), doc(8, prose(2, 60)), doc(None, prose(3, 40)), doc(None, None, "de", "s1"),
    doc(9, "Zeile eins\nZeile eins\nZeile eins", "de", "s1"), doc(10, "x" * 5000), doc(11, "nul\0 byte 　 wide é"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows and ids, and clashing column names."""
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(8, 1, 0), (4, 0, 1), (5, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
