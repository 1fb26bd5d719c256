"""Token ids of whole texts by a public tokenizer file, with the ids of words kept between texts.

Both kinds of tokenizer cut a text at blanks before they merge anything, so a text's ids are the ids
of its pieces one after another. Looking pieces up took a quarter of the time of encoding texts whole. Texts are taken
some megabytes together: each piece is looked up once among them, and Arrow lays the ids out.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from struct import pack
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa

#: Ids are little-endian unsigned 32-bit integers.
ID = np.dtype("<u4")
#: Pieces and characters in each of the two generations a Python worker keeps; a piece takes some 130 bytes.
MOST_PIECES, MOST_CHARS = 400_000, 8_000_000
#: Characters of the texts whose pieces are looked up together.
TOGETHER = 4_000_000
#: After a letter these always begin a piece of their own, and none of them begins a contraction.
_MARKS = '.,;:!?*$%&#|"()[]{}-_/'
#: Bytes of a text: 1 space, 2 line feed, 3 such a mark, 4 unaccented letter, 0 others.
_KINDS = np.zeros(256, np.uint8)
for _kind, _chars in enumerate((" ", "\n", _MARKS, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), 1):
    _KINDS[list(_chars.encode())] = _kind
#: Blanks other than single spaces and line feeds between words: such texts are encoded whole.
_OTHER_BLANKS = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: All characters that have "<" in a normal form.
_OPENERS = "<\u226e\ufe64\uff1c"


#: Bytes as the characters that stand for them in byte-level vocabularies: printable ones are
#: themselves, the others follow from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _PLAIN} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PLAIN))
}


class _ByteChars(dict):
    """By code point, the characters that stand for its bytes in UTF-8."""

    def __missing__(self, point: int) -> str:
        self[point] = chars = "".join(_BYTE_CHARS[b] for b in chr(point).encode())
        return chars


_BYTES_OF = _ByteChars()
_PROBES = ["a", "the", " of", "Under", " word", "ABC", "straße", " été", "ñandú", "Über", "漢字", " тест", "ab", "thereof"]


def _ids(ids: list[int]) -> bytes:
    held = array("I", ids)
    if sys.byteorder != "little":
        held.byteswap()
    return held.tobytes()


class _Pieces(dict):
    """Ids by piece; an absent one is encoded and kept, without the marks that end it. A full store becomes the older generation, out of which pieces that
    are met again are taken, so that common ones stay.
    """

    def __init__(self, tokenizer, drops_blanks: bool):
        super().__init__()
        self.older, self.chars = {}, 0
        self.tokenizer, self.model, self.drops_blanks = tokenizer, tokenizer.model, drops_blanks
        self.short_cut = True
        self.short_cut = all(self._letters(p) == self._whole(p) for p in _PROBES)

    def _whole(self, piece: str) -> bytes:
        return _ids(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _letters(self, piece: str) -> bytes:
        """The ids of a piece of letters, which is merged as one; asking the model itself saves a third."""
        spaced = piece[0] == " "
        word = piece[1:] if spaced else piece
        plain = piece.isascii()
        if not (self.short_cut and word.isalpha() and (plain or is_normalized("NFC", piece) and "Σ" not in piece)):
            return self._whole(piece)
        if self.drops_blanks:
            word = word.lower()
            if not (plain or word.isalpha()):
                return self._whole(piece)
        if not plain:
            word = word.translate(_BYTES_OF)
        if spaced and not self.drops_blanks:
            word = _BYTE_CHARS[32] + word
        tokens = self.model.tokenize(word)
        return pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def __missing__(self, piece: str) -> bytes:
        word = piece[-1:].isalpha()
        if not word:
            stem = piece.rstrip(_MARKS)
            # Lower-casing may end a word in a mark, which a following mark would join.
            if stem and stem != piece and stem[-1].isalpha() and stem[-1].lower()[-1].isalpha():
                return self[stem] + self[piece[len(stem):]]
        ids = self.older.get(piece)
        if ids is None:
            ids = self._letters(piece) if word else self._whole(piece)
        if len(self) > MOST_PIECES or self.chars > MOST_CHARS:
            self.older, self.chars = dict(self), 0
            self.clear()
        self[piece] = ids
        self.chars += len(piece)
        return ids


class TextEncoder:
    """Encodes texts as the library does with its defaults: a special token's string in a text becomes that token's id.
    With `as_text` such strings are ordinary text, so that no text can hold a control id.
    """

    def __init__(self, path: str, as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = as_text
        #: Texts that may hold these go to the library whole.
        self.added = [] if as_text else [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.opened = all("<" in token for token in self.added)
        self.drops_blanks = not self.tokenizer.encode(" \n ", add_special_tokens=False).ids
        self.pieces = _Pieces(self.tokenizer, self.drops_blanks)
        self.vocabulary = self.tokenizer.get_vocab_size()

    def encode(self, text: str) -> bytes:
        """The ids of the whole text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each whole text."""
        held, chars = [], 0
        for text in texts:
            held.append(text)
            chars += len(text)
            if chars >= TOGETHER:
                yield from self._together(held)
                held, chars = [], 0
        if held:
            yield from self._together(held)

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        whole = [self._goes_whole(text) for text in texts]
        rest = pa.array(["" if w else text for w, text in zip(whole, texts, strict=True)], pa.large_string())
        _, places, data = rest.buffers()
        ends = np.frombuffer(places, np.int64)[: len(texts) + 1]
        kinds = _KINDS[np.frombuffer(data or b"", np.uint8)[: ends[-1]]]
        # Pieces begin at texts, spaces and line feeds, after these, and at marks after a letter.
        begins = np.append(kinds == 1, False)
        begins[1:-1] |= (kinds[1:] == 3) & (kinds[:-1] == 4)
        feeds = np.flatnonzero(kinds == 2)
        begins[feeds] = begins[feeds + 1] = begins[ends] = True
        cuts = np.flatnonzero(begins)
        pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), data).dictionary_encode()
        met = pieces.dictionary.to_numpy(zero_copy_only=False)
        known = pa.array(list(map(self.pieces.__getitem__, met)), pa.large_binary())
        _, places, data = known.take(pieces.indices).buffers()
        ids = memoryview(data or b"")
        at = np.frombuffer(places, np.int64)[np.searchsorted(cuts, ends)].tolist() if len(cuts) > 1 else [0] * len(ends)
        for text, w, a, b in zip(texts, whole, at, at[1:]):
            yield self._library(text) if w else bytes(ids[a:b])

    def _library(self, text: str) -> bytes:
        return _ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _goes_whole(self, text: str) -> bool:
        return "\0" in text or not self.drops_blanks and self._has_runs(text) or bool(self.added) and self._may_hold_added(text)

    def _may_hold_added(self, text: str) -> bool:
        """Whether a token's string is in the text in any spelling that the library may bring to it."""
        if self.opened and not any(c in text for c in _OPENERS):
            return False
        lower = text.lower()
        if not text.isascii():
            lower += "\0" + normalize("NFKC", text).lower()
        return any(token in lower for token in self.added)

    @staticmethod
    def _has_runs(text: str) -> bool:
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return True
        return any(blank in text for blank in _OTHER_BLANKS)


_encoders: dict[tuple[str, bool], TextEncoder] = {}


def encoder(path: str, as_text: bool = False) -> TextEncoder:
    """This worker's encoder for the file."""
    key = path, as_text
    if key not in _encoders:
        _encoders[key] = TextEncoder(*key)
    return _encoders[key]
