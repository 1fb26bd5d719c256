"""Word shingles of whole texts as 64-bit hashes, in numpy, a bounded run of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are hashed together up to this many bytes; a longer text alone.
CHUNK = 1 << 20
_TABLE_ROWS = 64
_random = np.random.default_rng(20240607)
#: One random number per byte and place in its word.
_TABLE = _random.integers(0, 1 << 64, size=_TABLE_ROWS * 256, dtype=np.uint64)
_ODD = _random.integers(0, 1 << 64, size=64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held, places


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A to Z lower-cased, and the number of words of each text; text i begins at
    starts[i]. Words are runs of bytes other than space and 9 to 13."""
    held = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    solid = (held != 32) & ((held < 9) | (held > 13))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edge = starts[starts < len(data)]
    first[edge] = solid[edge]
    begins = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(begins, np.append(starts, len(data))))
    if not len(begins):
        return np.zeros(0, np.uint64), counts
    inside = np.flatnonzero(solid)
    head = np.searchsorted(inside, begins)
    lengths = np.diff(np.append(head, len(inside)))
    place = np.arange(len(inside)) - np.repeat(head, lengths)
    value = _TABLE[((place & (_TABLE_ROWS - 1)) << 8) | held[inside]]
    if lengths.max() > _TABLE_ROWS:
        value = value * (2 * (place >> 6) + 1).astype(np.uint64)
    return mix(np.add.reduceat(value, head) + lengths.astype(np.uint64)), counts


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first text's number, the texts' distinct shingle hashes one after another,
    and the number of hashes of each. A text with fewer words than `size` has one shingle of all."""
    data, places = text_bytes(column)
    at, total = 0, len(places) - 1
    while at < total:
        end = max(at + 1, int(np.searchsorted(places, places[at] + CHUNK, "right")) - 1)
        hashes, counts = word_hashes(data[places[at] : places[end]], places[at:end] - places[at])
        bounds = np.concatenate(([0], np.cumsum(counts)))
        long = len(hashes) - size + 1
        rolled = np.zeros(max(long, 0), np.uint64)
        for k in range(size):
            rolled += hashes[k : k + len(rolled)] * _ODD[k]
        rolled = mix(rolled)
        sets = []
        for i, n in enumerate(counts):
            if n >= size:
                sets.append(np.unique(rolled[bounds[i] : bounds[i + 1] - size + 1]))
            elif n:
                part = hashes[bounds[i] : bounds[i + 1]] * _ODD[:n]
                sets.append(mix(part.sum(keepdims=True) + np.uint64(n)))
            else:
                sets.append(rolled[:0])
        yield at, np.concatenate(sets), np.array([len(s) for s in sets])
        at = end
