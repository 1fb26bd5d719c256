"""Token ids in shard files with a minimal perfect hash index, and keyed access to them.

A store is a folder of shards in ascending key order. `NAME.ids` is nothing but ids, 16 or 32 bits each. `NAME.idx`
holds, as little-endian arrays behind a JSON header: `starts` (ids before each document, one more
than there are documents), `keys` (the distinct ones, ascending), and the index. A key's hash is looked for in levels of bits: on each level,
keys that alone claim a place own it, the others go on to the next level; the number of bits before
a key's bit is its slot, a minimal perfect hash. Slots hold a fingerprint, which unknown keys fail, the number of the key's first
document and how many it has. The header has the documents without a key, and the manifest the range of keys of each shard. Keyed access opens
the shards whose range holds the key and costs a few reads at known places there, whatever a shard's size.

Files are written under names no other attempt uses; the manifest, itself written by Spark, lists those of
tasks that succeeded. Folders are reached by pyarrow's file systems, so local and shared paths work.

Defined cases: a null text is empty and has the end id alone. Rows without a key come first and are read in
order only; rows with one key follow each other, and the key leads to all of them. An empty table gives a store without shards.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored
from tidemark.llm.shingles import mix
from tidemark.llm.tokenising import ID, encoder

#: Places per key on a level of the index.
SPREAD = 2
_SEED = 0x9E3779B97F4A7C15
_PRINT = np.uint64(0xD1B54A32D192ED03)
READ_BYTES = 8 << 20
#: Bytes of the texts sent to a worker at once.
BATCH_BYTES = 4 << 20
#: Words that are read one by one; for more, the whole part is read once.
MOST_READS = 64


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: each known key has its own slot below their number."""

    def __init__(self, levels: np.ndarray, bits: np.ndarray, before: np.ndarray | None = None):
        # Places on each level; all levels' bits, 64 to a word; the bits before each word. Anything that gives words at places will do.
        self.levels, self.bits = levels, bits
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits).astype(np.int64)))) if before is None else before

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        left, levels, words = mix(keys.view(np.uint64)), [], []
        while len(left):
            places = -(-SPREAD * len(left) // 64) * 64
            at = PerfectHash._places(left, len(levels), places)
            alone = np.bincount(at, minlength=places) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            levels.append(places)
            left = left[~alone[at]]
        return PerfectHash(np.array(levels, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64))

    @staticmethod
    def _places(hashes: np.ndarray, level: int, places: int) -> np.ndarray:
        seed = np.uint64(_SEED * (level + 1) % (1 << 64))
        return (mix(hashes + seed) % np.uint64(places)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for keys that no level holds. An unknown key may get a known key's slot."""
        hashes, found = mix(keys.view(np.uint64)), np.full(len(keys), -1)
        todo, base = np.arange(len(keys)), 0
        for level, places in enumerate(self.levels):
            at = base + self._places(hashes[todo], level, int(places))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = self.bits[word]
            own = (held >> bit) & np.uint64(1) == 1
            lower = held & ((np.uint64(1) << bit) - np.uint64(1))
            found[todo[own]] = (self.before[word] + np.bitwise_count(lower))[own]
            todo, base = todo[~own], base + int(places)
        return found


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64) ^ _PRINT) >> np.uint64(32)).astype("<u4")


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def index_bytes(starts: np.ndarray, keys: np.ndarray, keyed: np.ndarray, width: int) -> bytes:
    """The index file of documents in file order, those without a key first."""
    known, first, held = np.unique(keys[keyed], return_index=True, return_counts=True)
    numbers = np.flatnonzero(keyed)[first]
    perfect = PerfectHash.build(known)
    prints, documents, counts = (np.zeros(len(known), "<u4") for _ in range(3))
    slots = perfect.slots(known)
    prints[slots], documents[slots], counts[slots] = fingerprints(known), numbers, held
    parts = {
        "starts": starts.astype("<i8"), "keys": known.astype("<i8"), "levels": perfect.levels.astype("<i8"), "bits": perfect.bits.astype("<u8"),
        "before": perfect.before.astype("<i8"), "prints": prints, "documents": documents, "counts": counts,
    }
    header = json.dumps({"width": width, "keyless": int((~keyed).sum()), "parts": {n: [a.dtype.str, len(a)] for n, a in parts.items()}}).encode()
    return len(header).to_bytes(8, "little") + header + b"".join(a.tobytes() for a in parts.values())


class _Words:
    """A part of an index file: words are read at their places, near ones together, very many from the whole part."""

    def __init__(self, shard: Shard, name: str):
        self.shard, self.name = shard, name

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        kind, n, at = self.shard.parts[self.name]
        if not len(places):
            return np.zeros(0, kind)
        low, high = int(places.min()), int(places.max())
        near = high - low < 4 * len(places)
        if self.name in self.shard.whole or len(places) > MOST_READS and not (near and len(places) * 2 < n):
            return self.shard.part(self.name)[places]
        with self.shard.files.open_input_file(self.shard.path) as f:
            if near:
                return np.frombuffer(f.read_at((high + 1 - low) * kind.itemsize, at + low * kind.itemsize), kind)[places - low]
            read = [f.read_at(kind.itemsize, at + int(p) * kind.itemsize) for p in places]
        return np.frombuffer(b"".join(read), kind)


class Shard:
    """Keyed and ordered access to one shard."""

    def __init__(self, folder: str, name: str):
        self.files, root = _open(folder)
        self.path, self.ids_path = f"{root}/{name}.idx", f"{root}/{name}.ids"
        with self.files.open_input_file(self.path) as f:
            size = int.from_bytes(f.read_at(8, 0), "little")
            header = json.loads(f.read_at(size, 8))
        at, self.parts = 8 + size, {}
        for part, (kind, n) in header["parts"].items():
            self.parts[part] = np.dtype(kind), n, at
            at += n * np.dtype(kind).itemsize
        self.keyless, self.kind = header["keyless"], np.dtype("<u2" if header["width"] == 2 else "<u4")
        self.whole: dict[str, np.ndarray] = {}
        self.levels = None

    def part(self, name: str) -> np.ndarray:
        """A whole part, kept."""
        if name not in self.whole:
            kind, n, at = self.parts[name]
            with self.files.open_input_file(self.path) as f:
                self.whole[name] = np.frombuffer(f.read_at(n * kind.itemsize, at), kind)
        return self.whole[name]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each key's first document, -1 for keys that are not here, and how many documents the key has."""
        keys = np.ascontiguousarray(keys, np.int64)
        if not self.parts["prints"][1] or not len(keys):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        if self.levels is None:
            self.levels = _Words(self, "levels")[np.arange(self.parts["levels"][1])]
        slots = PerfectHash(self.levels, _Words(self, "bits"), _Words(self, "before")).slots(keys)
        safe = np.maximum(slots, 0)
        known = (slots >= 0) & (_Words(self, "prints")[safe] == fingerprints(keys))
        first, counts = (_Words(self, n)[safe].astype(np.int64) for n in ("documents", "counts"))
        return np.where(known, first, -1), np.where(known, counts, 0)

    def starts(self, numbers: np.ndarray) -> np.ndarray:
        """Ids before the documents with these numbers."""
        return _Words(self, "starts")[numbers]

    def ids(self, first: int, end: int) -> np.ndarray:
        """Ids from place `first` to `end`, read from there."""
        with self.files.open_input_file(self.ids_path) as f:
            return np.frombuffer(f.read_at((end - first) * self.kind.itemsize, first * self.kind.itemsize), self.kind)

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document with the key."""
        number, n = (int(x[0]) for x in self.find(np.array([key])))
        if number < 0:
            return []
        edges = self.starts(np.arange(number, number + n + 1))
        return [self.ids(int(a), int(b)) for a, b in zip(edges, edges[1:])]


class Store:
    """Keyed access to all shards of a store; its manifest has a row per shard."""

    def __init__(self, manifest: DataFrame, folder: str):
        rows = manifest.orderBy("shard").collect()
        self.ranges = [(r["least"], r["greatest"]) for r in rows]
        self.shards = [Shard(folder, r["name"]) for r in rows]

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document with the key, which the ranges of a few shards at most can hold."""
        able = [s for s, (low, high) in zip(self.shards, self.ranges, strict=True) if low is not None and low <= key <= high]
        return [ids for shard in able for ids in shard.get(key)]


def _written(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        width = 2 if max(coder.vocabulary - 1, end_id) < 1 << 16 else 4
        kind, end = np.dtype("<u2" if width == 2 else "<u4"), np.array([end_id], ID).tobytes()
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        lengths, keys, keyed, out = [], [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files, root = _open(folder)
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(f"{root}/{name}.ids")
            for text_ids in coder.encode_all(text or "" for text in batch.column("text").to_pylist()):
                ids = np.frombuffer(text_ids + end, ID)
                out.write(ids.astype(kind).tobytes())
                lengths.append(len(ids))
            column = batch.column("doc_id")
            keyed.append(column.is_valid().to_numpy(zero_copy_only=False))
            keys.append(column.fill_null(0).to_numpy())
        if out is None:
            return
        out.close()
        starts = np.concatenate(([0], np.cumsum(lengths)))
        with files.open_output_stream(f"{root}/{name}.idx") as f:
            numbers, known = np.concatenate(keys), np.concatenate(keyed)
            f.write(index_bytes(starts, numbers, known, width))
        held = numbers[known]
        row = [shard], [name], [len(lengths)], [int(starts[-1])], [int(held.min()) if len(held) else None], [int(held.max()) if len(held) else None]
        yield pa.RecordBatch.from_pydict(dict(zip(_MANIFEST.names, row, strict=True)), _MANIFEST)

    return run


_MANIFEST = pa.schema(
    [("shard", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("least", pa.int64()), ("greatest", pa.int64())]
)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the documents' shards below the folder in ascending doc_id order; the manifest."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.sort(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return stored(ordered.mapInArrow(_written(folder, tokenizer, end_id), "shard int, name string, n_docs long, n_ids long, least long, greatest long"), "token-manifest")


def _read(folder: str):
    """Documents in file order: those without a key by their places, the others by their keys, each looked up in the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = Shard(folder, name)
                known = shard.part("keys")
                first, counts = shard.find(known)
                if (first < 0).any():
                    raise ValueError(f"{name}: the index misses key {known[first < 0][0]}")
                within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                numbers = np.concatenate([np.arange(shard.keyless), np.repeat(first, counts) + within])
                keys = np.concatenate([np.zeros(shard.keyless, np.int64), np.repeat(known, counts)])
                begins, ends = shard.starts(numbers), shard.starts(numbers + 1)
                at, step = 0, READ_BYTES // shard.kind.itemsize
                while at < len(numbers):
                    end = max(at + 1, int(np.searchsorted(begins, begins[at] + step, "right")) - 1)
                    ids = shard.ids(int(begins[at]), int(ends[end - 1])).astype(ID)
                    checks = [zlib.crc32(ids[a:b]) for a, b in zip(begins[at:end] - begins[at], ends[at:end] - begins[at], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[at:end], pa.int64(), mask=np.arange(at, end) < shard.keyless), pa.array(base + begins[at:end]),
                            pa.array(ends[at:end] - begins[at:end]), pa.array(checks, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    at = end

    return run


def read(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files; the driver sees a row per shard."""
    shards, base = [], 0
    for r in manifest.orderBy("shard").collect():
        shards.append((r["name"], base))
        base += r["n_ids"]
    rows = spark.createDataFrame(shards, "name string, base long").repartition(max(1, len(shards)))
    return rows.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
