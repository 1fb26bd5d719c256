"""Near-duplicate documents by min-max hashing.

A text's set holds its distinct word shingles. Every permutation gives two signature values, the least and
the greatest hash, so `PERMUTATIONS` hash evaluations fill twice as many slots. Two permutations, four slots, make
a band; texts that agree on a band are candidates, and a candidate pair becomes a link only when the
full sets pass the threshold. With 24 bands a pair at 0.8 is missed with a chance of about 3e-6.

Equal sets are one node from the start. A node is first compared with the one bucket centre it shares most bands
with. Buckets that then hold several components go on: the pairs of those with up to `SMALL_BUCKET`
members are compared; in larger ones members outside the largest component are compared with other
members of it, and what is still outside with all others around the same component in blocks, which give
back links only. Pairs inside a component need no comparison, so the components are those of all
candidate links. Before texts are sent for a pair, one byte of each of its signature slots is compared; pairs
more than `DEVIATIONS` standard deviations below the threshold go, a link with a chance of about 5e-7.

Defined cases: a text without words has an empty set and links with nothing. A null doc_id takes part
under a number made from its text; its component is named by the least doc_id that is not null. Rows
with one doc_id are one document: different texts under it are joined. Repeated rows get equal
results. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored
from tidemark.llm.components import components
from tidemark.llm.shingles import mix, shingle_sets

PERMUTATIONS = 48
BANDS = PERMUTATIONS // 2
#: Keys that may be broadcast, 16 MB of them.
BROADCAST_KEYS = 2_000_000
#: Members of a bucket whose pairs are all compared one by one.
SMALL_BUCKET = 6
#: Rounds in which members outside the largest component meet one more member of it.
STAR_ROUNDS = 2
#: Shingles of the texts in a block, and columns of a block's incidence matrix at a time.
DEVIATIONS = 4.9
BLOCK_SHINGLES, BLOCK_COLUMNS = 1 << 17, 1 << 13
_random = np.random.default_rng(77)
_FLIP = _random.integers(0, 1 << 64, size=PERMUTATIONS, dtype=np.uint64)
_TIMES = _random.integers(0, 1 << 64, size=PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_BAND_KEYS = _random.integers(0, 1 << 64, size=(BANDS, 5), dtype=np.uint64) | np.uint64(1)
_SET_SCHEMA = "key long, doc_id long, n_shingles long, print binary, sketch binary, bands array<long>"


def min_max(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least and greatest hash of each non-empty set under each permutation: 2 x permutations x sets."""
    found = np.empty((2, PERMUTATIONS, len(starts)), np.uint64)
    for k in range(PERMUTATIONS):
        permuted = (hashes ^ _FLIP[k]) * _TIMES[k]
        np.minimum.reduceat(permuted, starts, out=found[0, k])
        np.maximum.reduceat(permuted, starts, out=found[1, k])
    return found


def band_hashes(slots: np.ndarray) -> np.ndarray:
    """One number per set and band, from the band's four slots; numbers of different bands differ."""
    least, most = slots[:, 0::2], slots[:, 1::2]
    keys = _BAND_KEYS[:, :, None]
    return mix(
        mix(least[0] * keys[:, 0]) + mix(least[1] * keys[:, 1]) + mix(most[0] * keys[:, 2]) + mix(most[1] * keys[:, 3]) + keys[:, 4]
    ).T


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, prints, sketches, bands = [], [], [], []
            for _, hashes, sizes in shingle_sets(batch.column("text"), size):
                full = np.flatnonzero(sizes)
                starts = np.concatenate(([0], np.cumsum(sizes[full])))[:-1].astype(np.int64)
                halves = np.zeros((len(sizes), 2), np.uint64)
                own = np.zeros((len(sizes), BANDS), np.uint64)
                bytes_ = np.zeros((len(sizes), 2 * PERMUTATIONS), np.uint8)
                if len(full):
                    halves[full, 0] = np.add.reduceat(mix(hashes), starts)
                    halves[full, 1] = np.add.reduceat(mix(hashes ^ _FLIP[0]), starts)
                    slots = min_max(hashes, starts)
                    own[full] = band_hashes(slots)
                    bytes_[full] = (mix(slots) & np.uint64(255)).astype(np.uint8).reshape(2 * PERMUTATIONS, -1).T
                counts.append(sizes)
                prints += [h.tobytes() for h in halves]
                sketches += [b.tobytes() for b in bytes_]
                bands.append(own)
            if not counts:
                continue
            n = np.concatenate(counts)
            flat = np.concatenate(bands)[n > 0].astype(np.int64, casting="unsafe").ravel()
            ends = np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(sketches, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["key", "doc_id", "n_shingles", "print", "sketch", "bands"],
            )

    return run


def _likely(percent: int):
    """Pairs whose signatures do not speak against the threshold."""
    n, share = 2 * PERMUTATIONS, percent / 100
    least = n * share - DEVIATIONS * (n * share * (1 - share)) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, n) for c in ("sketch_a", "sketch_b"))
                held = pa.array((a == b).sum(1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(held)

    return run


def _confirmed(size: int, percent: int):
    """Pairs whose full sets share at least `percent` of their union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("text_a", "text_b"):
                column = batch.column(name).dictionary_encode()  # a centre stands in many rows
                sets = []
                for _, hashes, sizes in shingle_sets(column.dictionary, size):
                    sets += np.split(hashes, np.cumsum(sizes)[:-1])
                sides.append([sets[i] for i in column.indices.to_numpy()])
            held = []
            for x, y in zip(*sides, strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                held.append(100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(held, pa.bool_()))

    return run


def _sets(column: pa.ChunkedArray, size: int) -> list[np.ndarray]:
    found: list[np.ndarray] = []
    for _, hashes, sizes in shingle_sets(column, size):
        found += np.split(hashes, np.cumsum(sizes)[:-1])
    return found


def _incidence(sets: list[np.ndarray], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of ones: which set holds which of the sorted columns; ordered by column."""
    flat = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
    held = columns[at] == flat
    rows, at = rows[held], at[held]
    order = np.argsort(at, kind="stable")
    return rows[order], at[order]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Size of the intersection of every left with every right set, counting the given hashes."""
    counts = np.zeros((len(left), len(right)), np.float32)
    if not len(columns):
        return counts
    sides = [_incidence(left, columns), _incidence(right, columns)]
    for first in range(0, len(columns), BLOCK_COLUMNS):
        dense = []
        for (rows, at), n in zip(sides, counts.shape, strict=True):
            a, b = np.searchsorted(at, (first, first + BLOCK_COLUMNS))
            part = np.zeros((n, min(BLOCK_COLUMNS, len(columns) - first)), np.float32)
            part[rows[a:b], at[a:b] - first] = 1
            dense.append(part)
        counts += dense[0] @ dense[1].T
    return counts


def _block_links(size: int, percent: int):
    """Links between texts outside a component and other texts around it, one per text and component."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            mine, others = _sets(left.column("text"), size), _sets(right.column("text"), size)
            a, b = left.column("node").to_numpy(), right.column("node").to_numpy()
            label_a, label_b = left.column("label").to_numpy(), right.column("label").to_numpy()
            values, times = np.unique(np.concatenate(others), return_counts=True)
            apart = [s for s, node in zip(mine, a, strict=True) if node not in set(b.tolist())]
            columns = values[times > 1]
            if apart:
                columns = np.union1d(columns, np.intersect1d(values, np.concatenate(apart)))
            shared = shared_counts(mine, others, columns)
            union = np.array([len(s) for s in mine])[:, None] + np.array([len(s) for s in others]) - shared
            held = (100 * shared >= percent * union) & (shared > 0) & (label_a[:, None] != label_b)
            for i in np.flatnonzero(held.any(1)):
                hits = np.flatnonzero(held[i])
                _, firsts = np.unique(label_b[hits], return_index=True)
                found += [(int(a[i]), int(b[j])) for j in hits[firsts]]
        columns_out = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": columns_out[:, 0], "b": columns_out[:, 1]})

    return run


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    stand_in = -(F.shiftrightunsigned(F.xxhash64(whole), 2)) - F.lit(2)
    number = F.col(doc_id).cast("long")
    return docs.select(F.coalesce(number, stand_in).alias("key"), number.alias("doc_id"), whole.alias("text"))


class _Links:
    """Pairs compared so far and those of them that are links."""

    def __init__(self, keyed: DataFrame, sketches: DataFrame, size: int, percent: int):
        self.keyed, self.sketches, self.size, self.percent = keyed, sketches, size, percent
        self.seen: DataFrame | None = None
        self.links: DataFrame | None = None

    def _texts(self, needed: DataFrame) -> DataFrame:
        """(key, text) of the needed keys. Up to BROADCAST_KEYS of them go to every task, so that the other
        texts are not shuffled only to be left out; more are joined by a shuffle of all texts."""
        needed = stored(needed, "near-needed")
        marked = F.broadcast(needed) if needed.count() <= BROADCAST_KEYS else needed
        return self.keyed.join(marked, "key", "left_semi").select("key", "text").distinct()

    def compare_around(self, open_rows: DataFrame) -> None:
        """Adds the links of members outside their bucket's largest component, block by block."""
        around = open_rows.groupBy("main", "node").agg(F.first("label").alias("label"), F.first("n").alias("n"))
        blocks = around.groupBy("main").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
        texts = self._texts(around.select(F.col("node").alias("key")).distinct())
        whole = stored(around.join(blocks, "main").join(texts.withColumnRenamed("key", "node"), "node"), "near-around")
        own, every = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        left = whole.where("label <> main").select("main", "node", "label", "text", own.alias("i"), every.alias("j"))
        right = whole.select("main", "node", "label", "text", every.alias("i"), own.alias("j"))
        grouped = left.groupBy("main", "i", "j").cogroup(right.groupBy("main", "i", "j"))
        found = stored(grouped.applyInArrow(_block_links(self.size, self.percent), "a long, b long"), "near-links")
        self.links = self.links.unionByName(found)

    def compare(self, pairs: DataFrame) -> None:
        """Adds the links among the pairs (a, b, n_a, n_b), each compared once."""
        fits = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        ordered = pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        if self.seen is not None:
            ordered = ordered.join(self.seen, ["a", "b"], "left_anti")
        every = stored(ordered, "near-pairs")
        sketched = every
        for side in "ab":
            sketched = sketched.join(self.sketches.select(F.col("node").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)
        fresh = stored(sketched.mapInArrow(_likely(self.percent), "a long, b long"), "near-likely")
        texts = self._texts(fresh.select(F.col("a").alias("key")).union(fresh.select(F.col("b").alias("key"))).distinct())
        paired = fresh.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(
            texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"
        )
        found = stored(paired.mapInArrow(_confirmed(self.size, self.percent), "a long, b long"), "near-links")
        self.seen = every if self.seen is None else self.seen.unionByName(every)
        self.links = found if self.links is None else self.links.unionByName(found)


def _unjoined(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket members with their component and its largest component, where there are several."""
    named = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counted = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n_members"))
    several = counted.groupBy("bucket").agg(
        F.max_by("label", F.struct("n_members", "label")).alias("main"), F.count(F.lit(1)).alias("n_labels")
    ).where("n_labels > 1")
    return named.join(several.select("bucket", "main"), "bucket")


def _one_document(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) from each key that stands in several classes to the nodes of those classes."""
    spread = full.groupBy("key").agg(F.min(F.xxhash64("print")).alias("first"), F.max(F.xxhash64("print")).alias("last"))
    rows = full.select("key", "print").join(spread.where("first <> last").select("key"), "key", "left_semi")
    named = rows.join(classes.select("print", "node"), "print").where("key <> node")
    return named.select(F.col("key").alias("a"), F.col("node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, text, doc_id)
    signed = stored(keyed.mapInArrow(_signed(size), _SET_SCHEMA), "near-sets")
    full = signed.where("n_shingles > 0")
    classes = stored(full.groupBy("print").agg(F.min("key").alias("node"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n")), "near-classes")
    heads = full.join(classes.select("print", F.col("node").alias("key"), "n"), ["print", "key"], "left_semi").dropDuplicates(["print", "key"])
    everywhere = heads.select(F.col("key").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = everywhere.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"), F.count(F.lit(1)).alias("n_nodes")).where("n_nodes > 1")
    buckets = stored(everywhere.join(shared, "bucket").select("bucket", "node", "n", "n_nodes", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n")), "near-buckets")

    sketches = heads.select(F.col("key").alias("node"), "sketch")
    links = _Links(keyed, sketches, size, percent)
    links.links = stored(_one_document(full, classes), "near-links")
    shared_bands = buckets.where("node <> centre").groupBy("node", "n", "centre", "centre_n").agg(F.count(F.lit(1)).alias("bands"))
    nearest = shared_bands.groupBy("node", "n").agg(F.max_by(F.struct("centre", "centre_n"), F.struct("bands", "centre")).alias("c"))
    links.compare(nearest.select(F.col("c.centre").alias("a"), F.col("node").alias("b"), F.col("c.centre_n").alias("n_a"), F.col("n").alias("n_b")))
    labels = components(links.links)
    for turn in range(STAR_ROUNDS + 1):
        members = buckets if turn == 0 else buckets.where(F.col("n_nodes") > SMALL_BUCKET)
        open_rows = stored(_unjoined(members.select("bucket", "node", "n", "n_nodes"), labels), "near-open")
        if open_rows.isEmpty():
            break
        if turn == STAR_ROUNDS:
            links.compare_around(open_rows)
        else:
            large = open_rows.where(F.col("n_nodes") > SMALL_BUCKET)
            outside = large.where("label <> main").select("bucket", F.col("node").alias("a"), F.col("n").alias("n_a"))
            drawn = large.where("label = main").groupBy("bucket").agg(
                F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(turn))).alias("m"))
            pairs = outside.join(drawn, "bucket").select("a", F.col("m.node").alias("b"), "n_a", F.col("m.n").alias("n_b"))
            if turn == 0:
                small = open_rows.where(F.col("n_nodes") <= SMALL_BUCKET)
                few = small.select("bucket", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("label_a")).join(
                    small.select("bucket", F.col("node").alias("b"), F.col("n").alias("n_b"), "label"), "bucket")
                pairs = pairs.unionByName(few.where("a < b AND label <> label_a").select("a", "b", "n_a", "n_b"))
            links.compare(pairs)
        labels = components(links.links)

    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    resolved = stored(named.join(least, "label").select("print", "component_id"), "near-resolved")
    result = signed.drop("bands", "sketch").join(resolved, "print", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
