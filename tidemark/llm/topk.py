"""Exact top-k search: tiled products of queries and vectors, partial selection, merging of lists.

Queries are dealt over tiles and vectors over shards by hashes of their ids. Each pair of a tile and a shard is
one group: its products are computed in blocks of bounded size, and a block's k best per query are merged
into the lists so far. The shards' lists of a query are merged in a tree: in each round, up to FAN_IN lists become one of k.
Whole numbers whose products stay below 2^53 are multiplied as doubles, which is exact; larger ones as integers.

Defined cases: rows with a null id, and vectors that are null, empty or hold a null or non-finite value, take no part.
Vectors meet only vectors of the same length. Rows that share an id all take part: a vector is found once for
each of its rows, and the query rows of one id share one list of k. Ties go to the smaller id. A query finds no vector of its own id.
Scores beyond 64 bits stop at the limits. Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Numbers in a tile of queries and in a shard of vectors, and rows of one product block.
TILE_NUMBERS, SHARD_NUMBERS = 1 << 18, 1 << 20
BLOCK_ROWS, BLOCK_COLUMNS = 256, 8192
#: Lists that one merge takes.
FAN_IN = 32
_LIMIT = 2.0**63
_SCHEMA = "query_id long, vec_id long, score long, part int"


def whole_vectors(rows: DataFrame, vec_id: str, embedding: str, scale: float) -> DataFrame:
    """(id, v, dims) with every component turned into floor(scale * x), of rows that take part."""
    x = F.col(embedding)
    numbers = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    fine = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")) & ~F.isnan(c.cast("double")))
    kept = rows.where(F.col(vec_id).isNotNull() & (F.size(x) > 0) & F.coalesce(fine, F.lit(False)))
    return kept.select(F.col(vec_id).cast("long").alias("id"), numbers.alias("v"), F.size(x).alias("dims"))


def _matrix(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and their vectors as rows."""
    ids = table.column("id").to_numpy()
    flat = table.column("v").combine_chunks()
    values = np.asarray((flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat).flatten()).reshape(len(ids), dims)
    order = np.argsort(ids, kind="stable")
    return ids[order], values[order]


def _products(q: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return q @ v.T
    wide = q.astype(object) @ v.astype(object).T
    return np.clip(wide, -(2**63), 2**63 - 1).astype(np.int64)


def _others(ids: np.ndarray, scores: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Without the rows of the query's own id; ids ascend."""
    a, b = np.searchsorted(ids, [own, own + 1])
    return (ids, scores) if a == b else (np.delete(ids, slice(a, b)), np.delete(scores, slice(a, b)))


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller place."""
    if len(scores) <= k:
        return np.argsort(-scores, kind="stable")
    limit = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > limit)
    level = np.flatnonzero(scores == limit)[: k - len(above)]
    chosen = np.sort(np.concatenate([above, level]))
    return chosen[np.argsort(-scores[chosen], kind="stable")]


def _searched(k: int):
    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if queries.num_rows and vectors.num_rows:
            dims = key[0].as_py()
            query_ids, q = _matrix(queries, dims)
            ids, v = _matrix(vectors, dims)
            exact = float(np.abs(q.astype(float)).max()) * float(np.abs(v.astype(float)).max()) * dims < 2.0**53
            if exact:
                q, v = q.astype(np.float64), v.astype(np.float64)
            for at in range(0, len(query_ids), BLOCK_ROWS):
                own = query_ids[at : at + BLOCK_ROWS]
                lists = [(ids[:0], np.zeros(0, np.float64 if exact else np.int64))] * len(own)
                for first in range(0, len(ids), BLOCK_COLUMNS):
                    part = ids[first : first + BLOCK_COLUMNS]
                    scores = _products(q[at : at + BLOCK_ROWS], v[first : first + BLOCK_COLUMNS], exact)
                    for r, query in enumerate(own):
                        others, found = _others(part, scores[r], query)
                        top = best(found, k)
                        held = np.concatenate([lists[r][0], others[top]]), np.concatenate([lists[r][1], found[top]])
                        order = np.lexsort((held[0], -held[1]))[:k]
                        lists[r] = held[0][order], held[1][order]
                for query, (found, score) in zip(own, lists, strict=True):
                    out.append(np.stack([np.full(len(found), query), found, score.astype(np.int64)]))
        columns = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        part = pa.array(np.full(columns.shape[1], key[2].as_py(), np.int32))
        return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2], "part": part})

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best; both frames are (id, v, dims)."""
    sizes = {}
    for name, frame in (("q", queries), ("v", vectors)):
        r = frame.agg(F.sum("dims").alias("n")).first()
        sizes[name] = r["n"] or 0
    tiles, shards = max(1, -(-sizes["q"] // TILE_NUMBERS)), max(1, -(-sizes["v"] // SHARD_NUMBERS))

    def dealt(frame: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        # Aliases keep the columns of both sides apart where they come from one table.
        return frame.select(*[F.col(c).alias(c) for c in ("dims", "id", "v")], place.alias(own), copies.alias(other))

    left = dealt(queries, "tile", tiles, "shard", shards).groupBy("dims", "tile", "shard")
    right = dealt(vectors, "shard", shards, "tile", tiles).groupBy("dims", "tile", "shard")
    found = left.cogroup(right).applyInArrow(_searched(k), _SCHEMA)
    while True:
        shards = -(-shards // FAN_IN)
        merged = found.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        order = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
        found = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if shards == 1:
            break
        found = found.drop("rank")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search(rows: DataFrame, is_query, k: int, scale: float, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k best among all rows for those that are queries."""
    made = stored(whole_vectors(rows, vec_id, embedding, scale), "topk-vectors")
    return top_k(made.where(is_query(F.col("id"))), made, k)
