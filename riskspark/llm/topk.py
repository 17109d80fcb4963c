"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Vectors become whole numbers and are dealt into shards; a task holds one shard and one run
of queries and works through the shard in blocks. In a block every dimension is a sorted
list of its components. For a query, each list is read from its better end in steps; what
has been read of a vector is its lower bound together with the list's worst entry for what
has not, and its upper bound together with the entry where reading stands. Reading ends
when hardly any vector can still reach the k-th lower bound of the block, or the k-th
score of the blocks before (ties included); the scores of those left are then completed.
The k best of each shard meet in one aggregate per query, which keeps k of them at a time.

Every query meets every shard, once; a run of queries travels to each shard and a shard to
each run of queries, so a task's memory is bounded by the two sizes.

Cases: a vector that is null, or holds null or a non-finite component, takes no part; so
does a row without vec_id. A query meets vectors of its own length only. Rows that share a
query's vec_id are its own row and no candidates for it; a vec_id repeated among the
candidates is listed as often as it occurs. Scores are exact; one beyond 64 bits raises.
Only vec_id and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import materialise

#: Rows per block; rows per shard and queries per run, on average. A task holds a shard and a run.
BLOCK, SHARD, QUERIES = 2048, 8192, 512
#: First depth to which all lists are read; doubled until reading may stop.
FIRST_DEPTH = 64


def whole(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, width and v: the floors of the scaled components, of rows that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.where(usable & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.size("embedding").alias("width"),
        F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v"),
    )


class Block:
    """The vectors of a block with the sorted list of each dimension, from either end."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        columns = np.ascontiguousarray(self.vectors.T)
        order = np.argsort(columns, axis=1, kind="stable")
        entries = np.take_along_axis(columns, order, axis=1).astype(np.float64)
        self.order = np.concatenate([order, order[:, ::-1]])  # ascending lists, then descending ones
        self.entries = np.concatenate([entries, entries[:, ::-1]])
        self.largest = np.abs(entries).max(axis=1, initial=0)
        # the place of each entry in a matrix with a row per dimension and a column per vector
        lane = np.arange(len(columns))[:, None] * len(ids)
        self.place = np.concatenate([order + lane, order[:, ::-1] + lane])

    def _survivors(self, q: np.ndarray, other: np.ndarray, k: int, reached: float) -> np.ndarray:
        """The vectors that can be among the k best; ``reached`` is a score k others are known to have."""
        n, width = len(self.ids), len(q)
        lists = np.flatnonzero(q)
        rows = lists + width * (q[lists] > 0)  # from the largest component for a positive weight
        weight = q[lists][:, None]
        worst = self.entries[rows, -1] * q[lists]
        slack = 1e-12 * float(np.abs(q) @ self.largest) + 1e-6
        alive, got, missing = np.flatnonzero(other), np.zeros(n), np.ones((width, n))
        ends, depth, unread = np.zeros((2, width)), 0, missing.reshape(-1)
        ends[0, lists] = worst
        few = max(4 * k, n // 32)
        while depth < n and len(alive) > k:
            upto = min(n, max(FIRST_DEPTH, min(2 * depth, depth + max(1, n // 8))))
            ids, parts = self.order[rows, depth:upto], self.entries[rows, depth:upto] * weight
            got += np.bincount(ids.ravel(), parts.ravel(), n)
            unread[self.place[rows, depth:upto].ravel()] = 0
            depth = upto
            # what has not been read lies between a list's worst entry and where reading stands
            ends[1, lists] = parts[:, -1]
            low, high = (ends @ missing + got)[:, alive]
            kth = max(reached, float(np.partition(low, -k)[-k]) if len(alive) >= k else -np.inf)
            alive = alive[high >= kth - slack]
            if len(alive) <= few and kth > -np.inf:
                break
        return alive

    def best(self, query: np.ndarray, own: int, k: int, reached: float = -np.inf) -> list[tuple[int, int]]:
        """(score, vec_id) of the k best, ties to smaller ids, without the query's own rows.

        With ``reached``, vectors that stay below it may be left out.
        """
        alive = np.flatnonzero(self.ids != own)
        if len(alive) > k and np.any(query):
            alive = self._survivors(query.astype(np.float64), self.ids != own, k, reached)
        if not len(alive):
            return []
        most = int(np.abs(query).max(initial=0)) * int(np.abs(self.vectors).max(initial=0)) * max(1, len(query))
        exact = np.int64 if most < 2**63 else object
        scores = self.vectors[alive].astype(exact) @ query.astype(exact)
        found = sorted(zip((-int(s) for s in scores), (int(self.ids[a]) for a in alive), strict=True))[:k]
        return [(-s, i) for s, i in found]


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score; both frames as ``whole`` gives them."""
    # Each row draws its block, and each query its run, once; the draws are written with the rows.
    drawn = F.xxhash64("vec_id", F.monotonically_increasing_id()).alias("drawn")
    vectors, queries = (materialise(x.select("vec_id", "width", "v", drawn), "vectors") for x in (vectors, queries))
    blocks = max(1, -(-vectors.count() // SHARD))
    runs = max(1, -(-queries.count() // QUERIES))
    among = lambda n: F.pmod("drawn", F.lit(n).cast("long"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    held = vectors.select("vec_id", "width", "v", among(blocks).alias("block"), every(runs).alias("run"))
    asked = queries.select("vec_id", "width", "v", every(blocks).alias("block"), among(runs).alias("run"))
    names = ["query_id", "vec_id", "score"]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in names])

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        v = table["v"].combine_chunks()
        return table["vec_id"].to_numpy(), v.flatten().to_numpy().reshape(len(v), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            ids, held = matrix(left)
            best: list[list[tuple[int, int]]] = [[] for _ in range(right.num_rows)]
            for low in range(0, len(ids), BLOCK):
                block = Block(ids[low : low + BLOCK], held[low : low + BLOCK])
                for n, (own, query) in enumerate(zip(*matrix(right), strict=True)):
                    # the k-th score of the blocks before is one that k vectors have
                    reached = best[n][-1][0] if len(best[n]) == k else -np.inf
                    found = best[n] + block.best(query, int(own), k, reached)
                    best[n] = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
            out = [(int(own), i, s) for own, found in zip(matrix(right)[0], best, strict=True) for s, i in found]
        columns = [pa.array([r[c] for r in out], pa.int64()) for c in range(3)]
        return pa.Table.from_arrays(columns, names)

    keys = ["width", "block", "run"]
    near = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
