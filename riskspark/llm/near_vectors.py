"""Near-duplicate vectors by counting collisions in sorted one-dimensional projections.

1. Every vector of length one is projected on random directions. The two ends of each sorted
   projection, beyond ``t`` on either side, are its lists. Two vectors collide in a list if
   both are in it and lie within a window of each other, centred at the one that asks.
   For vectors of a given cosine the two values are a normal pair of that correlation, whatever
   the data look like, so the chance of a collision is known. As many directions are drawn
   as make a pair at the threshold collide ``LEAST`` times but for a chance of ``MISS``.
2. The share of a list, 2 * (1 - Phi(t)) per direction, falls with the root of the number of
   vectors: work then grows with its power of 1.5 instead of its square, and a vector is in
   about two dozen lists at any size.
3. Vectors meet in cells: a bundle of lists of one label, as many lists as keep the expected
   number of vectors in a cell below ``BLOCK``. A bundle that has more all the same, as
   groups of near copies lie in the same lists, is divided into blocks, and each pair of
   blocks is a cell. In a cell the lists are sorted, the collisions of each pair counted, and the
   pairs that reach the count verified in double precision. A pair that meets in several cells
   counts in that of its first collision. No pair leaves a cell: only the number of links of
   each vector, and no more links than connect what was found connected.

Equal vectors of a label are one class, whose members are linked with each other and have the
links of the class.

Cases: a vector that is null, empty, zero, or holds null or a non-finite component links with
nothing, and so does a row without label or vec_id; its component is its vec_id, and it is kept.
Vectors of different lengths are not compared. Rows equal in vec_id, label and vector count once
and are all returned; rows of one vec_id that differ count as vectors of their own.
An empty table gives an empty result. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import materialise
from riskspark.llm.components import components

LIKE = 0.93
#: Collisions that make a pair a candidate, and the chance that a pair at the threshold has fewer.
LEAST, MISS = 2, 1e-6
#: Half the width of a window, in standard deviations of the difference at the threshold.
WINDOW = 3.0
#: A list has this share of the vectors at most, and the root of SPREAD by their number.
SHARE, SPREAD = 0.05, 2
#: Vectors of a cell; collisions and rows of a run within it.
BLOCK, RUN, RUN_ROWS = 8192, 1 << 21, 512
_SEED, _DRAWN = 20240229, 1024
_NORMAL = NormalDist()


def collision_chance(t: float, window: float, like: float) -> float:
    """P(x >= t, y >= t, |x - y| <= window) for a normal pair of correlation ``like``."""
    spread = math.sqrt(1 - like * like)
    steps, top = 4000, max(t, 0) + 9
    total, h = 0.0, (top - t) / steps
    for k in range(steps):
        x = t + (k + 0.5) * h
        low = max(t, x - window)
        total += _NORMAL.pdf(x) * max(0.0, _NORMAL.cdf((x + window - like * x) / spread) - _NORMAL.cdf((low - like * x) / spread)) * h
    return total


@lru_cache(maxsize=64)
def calibrated(n: int, like: float = LIKE, least: int = LEAST, miss: float = MISS) -> tuple[int, float, float]:
    """(directions, t, window) for n vectors: the fewest directions with which a pair at the threshold is missed with ``miss`` at most."""
    share = min(SHARE, math.sqrt(SPREAD / max(n, 1)))
    t, window = _NORMAL.inv_cdf(1 - share), WINDOW * math.sqrt(2 * (1 - like))
    p = 2 * collision_chance(t, window, like)  # either end

    def missed(m: int) -> float:
        return sum(math.exp(math.lgamma(m + 1) - math.lgamma(k + 1) - math.lgamma(m - k + 1) + k * math.log(p) + (m - k) * math.log1p(-p)) for k in range(least))

    high = least
    while missed(high) > miss:
        high *= 2
    low = high // 2
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if missed(mid) <= miss else (mid, high)
    return high, t, window


@lru_cache(maxsize=8)
def _directions(width: int, part: int) -> np.ndarray:
    return np.random.default_rng([_SEED, width, part]).standard_normal((width, _DRAWN)).astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision, each scaled by a power of two."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    _, power = np.frexp(np.abs(v).max(axis=1, initial=0))
    return np.ldexp(v, -power[:, None])


def usable() -> F.Column:
    """Rows that can link with others."""
    finite = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    some = F.exists("embedding", lambda e: e != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & some, F.lit(False))


def _listed(classes: DataFrame, directions: int, t: float) -> DataFrame:
    """classes with the lists each is in, rising, and the values there."""
    schema = T.StructType([*classes.schema.fields]).add("lists", T.ArrayType(T.IntegerType())).add("values", T.ArrayType(T.FloatType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch["width"].to_numpy()
            for w in np.unique(width):
                part = batch.filter(pa.array(width == w))
                v = _matrix(part["embedding"])
                unit = (v / np.sqrt((v * v).sum(axis=1))[:, None]).astype(np.float32)
                found = []
                for low in range(0, directions, _DRAWN):
                    value = unit @ _directions(int(w), low // _DRAWN)[:, : directions - low]
                    row, k = np.nonzero(np.abs(value) >= t)
                    x = value[row, k]
                    found.append((row, 2 * (low + k) + (x < 0), np.abs(x)))
                row, lists, values = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.argsort(row, kind="stable")
                bounds = pa.array(np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32))
                arrays = [pa.ListArray.from_arrays(bounds, pa.array(c[order], kind)) for c, kind in ((lists, pa.int32()), (values, pa.float32()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], schema.names)

    return classes.mapInArrow(run, schema)


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Hang the trees of linked rows onto the smaller of their roots."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root[:] = root[root]


class Side:
    """The vectors of a block, and their entries in all lists, sorted by list and value."""

    def __init__(self, rows: pa.Table, apart: float):
        self.node, self.held = rows["node"].to_numpy(), rows["held"].to_numpy()
        self.vector = _matrix(rows["embedding"])
        self.length = np.sqrt((self.vector * self.vector).sum(axis=1))
        lists = rows["lists"].combine_chunks()
        self.row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        self.list = lists.flatten().to_numpy()
        # one axis for all lists, on which no window reaches from a list into the next
        self.at = self.list * apart + rows["values"].combine_chunks().flatten().to_numpy()
        self.order = np.argsort(self.at, kind="stable")
        self.sorted_at, self.sorted_row = self.at[self.order], self.row[self.order]


def links(left: Side, right: Side, window: float, like: float, least: int, own: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (row on the left, row on the right) whose first collision is in one of the lists ``own``.

    Within one block each pair is met from both of its members; the caller takes it once.
    """
    first = np.searchsorted(right.sorted_at, left.at - window, side="left")
    met = np.searchsorted(right.sorted_at, left.at + window, side="right") - first
    entries = np.searchsorted(left.row, np.arange(len(left.node) + 1))  # entries come by row
    work = np.concatenate([[0], np.cumsum(met)])[entries]
    low, n = 0, len(right.node)
    while low < len(left.node):
        high = int(np.searchsorted(work, work[low] + RUN, side="right")) - 1
        high = min(max(high, low + 1), low + RUN_ROWS, len(left.node))
        part = slice(entries[low], entries[high])
        times = met[part]
        # later lists first, so that the first list of a pair is what stays written
        by_list = np.argsort(-left.list[part], kind="stable")
        times = times[by_list]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        partner = right.sorted_row[np.repeat(first[part][by_list], times) + within]
        pair = np.repeat(left.row[part][by_list] - low, times) * n + partner
        count = np.bincount(pair, minlength=(high - low) * n)
        earliest = np.zeros((high - low) * n, np.int32)
        earliest[pair] = np.repeat(left.list[part][by_list], times)
        candidate = np.flatnonzero((count >= least) & (earliest >= own[0]) & (earliest < own[1]))
        a, b = candidate // n + low, candidate % n
        for k in range(0, len(a), 1 << 16):
            x, y = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            cosine = (left.vector[x] * right.vector[y]).sum(axis=1) / (left.length[x] * right.length[y])
            yield x[cosine >= like], y[cosine >= like]
        low = high


def _cell(rows: pa.Table, window: float, like: float, least: int) -> pa.Table:
    """Per vector the weight of its links in this cell, and links that connect what is connected."""
    rows = rows.sort_by("node")
    x, y = rows["x"][0].as_py(), rows["y"][0].as_py()
    own = rows["from"][0].as_py(), rows["upto"][0].as_py()
    block = rows["block"].to_numpy()
    apart = 16 + 2 * window
    left = Side(rows.filter(pa.array(block == x)), apart)
    right = left if x == y else Side(rows.filter(pa.array(block == y)), apart)
    node = left.node if x == y else np.concatenate([left.node, right.node])
    shift = 0 if x == y else len(left.node)
    total, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for a, b in links(left, right, window, like, least, own):
        if x == y:
            once = a < b
            a, b = a[once], b[once]
        np.add.at(total, a, right.held[b])
        np.add.at(total, b + shift, left.held[a])
        unite(root, a, b + shift)
    some, hung = np.flatnonzero(total), np.flatnonzero(root != np.arange(len(node)))
    columns = [np.concatenate([node[some], node[hung]]), np.concatenate([total[some], np.zeros(len(hung), np.int64)]), np.concatenate([node[some], node[root[hung]]])]
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "n", "other"])


def _linked(classes: DataFrame, like: float, least: int, miss: float) -> DataFrame:
    """node, n and other: the weight of a class's links per cell; n is 0 in rows that connect it with another."""
    directions, t, window = calibrated(classes.count(), like, least, miss)
    lists = 2 * directions
    listed = materialise(_listed(classes, directions, t), "lists")
    share = 2 * (1 - _NORMAL.cdf(t))  # of the vectors, in either list of a direction
    keys = ["label", "width"]
    # A bundle of g directions holds a share 1 - (1 - share)**g of the vectors: as many as fit a block.
    n = F.count(F.lit(1))
    fits = F.when(n <= BLOCK, directions).otherwise(F.greatest(F.lit(1), F.floor(F.log1p(-F.lit(float(BLOCK)) / n) / F.lit(math.log1p(-share)))))
    bundles = classes.groupBy(*keys).agg(F.least(F.lit(directions), fits).cast("int").alias("directions"))
    bundle = F.array_distinct(F.transform("lists", lambda x: F.floor(x / (2 * F.col("directions"))).cast("int")))
    placed = listed.join(bundles, keys).withColumn("bundle", F.explode(bundle))
    keys += ["bundle"]
    sizes = placed.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("met")).where("met > 1").drop("met")
    rows = placed.join(sizes, keys).withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "block").alias("x"), F.greatest(k, "block").alias("y")))
    bounds = (2 * F.col("directions") * F.col("bundle")).alias("from"), (2 * F.col("directions") * (F.col("bundle") + 1)).alias("upto")
    rows = rows.select(*keys, *bounds, "block", F.explode(cells).alias("cell"), "node", "held", "embedding", "lists", "values")
    rows = rows.select("*", "cell.x", "cell.y").drop("cell")
    # Dealt by the whole key, so that the cells of one bundle do not share a task.
    keys += ["x", "y"]
    assert lists < 1 << 31
    return rows.repartition(*keys).groupBy(*keys).applyInArrow(lambda table: _cell(table, window, like, least), "node long, n long, other long")


def near_vectors(vectors: DataFrame, like: float = LIKE, least: int = LEAST, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    marks = [F.xxhash64(F.lit(k), "embedding").alias(f"f{k}") for k in range(2)]
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").withColumn("usable", usable())
    able = rows.where("usable").select("vec_id", "label", "embedding", F.size("embedding").alias("width"), *marks)
    keys = ["label", "width", "f0", "f1"]
    once = able.groupBy(*keys, "vec_id").agg(F.first("embedding").alias("embedding"))
    classes = once.groupBy(*keys).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("held"), F.first("embedding").alias("embedding"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    found = materialise(_linked(classes.select("node", "label", "width", "held", "embedding"), like, least, miss), "links")
    roots = components(found.where("n = 0").select(F.col("node").alias("a"), F.col("other").alias("b")))
    weight = found.groupBy("node").agg(F.sum("n").alias("n"))
    known = classes.select(*keys, "node", "id", "held").join(weight, "node", "left").join(roots, "node", "left")
    known = materialise(known.withColumn("root", F.coalesce("root", "node")), "known")
    least_id = known.groupBy("root").agg(F.min("id").alias("component_id"))
    n_links = (F.coalesce("n", F.lit(0)) + F.col("held") - 1).alias("n_links")
    told = known.join(least_id, "root").select(*keys, n_links, "component_id")
    linked = able.select("vec_id", *keys).join(told, keys).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
