"""MinHash near-duplicate detection with sequential Bayesian verification.

1. One pass over the texts gives every document the size and a fingerprint of its set of
   word shingles, and a MinHash signature. Documents with equal sets fall into one class;
   its smallest doc_id stands for it from here on.
2. Signatures are cut into bands. Classes that agree in a band share a bucket and are
   candidates. First every bucket compares its hub, the member that meets the most others
   in all its buckets, with the rest. Links found make components. A bucket whose other
   members then lie in one component is settled: thousands of near copies so cost one
   comparison each, never all pairs.
3. What is left of a bucket is settled in cells of bounded size: the members outside the
   hub's component, block by block, against all blocks. A cell compares without emitting
   pairs, and returns no more links than it takes to connect what it found connected.
4. A candidate pair compares its signatures batch by batch. After m of n agree, the chance
   that the similarity reaches the threshold (uniform prior) is a binomial tail; the pair
   is dropped as soon as that is below ``MISS``. Survivors are verified exactly on the full
   sets of the whole texts.

What can be missed: a pair at exactly 0.8 meets in no band with chance (1 - 0.8**5)**32,
3e-6, and is dropped in step 4 with a chance of about ``MISS`` per batch.

Cases: null, empty and blank texts have no shingles; they are linked with nothing and are
kept. A row with a null doc_id is measured, has no component and is kept. Repeated rows
are copies of each other with one id. Rows of one id with different texts count as one
document that has the links of both; ``keep`` takes each of them for a document of its own.
Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import materialise, released
from riskspark.llm.components import components
from riskspark.llm.text import U64, mix, shingle_sets, slices

ROWS, BANDS = 5, 32
BATCH = 32
#: Chance at which a pair that reaches the threshold may be dropped after a batch.
MISS = 1e-7
#: Members and shingles of a block, on average.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 20
#: Least similarity, in percent, of a link.
LIKE = 80

_SEEDS = mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
_XOR = _SEEDS[: ROWS * BANDS].astype(np.uint32)
_ODD = _SEEDS[ROWS * BANDS :].astype(np.uint32) | np.uint32(1)


def signatures(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The MinHash signature of each nonempty set; the sets lie one after the other in ``value``."""
    start = np.concatenate([[0], np.cumsum(size[size > 0])[:-1]]).astype(np.int64)
    out = np.empty((int((size > 0).sum()), ROWS * BANDS), np.uint32)
    if len(value):
        short = (value >> U64(32)).astype(np.uint32)
        for k in range(ROWS * BANDS):
            v = (short ^ _XOR[k]) * _ODD[k]
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            out[:, k] = np.minimum.reduceat(v, start)
    return out


def least_matches(like: int, miss: float = MISS) -> dict[int, int]:
    """For n compared values, the fewest matches with which a pair stays.

    With a uniform prior, P(S >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    t, out = like / 100, {}
    for n in range(BATCH, ROWS * BANDS + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out[n] = m
    return out


def describe(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint (two longs) and signature of every document."""
    schema = T.StructType([docs.schema["doc_id"]]).add("n_shingles", "long").add("f0", "long").add("f1", "long").add("sig", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, value, size = shingle_sets(part["text"], n)
                some = size > 0
                bounds = np.concatenate([[0], np.cumsum(size)])
                marks = []
                for v in (value, mix(value ^ U64(0xA5A5A5A5A5A5A5A5))):
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(v, dtype=U64)])
                    marks.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                found = iter(signatures(value, size))
                sig = [next(found).tobytes() if x else None for x in some]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(size, pa.int64()), *map(pa.array, marks), pa.array(sig, pa.binary())], schema.names
                )

    return docs.select("doc_id", "text").mapInArrow(released(run), schema)


def _buckets(classes: DataFrame) -> DataFrame:
    """bucket, band, id and n_shingles: a row per class and band."""
    schema = T.StructType().add("bucket", "long").add("band", "integer").add("id", "long").add("n_shingles", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(U64)
            h = np.broadcast_to(np.arange(BANDS, dtype=U64), sig.shape[:2])
            for k in range(ROWS):
                h = mix(h * U64(0xD1342543DE82EF95) + sig[:, :, k])
            band = np.tile(np.arange(BANDS, dtype=np.int32), len(sig))
            again = [np.repeat(batch[c].to_numpy(zero_copy_only=False), BANDS) for c in ("id", "n_shingles")]
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(band), *map(pa.array, again)], schema.names)

    return classes.select("id", "n_shingles", "sig").mapInArrow(released(run), schema)


def _survivors(pairs: DataFrame, sigs: DataFrame, like: int) -> DataFrame:
    """The pairs that the comparison of signatures does not rule out."""
    need = least_matches(like)
    schema = T.StructType().add("a", "long").add("b", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            alive, agree = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for n, least in need.items():
                agree = agree + (left[alive, n - BATCH : n] == right[alive, n - BATCH : n]).sum(axis=1)
                stay = agree >= least
                alive, agree = alive[stay], agree[stay]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    both = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b"
    )
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(released(run), schema)


def _verified(pairs: DataFrame, texts: DataFrame, n: int, like: int) -> DataFrame:
    """The pairs whose full sets are alike: 100 * intersection >= like * union."""
    schema = T.StructType().add("a", "long").add("b", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", "text_b"):
                (da, va, na), (db, vb, nb) = (shingle_sets(part[c], n) for c in ("text_a", "text_b"))
                doc, value = np.concatenate([da, db]), np.concatenate([va, vb])
                order = np.lexsort((value, doc))
                doc, value = doc[order], value[order]
                same = (doc[1:] == doc[:-1]) & (value[1:] == value[:-1])
                common = np.bincount(doc[1:][same], minlength=part.num_rows)
                yield part.select(["a", "b"]).filter(pa.array(100 * common >= like * (na + nb - common)))

    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(released(run), schema)


def _settle(left: DataFrame, hubs: DataFrame, sigs: DataFrame, texts: DataFrame, n: int, like: int) -> DataFrame:
    """Links among the members of buckets that the hubs have not settled.

    ``left`` has the members without their hubs, ``hubs`` the root of each bucket's hub.
    """
    need = least_matches(like)
    outside = F.col("root") != F.col("hub_root")
    blocks = lambda rows, shingles: F.greatest(F.lit(1), F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    known = left.join(hubs, "bucket")
    counts = known.groupBy("bucket").agg(
        blocks(F.count(F.lit(1)), F.sum("n_shingles")).alias("blocks"),
        blocks(F.count(F.when(outside, 1)), F.coalesce(F.sum(F.when(outside, F.col("n_shingles"))), F.lit(0))).alias("outer_blocks"),
    )
    rows = known.join(counts, "bucket").withColumn("outer", outside).drop("hub_root").join(sigs, "id").join(texts, "id")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    columns = ["bucket", "band", "id", "n_shingles", "root", "outer", "sig", "text"]
    all_rows = rows.withColumn("y", F.pmod(F.hash("id"), F.col("blocks"))).withColumn("x", upto("outer_blocks")).select(*columns, "x", "y", F.lit(False).alias("asks"))
    asking = rows.where("outer").withColumn("x", F.pmod(F.hash("id"), F.col("outer_blocks"))).withColumn("y", upto("blocks")).select(*columns, "x", "y", F.lit(True).alias("asks"))

    def cell(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        links: list[tuple[int, int]] = []
        if len(left) and len(right):
            ids, size, outer, band = (table[c].to_numpy() for c in ("id", "n_shingles", "outer", "band"))
            root = table["root"].to_numpy()
            sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(len(ids), -1)
            small, large = np.minimum.outer(size[left], size[right]), np.maximum.outer(size[left], size[right])
            fits = (root[left][:, None] != root[right]) & (100 * small >= like * large)
            fits &= ~outer[right] | (ids[left][:, None] < ids[right])  # a pair of two that ask is met twice
            a, b = np.nonzero(fits)
            a, b, agree = left[a], right[b], 0
            for upto, least in need.items():
                agree = agree + _agreement(sig[:, upto - BATCH : upto], a, b)
                stay = agree >= least
                a, b, agree = a[stay], b[stay], agree[stay]
            if len(a):
                first = np.concatenate([(sig[a[k : k + 4096]] == sig[b[k : k + 4096]]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) for k in range(0, len(a), 4096)])
                here = first == band[0]  # a pair that meets in several buckets is compared in the first
                a, b, agree = a[here], b[here], agree[here]
            if len(a):
                _, value, n_shingles = shingle_sets(table["text"].combine_chunks(), n)
                bounds = np.concatenate([[0], np.cumsum(n_shingles)])
                above: dict[int, int] = {}

                def top(x: int) -> int:
                    while (up := above.get(x, x)) != x:
                        above[x] = above.get(up, up)
                        x = above[x]
                    return x

                for k in np.argsort(-agree, kind="stable"):
                    i, j = a[k], b[k]
                    ri, rj = top(int(root[i])), top(int(root[j]))
                    if ri == rj:
                        continue
                    u, v = value[bounds[i] : bounds[i + 1]], value[bounds[j] : bounds[j + 1]]
                    common = len(np.intersect1d(u, v, assume_unique=True))
                    if 100 * common >= like * (len(u) + len(v) - common):
                        above[ri] = rj
                        links.append((int(ids[i]), int(ids[j])))
        return pa.Table.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in range(2)], ["a", "b"])

    return all_rows.unionByName(asking).groupBy("bucket", "x", "y").applyInArrow(cell, "a long, b long")


def _agreement(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values of a batch agree, for each pair."""
    out = np.empty(len(a), np.int64)
    for k in range(0, len(a), 1 << 16):
        out[k : k + (1 << 16)] = (sig[a[k : k + (1 << 16)]] == sig[b[k : k + (1 << 16)]]).sum(axis=1)
    return out


def _linked(described: DataFrame, docs: DataFrame, n: int, like: int) -> DataFrame:
    """id and root of every class that is linked with another."""
    classes = materialise(
        described.where("doc_id is not null and n_shingles > 0")
        .groupBy("n_shingles", "f0", "f1")
        .agg(F.min("doc_id").alias("id"), F.min_by("sig", "doc_id").alias("sig"))
        .select("id", "n_shingles", "sig"),
        "classes",
    )
    rows = materialise(_buckets(classes), "bands")
    shared = (
        rows.groupBy("bucket")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("met"))
        .where("low < high")
        .select("bucket", "met")
    )
    members = materialise(rows.join(shared, "bucket").select("bucket", "band", "id", "n_shingles", "met"), "members")
    wanted = materialise(members.groupBy("id").agg(F.sum("met").alias("met")), "met")
    texts = materialise(docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id", "left_semi"), "texts")
    sigs = materialise(classes.select("id", "sig").join(wanted, "id", "left_semi"), "signatures")

    members = members.drop("met").join(wanted, "id")
    hubs = members.groupBy("bucket").agg(F.max(F.struct("met", F.col("id").alias("hub"), F.col("n_shingles").alias("hub_size"))).alias("h")).select("bucket", "h.hub", "h.hub_size")
    hubs = materialise(hubs, "hubs")
    fits = F.least("n_shingles", "hub_size") * 100 >= F.greatest("n_shingles", "hub_size") * like
    pairs = members.join(hubs, "bucket").where((F.col("id") != F.col("hub")) & fits).select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    found = materialise(_verified(_survivors(pairs, sigs, like), texts, n, like), "links")
    roots = materialise(components(found), "roots")

    rooted = lambda frame, key, name: frame.join(roots.select(F.col("node").alias(key), F.col("root").alias("_root")), key, "left").withColumn(name, F.coalesce("_root", key)).drop("_root")
    left = members.join(hubs.select("bucket", "hub"), "bucket").where("id <> hub").select("bucket", "band", "id", "n_shingles")
    left = materialise(rooted(left, "id", "root"), "members")
    open_ones = left.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket")
    left = left.join(open_ones, "bucket")
    more = materialise(_settle(left, rooted(hubs.select("bucket", "hub"), "hub", "hub_root").select("bucket", "hub_root"), sigs, texts, n, like), "links")
    if not more.isEmpty():
        lifted = rooted(rooted(more.select("a", "b"), "a", "ra"), "b", "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        over = materialise(components(lifted).select(F.col("node").alias("was"), F.col("root").alias("now")), "roots")
        # nodes the hubs had not linked are their own roots so far
        known = roots.unionByName(over.select(F.col("was").alias("node"), F.col("was").alias("root")).join(roots.select("node"), "node", "left_anti"))
        roots = materialise(known.join(over, F.col("root") == F.col("was"), "left").select("node", F.coalesce("now", "root").alias("root")), "roots")
    return roots.select(F.col("node").alias("id"), "root")


def near_duplicates(docs: DataFrame, n: int = 5, like: int = LIKE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = materialise(describe(docs, n), "described")
    linked = _linked(described, docs, n, like)
    keys = ["n_shingles", "f0", "f1"]
    own = described.where("doc_id is not null and n_shingles > 0").select("doc_id", *keys)
    classes = own.groupBy(*keys).agg(F.min("doc_id").alias("id"))
    rooted = classes.join(linked, "id", "left").select(*keys, F.coalesce("root", "id").alias("component_id"))
    placed = own.join(rooted, keys).select("doc_id", "n_shingles", "component_id")
    alone = described.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _told_apart(docs: DataFrame) -> DataFrame:
    """docs with _own: the doc_id, or for an id with several texts a number for each, larger than other ids.

    _again tells the rows that have no id, or one that comes more than once.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.xxhash64("text")
    met = materialise(
        docs.where("doc_id is not null")
        .groupBy(doc_id.alias("_met"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(text).alias("_low"), F.max(text).alias("_high"))
        .where("_n > 1")
        .select("_met", (F.col("_low") < F.col("_high")).alias("_clashes")),
        "met",
    )
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2) + F.lit(1 << 62)
    found = docs.join(met, doc_id == F.col("_met"), "left")
    again = doc_id.isNull() | F.col("_met").isNotNull()
    return found.withColumns({"_own": F.when(F.col("_clashes"), own).otherwise(doc_id), "_again": again}).drop("_met", "_clashes")


def keep(docs: DataFrame, n: int = 5, like: int = LIKE) -> DataFrame:
    """One document of each group, with all its columns.

    The smallest doc_id of a group stays. An id with several texts is a document per text,
    after the ids that have one. Of rows equal in id and text the first by the other
    columns stays, nulls first.
    """
    told = _told_apart(docs)
    judged = near_duplicates(told.select(F.col("_own").alias("doc_id"), "text"), n, like)
    gone = materialise(judged.where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    left = told.join(gone, F.col("_own") == F.col("_gone"), "left_anti")
    # Only rows that may have an equal are shuffled with their texts.
    # As a window, not an aggregate: what wins is a whole row, and the same one in every run.
    others = [F.col(f"`{f.name}`").asc_nulls_first() for f in docs.schema if f.name != "text" and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    first = Window.partitionBy("_own", F.xxhash64("text")).orderBy(*others)
    several = left.where("_again").withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")
    return left.where("not _again").unionByName(several).drop("_own", "_again")
