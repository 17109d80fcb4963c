"""A trie of conversation prefixes by hashing blocks of turns.

Every turn has a 128-bit digest; the digest of the first d turns is the exclusive or of theirs,
each mixed with its place, so that prefix digests are running sums that need no text.

1. A conversation is cut into blocks of ``BLOCK`` turns. Conversations are grouped by the digest
   up to a block's end, with their number and smallest id: a prefix that many share is from
   here on one row per block, however many share it.
2. A block that is the only one to follow its predecessor has one node per turn, all with the
   block's members; nothing is grouped again. Only where several blocks follow the same
   predecessor are their turns told apart, by grouping the blocks (not the conversations) by
   the prefix digest at each turn.
3. A node is known by (smallest member, depth), since deeper nodes on a member's path that have
   the same smallest member follow each other: its run. Each run hangs at a node of another.
   What a run adds to the subtrees above it is added once per run it passes; sums along a run
   are a window over its nodes.
4. The members that end at a node are sorted over all tasks, joined to pieces of bounded size,
   and hashed in a stream, piece after piece.

Cases: turns are in the order of ``turn``, nulls first, ties by role and then by digest. A null
role or text is the empty string. Rows without conv_id are in no conversation. Repeated rows
are turns of their own. An empty table has no nodes, not even a root. A conversation's turns
are put in order by one task, as rows of some 50 bytes without their texts. Only conv_id,
turn, role and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import materialise, word_count

#: Turns of a block.
BLOCK = 4
#: Ids of a piece that is hashed at once.
PIECE = 1 << 16
_DIGEST = ("x0", "x1")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos from 1, the digest t0, t1 of role and text, and the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        *[F.xxhash64(F.lit(k), role, F.length(role), text).alias(f"t{k}") for k in range(2)], word_count(text).alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "t0", "t1")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "t0", "t1", "words")


def rebuilt(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id and length of every conversation, its turns), each beginning like the first of its family.

    A conversation c takes the first h turns of conversation c - c % family, with h the crc32
    of its decimal id modulo ``most``, and its own after its first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    borrowed = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = (
        sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
        .withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most)
        .join(base, "base", "left")
        .select("conv_id", "base", "h", borrowed.alias("borrowed"), (borrowed + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"))
    )
    convs = materialise(convs, "conversations")
    told = ["t0", "t1", "words"]
    heads = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "h"), "base")
    heads = heads.where("pos <= h").select("conv_id", "pos", *told)
    own = turns.join(convs.select("conv_id", "h", "borrowed"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("borrowed")).alias("pos"), *told)
    return convs.select("conv_id", "size"), heads.unionByName(own)


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, pos, words, and the digest x0, x1 of the turns up to there."""
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = [F.bit_xor(F.xxhash64(F.lit(k), "t0", "t1", "pos")).over(upto).alias(x) for k, x in enumerate(_DIGEST)]
    return turns.select("conv_id", "pos", "words", *running)


def block_nodes(path: DataFrame) -> DataFrame:
    """Distinct blocks: number k, digests before and at their end, size, turns, and their members' n and smallest id."""
    block = F.floor((F.col("pos") - 1) / BLOCK)
    turn = F.struct("pos", *_DIGEST, "words")
    cut = path.groupBy("conv_id", block.alias("k")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    cut = cut.withColumn("end", F.element_at("turns", -1))
    before = Window.partitionBy("conv_id").orderBy("k")
    start = [F.coalesce(F.lag(F.col(f"end.{x}")).over(before), F.lit(0).cast("long")).alias(f"s{k}") for k, x in enumerate(_DIGEST)]
    cut = cut.select("conv_id", "k", "turns", *start, *[F.col(f"end.{x}").alias(f"e{k}") for k, x in enumerate(_DIGEST)])
    return cut.groupBy("k", "s0", "s1", "e0", "e1").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")
    )


def nodes(convs: DataFrame, path: DataFrame) -> DataFrame:
    """depth, x0, x1, conv_id (smallest member), n_convs and words of the last turn, for every distinct prefix."""
    blocks = materialise(block_nodes(path), "blocks")
    whole = F.struct(*blocks.columns)
    follow = blocks.groupBy("k", "s0", "s1").agg(F.count(F.lit(1)).alias("following"), F.first(whole).alias("block"))
    alone = follow.where("following = 1").select("block.*")
    diverging = blocks.join(alone.select("k", "s0", "s1", "e0", "e1"), ["k", "s0", "s1", "e0", "e1"], "left_anti")
    each = lambda frame: frame.select("n", "conv_id", F.explode("turns").alias("t")).select("n", "conv_id", F.col("t.pos").alias("depth"), *[f"t.{x}" for x in _DIGEST], "t.words")
    told = ["depth", *_DIGEST]
    refined = each(diverging).groupBy(*told).agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("words").alias("words"))
    plain = each(alone).withColumnRenamed("n", "n_convs")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), *[zero.alias(x) for x in _DIGEST], "conv_id", "n_convs", zero.alias("words"))
    columns = [*told, "conv_id", "n_convs", "words"]
    return root.select(*columns).unionByName(refined.select(*columns)).unionByName(plain.select(*columns))


def _above(found: DataFrame, path: DataFrame) -> DataFrame:
    """run, first (its first depth), and for each run above it: over, and the depth at where the way leaves that."""
    runs = materialise(found.groupBy("conv_id").agg(F.min("depth").alias("first")).where("first > 0"), "runs")
    way = path.join(runs, "conv_id").where("pos < first").select(F.col("conv_id").alias("run"), "first", F.col("pos").alias("depth"), *_DIGEST)
    owners = found.where("depth > 0").select("depth", *_DIGEST, F.col("conv_id").alias("over"))
    met = way.join(owners, ["depth", *_DIGEST]).select("run", "first", "over", "depth")
    # Every way begins at the root, one row, which needs no look-up.
    root = found.where("depth = 0").select("conv_id").first()
    top = runs.select(F.col("conv_id").alias("run"), "first", F.lit(root and root[0]).cast("long").alias("over"), F.lit(0).cast("long").alias("depth"))
    return met.unionByName(top).groupBy("run", "first", "over").agg(F.max("depth").alias("at"))


def _digests(ends: DataFrame) -> DataFrame:
    """Per (depth, x0, x1) the SHA-256 of its conv_ids: decimal, rising, joined by commas."""
    import hashlib

    key = ["depth", *_DIGEST]
    kinds = ", ".join(f"{c} long" for c in key)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids = None, []

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(key, at, strict=True)) | {"low": ids[0], "told": ",".join(map(str, ids))}], schema)

        schema = pa.schema([*((c, pa.int64()) for c in (*key, "low")), ("told", pa.string())])
        for batch in batches:
            for *node, conv_id in zip(*(batch[c].to_pylist() for c in (*key, "conv_id")), strict=True):
                if ids and (node != at or len(ids) == PIECE):
                    yield piece()
                    ids = []
                at = node
                ids.append(conv_id)
        if ids:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None
        schema = pa.schema([*((c, pa.int64()) for c in key), ("ends_sha256", pa.string())])

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(key, at, strict=True)) | {"ends_sha256": running.hexdigest()}], schema)

        for batch in batches:
            for *node, told in zip(*(batch[c].to_pylist() for c in (*key, "told")), strict=True):
                if node != at:
                    if running:
                        yield done()
                    at, running = node, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(told.encode())
        if running:
            yield done()

    spread = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(pieces, f"{kinds}, low long, told string")
    return spread.repartition(*key).sortWithinPartitions(*key, "low").mapInArrow(hashed, f"{kinds}, ends_sha256 string")


def trie(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, with the columns of the module's contract."""
    own = materialise(turns_of(conversations), "turns")
    convs, turns = rebuilt(own, family, most)
    path = materialise(paths(turns), "paths")
    found = materialise(nodes(convs, path), "nodes")
    above = materialise(_above(found, path), "above")

    here = lambda frame: frame.select(F.col("over").alias("conv_id"), F.col("at").alias("depth"), "*")
    nearest = above.where("at = first - 1")
    hanging = here(nearest).groupBy("conv_id", "depth").agg(F.count(F.lit(1)).alias("hanging"))
    parents = nearest.select(F.col("run").alias("conv_id"), F.col("first").alias("depth"), F.col("over").alias("parent"))
    run = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    sized = (
        found.join(hanging, ["conv_id", "depth"], "left")
        .join(parents, ["conv_id", "depth"], "left")
        .withColumn("last", F.row_number().over(run) == 1)
        .withColumn("n_children", F.coalesce("hanging", F.lit(0)) + F.when(F.col("last"), 0).otherwise(1))
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
        .drop("hanging", "last")
    )
    sized = materialise(sized, "sized")
    totals = sized.groupBy(F.col("conv_id").alias("run")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    added = here(above.join(totals, "run")).groupBy("conv_id", "depth").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    below = run.rowsBetween(Window.unboundedPreceding, 0)

    def in_subtree(c: str) -> Column:
        return F.sum(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).over(below).cast("long")

    summed = sized.join(added, ["conv_id", "depth"], "left").withColumns({"n_leaves": in_subtree("leaves"), "saved_tokens": in_subtree("saved")})
    last = path.join(convs, "conv_id").where("pos = size").select("conv_id", F.col("pos").alias("depth"), *_DIGEST)
    zero = F.lit(0).cast("long")
    turnless = convs.where("size = 0").select("conv_id", zero.alias("depth"), *[zero.alias(x) for x in _DIGEST])
    digests = _digests(last.unionByName(turnless))
    parent = F.when(F.col("depth") == 0, F.lit(None).cast("long")).otherwise(F.coalesce("parent", "conv_id"))
    return summed.join(digests, ["depth", *_DIGEST], "left").select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
