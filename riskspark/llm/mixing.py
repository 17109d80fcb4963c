"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Among all rates between 0 and 2 that give
every source its target, the ones of least relative entropy to "once each" are
exponentially tilted: a document of size s in a source with multiplier m is taken
2 / (1 + exp(-m * s / scale)) times. One multiplier per source solves the convex dual;
Newton's method finds it, with a bracket that halves where a step would leave it. Each
iteration is one aggregate over (source, size) with the count of documents, which is
all that the constraints depend on, so the texts are read once.

Rates become copies per class of equal source and size: each class takes its share in
whole copies and hands the words left over, in order of falling size, to the next. A
source therefore ends within about the size of its smallest documents of its target.
Within a class the documents with the smallest hashes take one copy more; the hash that
divides them is found by counting ranges of hashes first and ranking the distinct hashes of
one range only.

Cases: a null source is a source of its own and comes last in order; a null or empty
text has size 0 and takes no words. Rows repeated with the same id and text have the
same hash; where that is the dividing one and only some of them are to take one copy more,
they are numbered, written, and divided by the hash of their numbers. An empty table gives
no rows. ``docs`` may have any further columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import materialise, word_count

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Words wanted, as a multiple of all words; and the most copies of a document.
SHARE, MOST_COPIES = 1.5, 2
#: A source's rates are right when their words are this near the target, relatively.
TOLERANCE, MOST_ROUNDS = 1e-6, 60
#: Ranges of hashes counted per class; a range is ranked in one task.
RANGE_BITS = 12


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """source, source_size, n_docs and target: words shared by weight, none above twice its size.

    With the sources in order of size by weight, those that reach their bound come
    first; the words left are shared by weight among the others. The table has a row
    per source, so its windows see sources, never documents.
    """
    by_name = F.col("source").asc_nulls_last()
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), by_name)
    bound = float(MOST_COPIES) * F.col("source_size")
    before = F.coalesce(F.sum(bound).over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.row_number().over(Window.orderBy(by_name)) - 1) % len(weights)))
        .withColumn("level", (share * F.sum("source_size").over(Window.partitionBy()) - before) / rest)
        .withColumn("free", F.when(F.col("level") * F.col("weight") < bound, F.col("level")))
        .withColumn("free", F.first("free", True).over(filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("source", "source_size", "n_docs", F.least(bound, F.coalesce(F.col("free") * F.col("weight"), bound)).alias("target"))
    )


def _rate(multiplier: Column, size: Column) -> Column:
    return float(MOST_COPIES) / (1.0 + F.exp(-multiplier * size / F.col("scale")))


def balance(classes: DataFrame, goals: DataFrame) -> DataFrame:
    """source, scale and multiplier: the dual's solution for each source with words.

    ``classes`` has source, size and n. A source whose target is its bound gets an
    infinite multiplier.
    """
    at_bound = F.col("target") >= MOST_COPIES * F.col("source_size")
    state = materialise(
        goals.where("source_size > 0").select(
            F.col("source").alias("of"),
            "target",
            (F.col("source_size") / F.col("n_docs")).alias("scale"),
            F.when(at_bound, float("inf")).otherwise(0.0).alias("multiplier"),
            F.lit(float("-inf")).alias("low"),
            F.lit(float("inf")).alias("high"),
            at_bound.alias("done"),
        ),
        "multipliers",
    )
    words = classes.where("size > 0")
    for _ in range(MOST_ROUNDS):
        if state.where("not done").isEmpty():
            break
        rate = _rate(F.col("multiplier"), F.col("size"))
        sums = (
            words.join(state.where("not done"), F.col("source").eqNullSafe(F.col("of")))
            .groupBy("of", "target", "scale", "multiplier", "low", "high")
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("words"),
                F.sum(F.col("n") * F.col("size") * F.col("size") / F.col("scale") * rate * (1 - rate / MOST_COPIES)).alias("slope"),
            )
        )
        m, off = F.col("multiplier"), F.col("words") - F.col("target")
        low, high = F.when(off < 0, m).otherwise(F.col("low")), F.when(off > 0, m).otherwise(F.col("high"))
        step = m - off / F.greatest(F.col("slope"), F.lit(1e-300))
        # Outside the bracket, or far: halve the bracket, or double where it is still open.
        other = (
            F.when(high == float("inf"), F.abs(m) * 2 + 1).when(low == float("-inf"), -F.abs(m) * 2 - 1).otherwise((low + high) / 2)
        )
        good = (step > low) & (step < high) & (F.abs(step - m) <= 2 * F.abs(m) + 2)
        done = F.abs(off) <= TOLERANCE * F.col("target")
        moved = sums.select(
            "of", "target", "scale", F.when(done, m).when(good, step).otherwise(other).alias("multiplier"),
            low.alias("low"), high.alias("high"), done.alias("done"),
        )
        state = materialise(moved.unionByName(state.where("done")), "multipliers")
    return state.select(F.col("of").alias("source"), "scale", "multiplier")


def _round(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of a source's classes, the words left over handed on by falling size.

    What is left in the end is reduced by adding a copy, by removing one, or by both, as
    long as that comes nearer. The rows are the distinct sizes of one source, not its
    documents.
    """
    pdf = pdf.sort_values("size", ascending=False)
    copies, left = np.zeros(len(pdf), np.int64), 0.0
    for i, (size, n, rate) in enumerate(zip(pdf["size"], pdf["n"], pdf["rate"], strict=True)):
        copies[i] = min(max(int(np.floor(n * rate + left / size + 0.5)), 0), MOST_COPIES * n)
        left += (n * rate - copies[i]) * size
    size, most = pdf["size"].to_numpy(), MOST_COPIES * pdf["n"].to_numpy()
    for _ in range(50):
        add, take = np.flatnonzero(copies < most), np.flatnonzero(copies > 0)[::-1]  # take: by rising size
        moves = [(abs(left - size[a]), a, None) for a in add] + [(abs(left + size[t]), None, t) for t in take]
        if len(add) and len(take):
            near = np.searchsorted(size[take], size[add] - left)
            for shift in (-1, 0):
                other = take[np.clip(near + shift, 0, len(take) - 1)]
                rest = np.abs(left - size[add] + size[other])
                best = int(np.argmin(rest))
                moves.append((rest[best], add[best], other[best]))
        rest, a, t = min(moves, key=lambda m: m[0], default=(np.inf, None, None))
        if rest >= abs(left) - 1e-6:
            break
        for k, step in ((a, 1), (t, -1)):
            if k is not None:
                copies[k] += step
                left -= step * size[k]
    return pdf.assign(copies=copies)[["source", "size", "n", "copies"]]


def plan(narrow: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """A row per (source, size): source_size, target, every, last and share.

    Each document of the class is taken ``every`` times, and once more if its hash is
    below ``last`` (null: none) or equal to it. If ``share`` is not null, only so many of
    those with equal hash are. ``narrow`` has source, size and hash of each document.
    """
    goals = materialise(targets(narrow, weights, share), "targets")
    classes = materialise(narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "classes")
    dual = balance(classes, goals).withColumnRenamed("source", "of")
    rated = (
        classes.where("size > 0")
        .join(dual, F.col("source").eqNullSafe(F.col("of")))
        .select("source", "size", "n", _rate(F.col("multiplier"), F.col("size")).alias("rate"))
    )
    rounded = rated.groupBy("source").applyInPandas(_round, "source string, size long, n long, copies long")
    nothing = classes.where("size = 0").select("source", "size", "n", F.lit(0).cast("long").alias("copies"))
    copies = materialise(
        rounded.unionByName(nothing)
        .join(goals.select(F.col("source").alias("of"), "source_size", "target"), F.col("source").eqNullSafe(F.col("of")))
        .select("source", "size", "source_size", "target", F.expr("copies div n").alias("every"), F.expr("copies % n").alias("extra")),
        "copies",
    )
    return copies.join(_last(narrow, copies), _same_class("of", "of_size"), "left").drop("of", "of_size")


def _same_class(source: str, size: str) -> Column:
    return F.col("source").eqNullSafe(F.col(source)) & (F.col("size") == F.col(size))


def _last(narrow: DataFrame, copies: DataFrame) -> DataFrame:
    """of, of_size, last and share: the hash of the ``extra``-th document of each class that has some.

    share: how many of the rows with that hash are among the ``extra`` first, null for all.
    """
    some = copies.where("extra > 0").select(F.col("source").alias("of"), F.col("size").alias("of_size"), "extra")
    part = F.shiftright("hash", 64 - RANGE_BITS)
    hashes = (
        narrow.join(some, _same_class("of", "of_size"))
        .groupBy("of", "of_size", "extra", "hash")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("*", part.alias("part"))
    )
    upto = Window.partitionBy("of", "of_size").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        hashes.groupBy("of", "of_size", "part", "extra")
        .agg(F.sum("rows").alias("held"))
        .withColumn("so_far", F.sum("held").over(upto))
        .where("so_far >= extra and so_far - held < extra")
        .select(F.col("of").alias("c_of"), F.col("of_size").alias("c_size"), F.col("part").alias("c_part"), (F.col("extra") - F.col("so_far") + F.col("held")).alias("nth"))
    )
    same = F.col("of").eqNullSafe(F.col("c_of")) & (F.col("of_size") == F.col("c_size")) & (F.col("part") == F.col("c_part"))
    ranked = Window.partitionBy("of", "of_size").orderBy("hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.col("nth") - F.col("up_to_here") + F.col("rows")
    return (
        hashes.join(cut, same)
        .withColumn("up_to_here", F.sum("rows").over(ranked))
        .where("up_to_here >= nth and up_to_here - rows < nth")
        .select("of", "of_size", F.col("hash").alias("last"), F.when(share < F.col("rows"), share).alias("share"))
    )


def _copied(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """rows with _copies; ``rows`` has _measured, ``planned`` is what ``plan`` returns, as _planned."""
    same = F.col("_measured.source").eqNullSafe(F.col("_planned.source")) & (F.col("_measured.size") == F.col("_planned.size"))
    placed, every = rows.join(planned, same), F.col("_planned.every")
    tied = F.col("_planned.share").isNotNull() & (F.col("_measured.hash") == F.col("_planned.last"))
    copied = placed.withColumn("_copies", every + F.when(F.col("_measured.hash") <= F.col("_planned.last"), 1).otherwise(0))
    if planned.where("_planned.share is not null").isEmpty():
        return copied
    # Written with their numbers, so that a row is told from its copies however often it is read.
    ties = materialise(placed.where(tied).withColumn("_row", F.monotonically_increasing_id()), "ties")
    number = F.xxhash64("_row")
    narrow = ties.select("_measured.source", "_measured.size", number.alias("hash"))
    wanted = planned.where("_planned.share is not null").select("_planned.source", "_planned.size", F.col("_planned.share").alias("extra"))
    last = materialise(_last(narrow, wanted).select(F.struct("of", "of_size", "last").alias("_cut")), "last")
    divided = ties.join(last, F.col("_measured.source").eqNullSafe(F.col("_cut.of")) & (F.col("_measured.size") == F.col("_cut.of_size")))
    divided = divided.withColumn("_copies", every + F.when(number <= F.col("_cut.last"), 1).otherwise(0)).drop("_row", "_cut")
    return copied.where(~F.coalesce(tied, F.lit(False))).unionByName(divided)


def _measured(docs: DataFrame) -> DataFrame:
    """docs with source, size and hash in a struct whose name clashes with nothing of theirs."""
    hashed = F.xxhash64("doc_id", "text").alias("hash")
    return docs.select("*", F.struct(F.col("source"), word_count(F.col("text")).alias("size"), hashed).alias("_measured"))


def _planned(narrow: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """The plan in a struct, written: it is read for the rows and for the ties."""
    planned = plan(narrow, weights, share)
    return materialise(planned.select(F.struct(*planned.columns).alias("_planned")), "plan")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every document."""
    narrow = materialise(_measured(docs).select("doc_id", "_measured"), "sizes")
    copied = _copied(narrow, _planned(narrow.select("_measured.*"), weights, share))
    return copied.select(
        "doc_id", "_measured.source", "_measured.size", "_planned.source_size", "_planned.target",
        F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_measured.size")).alias("taken"),
    )


def repeat(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it."""
    measured = _measured(docs)
    narrow = materialise(measured.select("_measured.*"), "sizes")
    copied = _copied(measured, _planned(narrow, weights, share))
    return copied.withColumn("_nth", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)
