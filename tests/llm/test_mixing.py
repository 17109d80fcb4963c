"""Mixing: targets by plain water filling, the dual, copies, awkward rows."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskspark.llm import mixing
from riskspark.llm.common import table
from riskspark.llm.queries import QUERIES
from tests.llm.helpers import WORD, messy_docs

SF = "/root/testdata/sf0.001"


def filled(sizes, weights=(3, 1, 2), share=1.5):
    """Target of each source: give by weight, cap, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, share * sum(sizes.values())
    while True:
        open_ones = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / max(1e-300, sum(weight[s] for s in open_ones))
        over = [s for s in open_ones if level * weight[s] > 2 * sizes[s] * (1 + 1e-12)]
        if not over:
            return capped | {s: level * weight[s] for s in open_ones}
        capped |= {s: 2.0 * sizes[s] for s in over}


def checked(rows):
    per, target, taken, largest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in rows:
        per[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = filled(per)
    for s in per:
        assert math.isclose(target[s], want[s], rel_tol=1e-9, abs_tol=1e-6)
        least = min(r.size for r in rows if r.source == s and r.size) if per[s] else 0
        assert abs(taken[s] - target[s]) <= max(least, 0.01 * target[s]) + 1
    for r in rows:
        assert r.source_size == per[r.source]


def test_whole_table(spark):
    rows = QUERIES["op8_mixing"](spark, SF).collect()
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.size == len(WORD.findall(docs[r.doc_id].text or "")) for r in rows)
    checked(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op8_mixing"](spark, SF).collect()))


def test_rates_are_exponentially_tilted(spark):
    """log(rate / (2 - rate)) is proportional to the size, with one factor per source."""
    rows = [("a", 10, 5), ("a", 20, 3), ("a", 70, 2), ("b", 30, 4), ("b", 31, 1)]
    classes = spark.createDataFrame(rows, "source string, size long, n long")
    goals = spark.createDataFrame([("a", 250, 10, 300.0), ("b", 151, 5, 90.0)], "source string, source_size long, n_docs long, target double")
    dual = {r.source: r for r in mixing.balance(classes, goals).collect()}
    for s, target in (("a", 300.0), ("b", 90.0)):
        rate = lambda size, d=dual[s]: 2 / (1 + math.exp(-d.multiplier * size / d.scale))
        assert math.isclose(sum(n * size * rate(size) for o, size, n in rows if o == s), target, rel_tol=1e-5)


@pytest.mark.parametrize("share", [0.01, 0.5, 1.9, 2.0])
def test_other_shares(spark, share):
    docs = table(spark, SF, "documents").where("source in ('src1', 'src2', 'src3')")
    rows = mixing.mix(docs, share=share).collect()
    total = sum(r.size for r in rows)
    assert abs(sum(r.taken for r in rows) - share * total) <= 0.02 * total


def test_awkward_rows(spark):
    docs = messy_docs(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (100, 101, 102))
    per = defaultdict(int)
    for r in rows:
        per[r.source] += r.size
        assert 0 <= r.taken <= 2 * r.size
    want = filled(per)
    assert all(math.isclose(r.target, want[r.source], abs_tol=1e-6) for r in rows)
    repeated = mixing.repeat(docs)
    assert repeated.columns == docs.columns
    words = repeated.select(F.sum(F.size(F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")))).first()[0]
    assert words == sum(r.taken for r in rows)
    assert mixing.mix(docs.limit(0)).isEmpty() and mixing.repeat(docs.limit(0)).isEmpty()


def test_hot_class_takes_its_share(spark):
    """Thousands of documents of one size in one source: exactly so many take one copy more."""
    docs = spark.range(5000).selectExpr("id as doc_id", "'a b c' as text", "if(id % 50 = 0, 'x', 'y') as source")
    rows = mixing.mix(docs, weights=(3, 4), share=1.2).collect()
    checked_targets = filled({"x": 300, "y": 14700}, (3, 4), 1.2)
    for s in "xy":
        taken = sum(r.taken for r in rows if r.source == s)
        assert abs(taken - checked_targets[s]) <= 3


def test_only_some_of_many_repeated_rows_take_one_copy_more(spark):
    """One source is one row, 90 times: its target is met to a row, not overshot by all of them."""
    rows = [(1, "a b c d e", "x", k) for k in range(90)] + [(k, f"w{k} " * 5, "y", k) for k in range(100, 190)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long").repartition(5)
    got = mixing.mix(docs, weights=(3, 4), share=1.2).collect()
    assert len(got) == len(rows)
    for source in "xy":
        mine = [r for r in got if r.source == source]
        assert len({r.copies for r in mine}) == 2 and abs(sum(r.taken for r in mine) - mine[0].target) <= 5
    repeated = mixing.repeat(docs, weights=(3, 4), share=1.2)
    assert repeated.columns == docs.columns
    assert {r[0]: r[1] for r in repeated.groupBy("source").count().collect()} == {s: sum(r.copies for r in got if r.source == s) for s in "xy"}
    assert repeated.select("n").where("n < 90").distinct().count() == sum(r.copies > 0 for r in got if r.source == "x")
