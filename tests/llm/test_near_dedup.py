"""Near duplicates against comparing all pairs; components; the posterior bound."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskspark.llm import near_dedup
from riskspark.llm.common import table
from riskspark.llm.components import components
from riskspark.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import messy_docs, near_duplicates

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("n", [2, 5])
def test_whole_table(spark, n):
    docs = table(spark, SF, "documents")
    want = near_duplicates([(r.doc_id, r.text) for r in docs.collect()], n)
    got = near_dedup.near_duplicates(docs, n)
    assert rows_of(got) == want
    assert got.where("kept <> (doc_id = component_id)").isEmpty()


def test_query_equals_its_sql(spark, duck):
    got = sorted(tuple(r) for r in QUERIES["op4_near_dedup"](spark, SF).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == sorted(duck.execute(ORACLES["op4_near_dedup"]).fetchall())


def edited(r, words, n):
    words = list(words)
    for k in r.sample(range(len(words)), n):
        words[k] = f"e{r.random()}"
    return " ".join(words)


@pytest.mark.parametrize("block", [(1024, 1 << 20), (7, 1 << 20), (1024, 900)])
def test_group_of_near_copies_around_the_threshold(spark, monkeypatch, block):
    """A dense group with edits of every size, chains, copies, and a passage that others share."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block[0])
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block[1])
    r = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    texts = [edited(r, base, r.randint(0, 14)) for _ in range(120)]
    texts += texts[:15] + [t.upper() for t in texts[15:25]]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(12):
        texts.append(edited(r, chain, 0))
        for k in r.sample(range(120), 4):
            chain[k] = f"d{r.random()}"
    passage = [f"p{i}" for i in range(60)]
    texts += [" ".join(passage + [f"q{r.random()}" for _ in range(r.randint(5, 60))]) for _ in range(60)]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(near_dedup.near_duplicates(docs, 2)) == near_duplicates(rows, 2)


def test_awkward_rows(spark):
    docs = messy_docs(spark)
    got = near_dedup.near_duplicates(docs, 2)
    assert got.count() == docs.count()
    known = [(r.doc_id, r.text) for r in docs.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    want = near_duplicates(known, 2)
    assert rows_of(got.where("doc_id is not null")) == want
    assert all(r.component_id is None and r.kept for r in got.where("doc_id is null").collect())
    for r in got.where("doc_id in (100, 101, 102)").collect():
        assert (r.n_shingles, r.component_id, r.kept) == (0, r.doc_id, True)
    kept = near_dedup.keep(docs, 2)
    assert kept.columns == docs.columns and kept.exceptAll(docs).collect() == []
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(d for d, (_, c) in want.items() if c == d)
    assert near_dedup.near_duplicates(docs.limit(0), 2).isEmpty()


def test_components(spark):
    r = random.Random(8)
    path = [(i, i + 1) for i in range(60)]
    star = [(500, 500 + i) for i in range(1, 40)] + [(700 + i, 699) for i in range(1, 9)]
    ring = [(900 + i, 900 + (i + 1) % 17) for i in range(17)]
    links = [(b, a) if r.random() < 0.5 else (a, b) for a, b in path + star + ring + [(7, 7)]] * 2
    r.shuffle(links)
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {500 + i: 500 for i in range(1, 40)} | {700 + i: 699 for i in range(1, 9)} | {900 + i: 900 for i in range(1, 17)}
    assert {k: v for k, v in got.items() if k != v} == want
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_posterior_bound():
    """The fewest matches kept are the first whose posterior tail reaches the chosen chance."""
    need = near_dedup.least_matches(80)
    assert sorted(need) == [32, 64, 96, 128, 160]
    for n, m in need.items():

        def tail(m, n=n):  # the posterior beta density above 0.8, by summing thin slices
            xs = [0.8 + 0.2 * (k + 0.5) / 4000 for k in range(4000)]
            scale = math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n - m + 1))
            return sum(x**m * (1 - x) ** (n - m) for x in xs) * scale * 0.2 / 4000

        assert tail(m) >= near_dedup.MISS > tail(m - 1)


def test_kept_documents_are_unlike(spark):
    docs = table(spark, SF, "documents")
    once = near_dedup.keep(docs)
    again = near_dedup.near_duplicates(once, 5)
    assert again.where(~F.col("kept")).isEmpty()


def test_keep_with_one_id_on_two_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near_b = b + " more"
    for rows, groups in (
        ([(3, a), (5, a), (5, b), (7, b)], [{a}, {b}]),
        ([(2, near_b), (3, a), (3, b), (9, c), (9, c)], [{a}, {b, near_b}, {c}]),
    ):
        got = [tuple(r) for r in near_dedup.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        assert set(got) <= set(rows) and len(got) == len(groups)
        assert all(sum(t in g for _, t in got) == 1 for g in groups)


def test_keep_takes_the_first_row_by_its_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(4, text, "b", 1), (4, text, None, 9), (4, text, None, 3), (6, text, None, 0)]
    got = near_dedup.keep(spark.createDataFrame(rows, "doc_id long, text string, source string, kept int"))
    assert [tuple(r) for r in got.collect()] == [(4, text, None, 3)]
