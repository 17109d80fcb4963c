"""Top-k against scoring all pairs; language-model scores against counting in plain Python."""

import math
import random

import numpy as np
import pytest

from riskspark.llm import lm_scoring, topk
from riskspark.llm.common import table
from riskspark.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import labels, messy_docs

SF = "/root/testdata/sf0.001"


def all_pairs(rows, queries, k):
    out = []
    for q, v in queries:
        met = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(met[:k])]
    return sorted(out)


def test_topk_equals_its_sql(spark, duck):
    got = QUERIES["op1_topk"](spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(duck.execute(ORACLES["op1_topk"]).fetchall())


@pytest.mark.parametrize("block", [2048, 30, 1])
def test_topk_with_ties_copies_zeros_and_widths(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SHARD", 2 * block)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "FIRST_DEPTH", 4)
    r = random.Random(4)
    rows = [(i, [r.choice([-2.0, -1.0, 0.0, 1.0, 3.0]) / 1024 for _ in range(6)]) for i in range(90)]
    rows += [(i, rows[0][1]) for i in range(100, 140)] + [(200, [0.0] * 6), (201, [1.0, 2.0]), (202, [1.0, -2.0]), (203, [])]
    bad = [(300, None), (301, [1.0, None]), (302, [float("nan"), 1.0]), (303, [float("inf")] * 6), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], "vec_id long, embedding array<float>, score string, rank int")
    whole = topk.whole(frame)
    assert whole.count() == len(rows)
    got = sorted(map(tuple, topk.top_k(whole.where("vec_id % 10 = 0"), whole, 5).collect()))
    plain = [(i, [math.floor(np.float64(x) * 1024) for x in v]) for i, v in rows]
    assert got == all_pairs(plain, [x for x in plain if x[0] % 10 == 0], 5)


def test_topk_of_large_numbers_is_exact(spark):
    rows = [(i, [2.0**20 + i, 2.0**20 - i, 1 / 1024]) for i in range(40)]
    whole = topk.whole(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    plain = [(i, [math.floor(x * 1024) for x in v]) for i, v in rows]
    assert sorted(map(tuple, topk.top_k(whole, whole, 3).collect())) == all_pairs(plain, plain, 3)


def test_topk_stops_early_where_lists_allow(monkeypatch):
    """Vectors far ahead in every list: reading ends long before the lists do."""
    r = np.random.default_rng(0)
    vectors = r.integers(0, 10, (500, 4))
    vectors[7:9] = [[1000] * 4, [900] * 4]
    depths = []
    real = np.bincount
    monkeypatch.setattr(topk.np, "bincount", lambda x, *a: (depths.append(len(x) // 4), real(x, *a))[1])
    assert topk.Block(np.arange(500), vectors).best(np.array([1, 1, 1, 1]), own=-1, k=2) == [(4000, 7), (3600, 8)]
    assert sum(depths) <= 250


def test_topk_of_nothing(spark):
    none = topk.whole(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(none, none).isEmpty()
    one = topk.whole(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"))
    assert topk.top_k(one, one).isEmpty()


def plain_scores(docs, good, places):
    """The same formulas with dictionaries; ``places`` maps words and pairs to hashed places."""
    word, pair = places
    counts = {}
    for which in ("target", "background"):
        c1, c2, n = {}, {}, 0
        for d, t in docs:
            if which == "background" or d in good:
                w = (t or "").encode().lower().split()
                n += len(w)
                for x in w:
                    c1[word[x]] = c1.get(word[x], 0) + 1
                for x in zip(w, w[1:], strict=False):
                    c2[pair[x]] = c2.get(pair[x], 0) + 1
        counts[which] = c1, c2, n
    out = []
    for _, t in docs:
        w, loss = (t or "").encode().lower().split(), {}
        for which, (c1, c2, n) in counts.items():
            total, before = 0.0, None
            for x in w:
                p = (c1.get(word[x], 0) + 0.5) / (n + 0.5 * 2**18)
                if before is not None:
                    p = (c2.get(pair[before, x], 0) + 8 * p) / (c1.get(word[before], 0) + 8)
                total -= math.log(p)
                before = x
            loss[which] = total / len(w) if w else None
        out.append((len(w), loss["target"], loss["background"]))
    return out


def test_lm_scores(spark):
    import pyarrow as pa

    docs, marks = messy_docs(spark), labels(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    word, pair = {}, {}
    for _, t in rows:
        w = (t or "").encode().lower().split()
        _, places, at, pairs = lm_scoring._places(pa.array([t]))
        word |= dict(zip(w, places.tolist(), strict=True))
        pair |= dict(zip(zip(w, w[1:], strict=False), pairs.tolist(), strict=True))
    good = {r.doc_id for r in marks.collect() if r.quality == 1 and r.toxic == 0} - {None, 3, 4, 9}
    want = plain_scores(rows, good, (word, pair))
    got = lm_scoring.score(docs, lm_scoring.fit(docs, marks)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for (d, _), x in zip(rows, want, strict=True):
        by_id.setdefault((d, x[0]), x)
    for r in got:
        n, target, background = by_id[r.doc_id, r.n_words]
        if not n:
            assert r.score is None and r.target_loss is None
            continue
        assert r.target_loss == pytest.approx(target, abs=1e-4) and r.background_loss == pytest.approx(background, abs=1e-4)
        assert r.score == pytest.approx(r.target_loss - r.background_loss, abs=1e-6)


def worded_scores(corpus, good, scored):
    """target and background loss of each text, from dictionaries keyed by the words themselves."""
    losses = []
    for which in ("target", "background"):
        c1, c2, seen = {}, {}, set()
        for d, t in corpus:
            w = t.split()
            seen.update(w)
            if which == "background" or d in good:
                for x in w:
                    c1[x] = c1.get(x, 0) + 1
                for x in zip(w, w[1:], strict=False):
                    c2[x] = c2.get(x, 0) + 1
        below = sum(c1.values()) + 0.5 * max(2**18, len(seen))
        of = []
        for t in scored:
            total, before = 0.0, None
            for x in t.split():
                p = (c1.get(x, 0) + 0.5) / below
                if before is not None:
                    p = (c2.get((before, x), 0) + 8 * p) / (c1.get(before, 0) + 8)
                total -= math.log(p)
                before = x
            of.append(total / len(t.split()))
        losses.append(of)
    return list(zip(*losses, strict=True))


def test_lm_scores_with_more_words_than_2_to_18(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK", 300_000)
    monkeypatch.setattr(lm_scoring, "RANGE", 500_000)
    r = random.Random(5)
    rows = [(d, " ".join(r.choice(["the", "of", "and", f"w{d}x{k}", f"w{d}x{k}"]) if k % 3 == 0 else f"w{d}x{k}" for k in range(900))) for d in range(400)]
    rows += rows[:20]  # repeated rows are counted each time
    assert len({x for _, t in rows for x in t.split()}) > 2**18
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame([(d, int(d % 2 == 0), int(d % 6 == 0)) for d in range(300)], "doc_id long, quality int, toxic int")
    good = {d for d in range(300) if d % 2 == 0 and d % 6}
    models = lm_scoring.fit(docs, marks)
    got = lm_scoring.score(docs, models).collect()
    want = dict(zip([d for d, _ in rows], worded_scores(rows, good, [t for _, t in rows]), strict=True))
    assert sorted(x.doc_id for x in got) == sorted(d for d, _ in rows)
    for x in got:
        assert (x.target_loss, x.background_loss) == pytest.approx(want[x.doc_id], abs=1e-8)
    # documents that the models were not counted on: words in common, words of others, words never met
    others = [(1000, rows[2][1] + " the of and"), (1001, "never met the w0x1 w0x2 and w9x9"), (2, "the")]
    got = lm_scoring.score(spark.createDataFrame(others, "doc_id long, text string"), models).collect()
    want = dict(zip([d for d, _ in others], worded_scores(rows, good, [t for _, t in others]), strict=True))
    assert len(got) == 3
    for x in got:
        assert (x.target_loss, x.background_loss) == pytest.approx(want[x.doc_id], abs=1e-8)


def test_lm_scores_part_good_from_bad(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_lm_scoring"](spark, sf)
    marks = table(spark, sf, "labels").groupBy("doc_id").agg({"quality": "min"}).toDF("doc_id", "quality")
    mean = {r[0]: r[1] for r in got.join(marks, "doc_id").groupBy("quality").agg({"score": "avg"}).collect()}
    assert got.count() == table(spark, sf, "documents").count() and mean[1] < mean[0]


def test_lm_scores_of_nothing(spark):
    docs, marks = messy_docs(spark), labels(spark)
    assert lm_scoring.score(docs.limit(0), lm_scoring.fit(docs.limit(0), marks)).isEmpty()
    assert lm_scoring.score(docs, lm_scoring.fit(docs, marks.limit(0))).count() == docs.count()
