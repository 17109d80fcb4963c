"""Counts over many texts at once against counting them one by one; boosted trees."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import trees
from riskspark.llm.text import BASE, Words, raw, shingle_sets, slices, statistics
from tests.llm.helpers import WORD, base_counts, shingles, some_texts


def counted(texts):
    base, x = statistics(pa.array(texts, pa.string()))
    assert np.isfinite(x).all() and len(x) == len(texts)
    return list(zip(*(base[c].tolist() for c in BASE), strict=True))


def test_base_counts_of_many_texts():
    texts = [*some_texts(200), None, "", "\n", "a\nb\na\nb", "a b c a b c", "x\n\nx\r\nx", "end\n"]
    assert counted(texts) == [base_counts(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é日\x1c ", max_size=40) | st.none(), max_size=8))
def test_base_counts_of_any_texts(texts):
    assert counted(texts) == [base_counts(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbBé \n ", max_size=30) | st.none(), max_size=8), st.integers(1, 5))
def test_shingle_sets(texts, n):
    doc, value, size = shingle_sets(pa.array(texts, pa.string()), n)
    assert size.tolist() == [len(shingles(t, n)) for t in texts]
    assert np.bincount(doc, minlength=len(texts)).tolist() == size.tolist()
    for i, a in enumerate(texts):  # equal sets, and only those, have equal hashes
        for j, b in enumerate(texts):
            common = np.intersect1d(value[doc == i], value[doc == j])
            assert len(common) == len(shingles(a, n) & shingles(b, n))


def test_words_end_with_their_text():
    w = Words(*raw(pa.array(["ab", "cd", "", " e"], pa.string())))
    assert w.n_words.tolist() == [1, 1, 0, 1] and len(w.hashes()) == 3
    assert len(WORD.findall("ab c")) == 1 == Words(*raw(pa.array(["ab c"]))).n_words[0]


def test_slices_cover_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 2000, 5, 5, 900, 200)] + [None]})
    parts = list(slices(batch, most=1000))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) > 2


def drawn(n=600, seed=0):
    r = np.random.default_rng(seed)
    x = r.random((n, 3)).astype(np.float32)
    return x, ((x[:, 0] > 0.5) & (x[:, 1] < 0.7)).astype(float)


def test_trees_learn_a_rule():
    model = trees.fit(*drawn())
    x, y = drawn(seed=1)
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.95
    assert ((0 <= model.score(x)) & (model.score(x) <= 1)).all()


@pytest.mark.parametrize("sign", [1, -1])
def test_trees_are_monotonic_where_asked(sign):
    r = np.random.default_rng(5)
    x = r.random((500, 2)).astype(np.float32)
    y = (np.sin(9 * x[:, 0]) + x[:, 1] + r.normal(0, 0.3, 500) > 0.7).astype(float)
    model = trees.fit(x, y, monotone={0: sign})
    for other in np.linspace(0, 1, 11):
        line = np.column_stack([np.linspace(-0.5, 1.5, 300), np.full(300, other)]).astype(np.float32)
        steps = np.diff(model.raw(line)) * sign
        assert (steps >= -1e-9).all()
    free = trees.fit(x, y)
    line = np.column_stack([np.linspace(0, 1, 300), np.full(300, 0.5)]).astype(np.float32)
    assert (np.diff(free.raw(line)) > 0).any() and (np.diff(free.raw(line)) < 0).any()


@pytest.mark.parametrize("y", [[], [1.0] * 8, [0.0] * 8])
def test_trees_without_two_classes_are_a_constant(y):
    x = np.arange(len(y) * 2, dtype=np.float32).reshape(-1, 2)
    score = trees.fit(x, np.array(y)).score(np.ones((3, 2), np.float32))
    assert len(set(score)) == 1 and (score[0] >= 0.5) == (not y or y[0] == 1)
