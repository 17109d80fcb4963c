"""Quality rules and classifier: base counts, held-out accuracy, awkward rows."""

import zlib

import pytest

from riskspark.llm import quality_classifier, quality_rules
from riskspark.llm.common import table
from riskspark.llm.queries import QUERIES
from tests.llm.helpers import base_counts, labels, messy_docs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").toPandas().set_index("doc_id")["text"]
    marks = table(spark, SF, "labels").toPandas().drop_duplicates("doc_id").set_index("doc_id")["quality"]
    return docs, marks


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_rules_on_the_whole_table(spark, given):
    docs, marks = given
    got = QUERIES["op10_quality_rules"](spark, SF).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for i, row in zip(got.index, got[names].itertuples(index=False), strict=True):
        want = base_counts(docs[i])
        assert tuple(row) == want
        assert got.base_failed[i] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert not (got.kept & got.base_failed).any()
    known = got[~got.base_failed & got.index.isin(marks.index)]
    right = known.kept.astype(int) == marks[known.index]
    assert right[[held(i) for i in known.index]].mean() > 0.97


def test_classifier_on_the_whole_table(spark, given):
    docs, marks = given
    got = QUERIES["op7_quality_classifier"](spark, SF).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index)
    assert got.held_out.tolist() == [held(i) for i in got.index]
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    known = got[got.index.isin(marks.index) & got.held_out]
    assert (known.predicted == marks[known.index]).mean() > 0.97


def test_awkward_rows(spark):
    docs, marks = messy_docs(spark), labels(spark)
    for module, out in ((quality_rules, quality_rules.judge), (quality_classifier, quality_classifier.score)):
        model = module.fit(docs, marks)
        got = out(docs, model)
        assert got.count() == docs.count()
        assert got.select("doc_id").exceptAll(docs.select("doc_id")).collect() == []
        kept = module.keep(docs, model)
        assert kept.columns == docs.columns and kept.exceptAll(docs).collect() == []
    judged = quality_rules.judge(docs, quality_rules.fit(docs, marks)).where("doc_id in (100, 101, 102)").collect()
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in judged)


def test_without_labels_or_documents(spark):
    docs, marks = messy_docs(spark), labels(spark)
    for module, out in ((quality_rules, quality_rules.judge), (quality_classifier, quality_classifier.score)):
        model = module.fit(docs, marks.limit(0))
        assert {r.score for r in out(docs, model).collect()} == {0.5}
        assert out(docs.limit(0), module.fit(docs.limit(0), marks)).isEmpty()


def test_scores_do_not_depend_on_other_columns(spark):
    docs, marks = messy_docs(spark), labels(spark)
    model = quality_classifier.fit(docs, marks)
    other = docs.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang", "'zz' as source")
    pick = lambda frame: sorted(r.score for r in quality_classifier.score(frame, model).collect())
    assert pick(docs) == pick(other)
