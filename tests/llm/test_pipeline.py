"""The five stages together, against plain versions of what each decides."""

from collections import Counter

import pyarrow as pa
from pyspark.sql import types as T

import corpus_pipeline
from riskspark.llm import common, labelled, near_dedup, packing, quality_classifier, quality_rules, tokens
from riskspark.llm.common import materialise, table
from tests.llm.helpers import near_duplicates
from tests.llm.test_mixing import filled
from tests.llm.test_tokens import plain

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    marks = table(spark, SF, "labels")
    rules = quality_rules.judge(docs, quality_rules.fit(docs, marks)).where("kept")
    good = quality_classifier.score(docs, quality_classifier.fit(docs, marks)).where("predicted = 1")
    ids = {r.doc_id for r in rules.collect()} & {r.doc_id for r in good.collect()}
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(materialise(stage(spark, frames[-1], SF), name))
        assert frames[-1].columns == docs.columns
    _, _, classified, unlike, mixed = frames
    assert {r.doc_id for r in classified.collect()} == ids
    want = near_duplicates([(r.doc_id, r.text) for r in classified.collect()], 5)
    assert sorted(r.doc_id for r in unlike.collect()) == sorted(d for d, (_, c) in want.items() if c == d)
    size = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in unlike.collect()}
    per, taken = Counter(), Counter()
    for s, n in size.values():
        per[s] += n
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 2
    for d, k in copies.items():
        taken[size[d][0]] += k * size[d][1]
    for s, target in filled(per).items():
        assert abs(taken[s] - target) <= max(60, 0.05 * target)
    rows = corpus_pipeline.STAGES[-1][1](spark, mixed, SF).collect()
    texts = {r.doc_id: r.text for r in unlike.collect()}
    n_ids = dict(zip(texts, (len(x) for x in plain("word_bpe_49k.json", texts.values(), 1)), strict=True))
    placed = Counter()
    for r in rows:
        placed[r.doc_id] += r.length
    assert placed == {d: k * n_ids[d] for d, k in copies.items()}


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id"} <= set(got.columns) and got.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None and near_dedup.LIKE == 80


def test_stages_on_awkward_rows_and_none(spark, tmp_path):
    a, b = (" ".join(f"{x}{k * k}{x}" for k in range(60)) for x in ("alpha", "beta"))
    rows = [(1, a, "s"), (1, a, "s"), (2, a + " more", None), (3, None, "s"), (4, "", "t"), (None, b, None), (5, "again " * 200, "s")]
    fields = "doc_id long, text string, source string, lang string, kept string, score string, size string"
    made = spark.createDataFrame([(*r, None, "x", "y", None) for r in rows], fields)
    marks = table(spark, SF, "labels").limit(0)
    for name, docs in (("some", made), ("none", made.limit(0))):
        sf = str(tmp_path / name)
        docs.write.parquet(f"{sf}/documents.parquet")
        marks.write.parquet(f"{sf}/labels.parquet")
        left = table(spark, sf, "documents")
        for step, stage in corpus_pipeline.STAGES[:-1]:
            left = materialise(stage(spark, left, sf), step)
            assert left.columns == docs.columns
            if step == "near_dedup":
                want = [] if name == "none" else [(None, b), (1, a)]
                assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str, reverse=True) == sorted(want, key=str, reverse=True)
        packed = corpus_pipeline.STAGES[-1][1](spark, left, sf)
        assert {r.doc_id for r in packed.collect()} <= ({1, None} if name == "some" else set())


class _Taken:
    """A frame that keeps the function it is to be mapped by."""

    schema = T.StructType().add("doc_id", "long").add("text", "string")

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self


def test_idle_workers_hold_no_free_memory(monkeypatch):
    """Each function over texts gives memory back at the end of its partition."""
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b c d e f", None]})
    path = tokens.tokenizer_path(packing.TOKENIZER)
    for k, mapped in enumerate((
        lambda d: labelled.map_texts(d, lambda part: part, d.schema),
        lambda d: near_dedup.describe(d, 5),
        lambda d: packing.tokenise(d, path, 1),
    )):
        out = list(mapped(_Taken()).run(iter([batch])))
        assert sum(x.num_rows for x in out) == 2 and len(given) == k + 1
