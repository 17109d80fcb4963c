"""Quality rules: fixed base rules, then gradient-boosted trees that respect directions.

The trees learn ``labels.quality`` from document statistics. For the statistics in
``DIRECTIONS`` the score is monotonic by construction: more symbols or more repetition
never makes a document better. So the verdict stays a rule one can reason about.

Cases: a null or empty text has no words, so it fails the base rules and is not kept.
Any other column may be null. Repeated rows get the same verdict each. Without usable
labels the model is the constant 0.5, which keeps what the base rules keep. Only the
columns doc_id and text are read; others pass through ``keep`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskspark.llm import trees
from riskspark.llm.labelled import FIT_ROWS, map_texts, training_rows
from riskspark.llm.text import BASE, RATIOS, statistics

#: Statistics with a known direction: +1, the score may only rise with it; -1, only fall.
DIRECTIONS = {
    "symbol_share": -1, "bar_share": -1, "mark_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "dup_pair_share": -1, "top_word_share": -1, "distinct_share": 1,
}
LEAST_WORDS = 50
MOST_REPEATED_PCT = 50
KEEP_FROM = 0.5


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> trees.Trees:
    """The model, from at most ``most`` labelled documents that are not held out."""
    x, y = training_rows(docs, labels, most)
    return trees.fit(x, y, monotone={RATIOS.index(k): s for k, s in DIRECTIONS.items()})


def verdicts(texts: pa.Array, model: trees.Trees) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(base counts, base_failed, score, kept) of a run of texts."""
    base, x = statistics(texts)
    failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED_PCT * base["n_words"])
    score = model.score(x)
    return base, failed, score, ~failed & (score >= KEEP_FROM)


def judge(docs: DataFrame, model: trees.Trees) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the score of every document."""
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in BASE]])
    schema = schema.add("base_failed", "boolean").add("kept", "boolean").add("score", "double")

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        base, failed, score, kept = verdicts(part["text"], model)
        columns = [part["doc_id"], *[pa.array(base[c], pa.int64()) for c in BASE], *map(pa.array, (failed, kept, score))]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    return map_texts(docs.select("doc_id", "text"), make, schema)


def keep(docs: DataFrame, model: trees.Trees) -> DataFrame:
    """The documents that pass, with all their columns."""
    return map_texts(docs, lambda part: part.filter(pa.array(verdicts(part["text"], model)[3])), docs.schema)
