"""Quality classifier: histogram gradient-boosted trees over document statistics.

Fitted on a bounded sample of the labelled documents whose crc32(doc_id) modulo 3 is
not 1; the others are held out, so that accuracy can be measured on them. Labels,
language, source and id are never inputs of the score.

Cases: a null text counts as empty, and an empty text has a score as any other. A null
doc_id is scored; held_out is then null. Repeated rows get the same score each. Without
usable labels every score is 0.5. Only doc_id and text are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm import trees
from riskspark.llm.common import crc_bucket
from riskspark.llm.labelled import FIT_ROWS, HELD_OUT, map_texts, training_rows
from riskspark.llm.text import statistics

GOOD_FROM = 0.5


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> trees.Trees:
    """The model, from at most ``most`` labelled documents that are not held out."""
    return trees.fit(*training_rows(docs, labels, most), trees=80)


def score(docs: DataFrame, model: trees.Trees) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    schema = T.StructType([docs.schema["doc_id"]]).add("score", "double")

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part["doc_id"], pa.array(model.score(statistics(part["text"])[1]))], schema.names)

    return map_texts(docs.select("doc_id", "text"), make, schema).select(
        "doc_id",
        (crc_bucket(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, model: trees.Trees) -> DataFrame:
    """The documents predicted to be good, with all their columns."""

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(model.score(statistics(part["text"])[1]) >= GOOD_FROM))

    return map_texts(docs, make, docs.schema)
