"""Statistics of labelled documents, for fitting, and of all documents, for scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import crc_bucket, released
from riskspark.llm.text import RATIOS, slices, statistics

#: Documents a model is fitted on at most. Scoring, of course, covers all.
FIT_ROWS = 20_000
#: Rows with this remainder of crc32(doc_id) modulo 3 are held out.
HELD_OUT = 1


def training_rows(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, quality) of at most ``most`` labelled documents that are not held out.

    The sample is the smallest hashes of the labelled ids, the same at every run. The
    ids are at most ``most`` rows, which is why they may be broadcast. An id with
    several labels counts as bad if one of them says so; a label that is neither 0
    nor 1, or without an id, is not used.
    """
    ids = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)")
        .where(crc_bucket(F.col("doc_id")) != HELD_OUT)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, x = statistics(part["text"])
                x = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(RATIOS)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["quality"], x], ["doc_id", "quality", "x"])

    found = (
        chosen.mapInArrow(released(measure), T.StructType([chosen.schema["doc_id"], chosen.schema["quality"]]).add("x", T.ArrayType(T.FloatType())))
        .dropDuplicates(["doc_id"])
        .toPandas()
        .sort_values("doc_id")
    )
    x = np.array(found["x"].tolist(), np.float32).reshape(len(found), len(RATIOS))
    return x, found["quality"].to_numpy(float)


def map_texts(docs: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """Apply a function to the rows of ``docs``, about a megabyte of text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield make(part)

    return docs.mapInArrow(released(run), schema)
