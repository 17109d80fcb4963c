"""From raw documents to packed sequences in five stages.

Each stage takes the documents its predecessor kept, written as Parquet and read again,
and all but the last return the columns of ``documents``:

1. quality rules: documents that fail the base rules or the trees' verdict go;
2. quality classifier: documents predicted to be bad go;
3. near-duplicates (five-word shingles, similarity 0.8): one document of each group stays;
4. mixing: every source is brought to its target, documents repeated or left out;
5. packing: token sequences.

Cases: documents with a null or empty text fail the first stage. Ids, sources and all other
columns may be null and pass through whatever their names; a null source is a source of
its own. Rows equal in id and text are one document after the third stage, the first by
the other columns. Without usable labels the trees let pass what the base rules keep. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import mixing, near_dedup, packing, quality_classifier, quality_rules
from riskspark.llm.common import materialise, ship, table


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality_rules.keep(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the documents as given; those kept so far hold few bad ones."""
    ship(spark)
    model = quality_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.keep(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dedup.keep(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.repeat(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The stages fit models and pack by algorithm, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {}
