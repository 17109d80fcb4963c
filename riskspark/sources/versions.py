"""Marts replaced in one step: a folder per version, and a mark written when all of it is there.

A run writes all its marts below a version of its own and publishes it last. Readers take
the newest published version, so they see all marts of one run or all of the run before,
never a half-written one. The mark is an empty file whose name says which version counts;
making it is one step on any file system, and nothing that is read is ever overwritten.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskspark.plans.workspace import delete, files, folders, make_file

#: Published versions that stay; a reader that opened an older one has to open it again.
KEPT = 2
#: Hours after which a version that was never published counts as left by a dead run.
UNFINISHED_HOURS = 72


def new_version(root: str) -> str:
    """The folder for the marts of a new version; names ascend with the time they are given."""
    return f"{root}/version-{time.time_ns():020d}-{uuid.uuid4().hex}"


def published(spark: SparkSession, root: str) -> list[str]:
    """The folders of the published versions, in the order of their publication."""
    return [f"{root}/{name.split('.', 1)[1]}" for name in sorted(files(spark, f"{root}/_published"))]


def current(spark: SparkSession, root: str) -> str:
    """The folder of the version that counts."""
    found = published(spark, root)
    if not found:
        raise FileNotFoundError(f"no version is published in {root}")
    return found[-1]


def publish(spark: SparkSession, root: str, version: str, kept: int = KEPT) -> None:
    """Make a finished version the one that counts, then remove those beyond the last ``kept``."""
    make_file(spark, f"{root}/_published/{time.time_ns():020d}.{version.rsplit('/', 1)[1]}")
    marks = sorted(files(spark, f"{root}/_published"))
    stay = {m.split(".", 1)[1] for m in marks[-kept:]}
    limit = time.time_ns() - UNFINISHED_HOURS * 3600 * 10**9
    gone = [m for m in marks if m.split(".", 1)[1] not in stay]
    known = {m.split(".", 1)[1] for m in marks}
    for mark in gone:  # the mark goes first, so that no reader is sent to a folder on its way out
        delete(spark, f"{root}/_published/{mark}")
        delete(spark, f"{root}/{mark.split('.', 1)[1]}")
    for folder in folders(spark, root):
        name = folder.rsplit("/", 1)[1]
        if name.startswith("version-") and name not in known and int(name.split("-")[1]) < limit:
            delete(spark, folder)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart of the version that counts."""
    return spark.read.parquet(f"{current(spark, root)}/{name}")
