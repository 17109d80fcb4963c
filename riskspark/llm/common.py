"""What several of the operators need: reading tables, fixed columns, intermediate tables, files."""

from __future__ import annotations

import ctypes
import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.plans.workspace import materialise, new_folder, shared_folder

__all__ = ["SPACE", "WORD", "crc_bucket", "delete", "materialise", "new_folder", "shared_folder", "table", "word_count"]

#: White space and a word, as the contracts of the operators define them.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_bucket(doc_id: Column, parts: int = 3) -> Column:
    """crc32 of the id written as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string")) % parts


def delete(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder through the file system that holds it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as pyarrow's file systems want it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def filesystem(folder: str):
    """(file system, path) of a URI, on whichever machine this runs."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "file://" + "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_once(filesys, path: str, data: bytes) -> None:
    """Write a file under a private name, then give it its own.

    A repeated or speculative attempt of a task replaces the file with the same bytes;
    a reader never sees half of one.
    """
    import uuid

    part = f"{path}.{uuid.uuid4().hex}.part"
    with filesys.open_output_stream(part, compression=None) as out:
        out.write(data)
    filesys.move(part, path)


def released(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run`` over a partition's batches; at its end what the worker holds free goes back to the system.

    Spark keeps an idle Python worker for the tasks of later stages, beside the memory that the
    executor itself needs then.
    """

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    """Free memory of this process that its allocators hold goes back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def to_json(x) -> str:
    return json.dumps(x, sort_keys=True)


#: Rows per Arrow batch, where the session leaves Spark's default: rows here hold whole texts.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Prepare a session, once: send this package to executors that lack it, bound Arrow batches."""
    import tempfile
    import zipfile
    from pathlib import Path

    import riskspark

    sc = spark.sparkContext
    if getattr(sc, "_riskspark_shipped", False):
        return
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)
    root = Path(riskspark.__file__).parent
    path = Path(tempfile.mkdtemp()) / "riskspark.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"riskspark/{f.relative_to(root)}")
    sc.addPyFile(str(path))
    sc._riskspark_shipped = True
