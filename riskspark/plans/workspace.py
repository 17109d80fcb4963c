"""Where intermediate tables and streaming checkpoints go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a folder below
    the warehouse is used, which is shared wherever tables are.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/riskspark-work"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    For frames with several consumers: they are computed once, their lineage ends
    here, they outlive a lost executor, and Spark knows their size when it plans
    the joins that follow.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's switch to remove the shuffle files of a query when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when that query ends.

    Otherwise they stay on the executors' disks until the driver collects the garbage that
    refers to them, which a driver that has little to do puts off for many steps. For jobs
    whose steps are stored: no later query reads the shuffles of an earlier one.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def make_folder(spark: SparkSession, path: str) -> None:
    """Make the folder through the file system that holds it, unless it is there."""
    files, at = _hadoop(spark, path)
    files.mkdirs(at)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder whose contents have been used."""
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a finished folder its place, where there is none yet."""
    files, at = _hadoop(spark, path)
    files.mkdirs(_hadoop(spark, to)[1].getParent())
    if not files.rename(at, _hadoop(spark, to)[1]):
        raise OSError(f"{path} cannot be moved to {to}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders below a path, those of unfinished work left out."""
    files, at = _hadoop(spark, path)
    found = files.listStatus(at) if files.exists(at) else []
    return [f.getPath().toString() for f in found if f.isDirectory() and not f.getPath().getName().startswith("_")]


def files(spark: SparkSession, path: str) -> list[str]:
    """The names of the files in a folder, checksums left out."""
    store, at = _hadoop(spark, path)
    found = store.listStatus(at) if store.exists(at) else []
    return [f.getPath().getName() for f in found if f.isFile() and not f.getPath().getName().startswith(".")]


def make_file(spark: SparkSession, path: str) -> None:
    """Make an empty file, which must not be there."""
    store, at = _hadoop(spark, path)
    store.create(at, False).close()
