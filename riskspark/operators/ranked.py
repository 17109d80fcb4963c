"""A table in the order of its ranks, split over files, with the number of every row at hand.

Rows are cut into ranges of the order and sorted inside each, one shuffle in all. A row's
number is its place in its part plus the rows of the parts before, so neither a global
window nor a sort in one task is needed, and a page reads only the parts it lies in.
``order`` must tell all rows apart, else the numbers of equal ones are arbitrary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
_PLACE_BITS = 33


def write_ranked(df: DataFrame, path: str, order: list[Column]) -> None:
    """Write the rows in order below ``path/rows`` and how many come before each part to ``path/parts``."""
    spark = df.sparkSession
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    part = F.shiftright("_at", _PLACE_BITS).cast("int")
    # not partitioned by part: the writer would sort again; the place and part of a row are in Parquet's statistics
    sorted_rows.select(*df.columns, part.alias("part"), place.alias("place")).write.parquet(f"{path}/rows")
    sizes = spark.read.parquet(f"{path}/rows").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # one row per part, of which there are as many as shuffle partitions
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes.select("part", "n", F.coalesce(before, F.lit(0)).alias("before")).write.parquet(f"{path}/parts")


def numbered(spark: SparkSession, path: str, out: str = "position") -> DataFrame:
    """All rows with their number, from 1."""
    rows, parts = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/parts")
    return rows.join(parts.select("part", "before"), "part").withColumn(out, F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def page(spark: SparkSession, path: str, first: int, size: int, out: str = "position") -> DataFrame:
    """The rows numbered ``first`` to ``first + size - 1``.

    Only the parts that hold them are looked up (one row each); part and place reach the
    scan as literals, so the other row groups are skipped by their statistics.
    """
    last = first + size - 1
    hit = spark.read.parquet(f"{path}/parts").where((F.col("before") < last) & (F.col("before") + F.col("n") >= first)).collect()
    held, number = F.lit(False), F.lit(None).cast("long")
    for p in hit:
        held = held | ((F.col("part") == p["part"]) & (F.col("place") >= first - 1 - p["before"]) & (F.col("place") < last - p["before"]))
        number = F.when(F.col("part") == p["part"], F.col("place") + p["before"] + 1).otherwise(number)
    return spark.read.parquet(f"{path}/rows").where(held).withColumn(out, number).drop("part", "place")
