"""Text search over a stored mart without reading the mart.

The mart is written in the order of its ranks (``ranked``). Beside it lie three tables:

- ``grams``: every three characters of every distinct name, in lower case, with the name,
  sorted by both. One list of names per gram, cut anywhere, so a gram that all names share
  is spread over files like any other;
- ``sizes``: how many names each gram has;
- ``places``: for every name the part and place of its rows, with the columns to filter by.

A text of three characters or more is looked up in the list of its rarest gram only. As
the list holds the names themselves, each is verified in the same scan, so the result is
exact and no lists have to be intersected. A shorter text has no gram and is compared with
the names in ``places``, which are still far fewer bytes than the mart. The mart is read
last, by part and place.

A null name contains nothing; the empty text finds all rows; an empty mart gives none. A
row found by several of its names comes once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.ranked import write_ranked
from riskspark.plans.workspace import materialise

GRAM = 3
#: Own columns of ``places``, set apart from those of the mart.
_AT = ("part", "place")


def _grams(text: Column) -> Column:
    """The distinct grams of a text in lower case; none if it is too short."""
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))))


def write_index(df: DataFrame, path: str, order: list[Column], texts: list[str], filters: list[str]) -> None:
    """Write the mart in ``order``, which must tell all rows apart, and its index by the columns ``texts``.

    ``filters`` are the columns that a search can ask to be equal to a value.
    """
    spark = df.sparkSession
    write_ranked(df, path, order)
    rows = spark.read.parquet(f"{path}/rows")
    names = F.array(*[F.struct(F.lit(k).alias("slot"), F.lower(c).alias("name")) for k, c in enumerate(texts)])
    kept = F.struct(*[F.col(c) for c in filters]) if filters else F.lit(None).cast("struct<none:int>")
    places = rows.select(F.explode(names).alias("n"), *_AT, kept.alias("filter")).select("n.*", *_AT, "filter")
    # by place too, so that a name with very many rows is several ranges
    places.repartitionByRange("name", *_AT).sortWithinPartitions("name", *_AT).write.parquet(f"{path}/places")
    distinct = spark.read.parquet(f"{path}/places").where("name is not null").select("name").distinct()
    grams = distinct.select(F.explode(_grams(F.col("name"))).alias("gram"), "name")
    grams.repartitionByRange("gram", "name").sortWithinPartitions("gram", "name").write.parquet(f"{path}/grams")
    sizes = spark.read.parquet(f"{path}/grams").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    sizes.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/sizes")


def names_with(spark: SparkSession, path: str, text: str) -> DataFrame:
    """The distinct names, in lower case, that contain the text in any case."""
    needle = F.lower(F.lit(text))
    asked = spark.range(1).select(_grams(needle).alias("grams")).first()["grams"]
    holds = F.contains("name", needle)
    if not asked:
        return spark.read.parquet(f"{path}/places").where(F.col("name").isNotNull() & holds).select("name").distinct()
    # one row per gram of the text asked for
    sizes = {r["gram"]: r["n"] for r in spark.read.parquet(f"{path}/sizes").where(F.col("gram").isin(asked)).collect()}
    rarest = min(asked, key=lambda g: sizes.get(g, 0))
    return spark.read.parquet(f"{path}/grams").where((F.col("gram") == rarest) & holds).select("name")


def found(spark: SparkSession, path: str, text: str = "", equals: dict[str, str] | None = None) -> DataFrame:
    """part and place of the rows with the text in a name and all non-empty filters met, once each."""
    places = spark.read.parquet(f"{path}/places")
    for c, value in (equals or {}).items():
        if value:
            places = places.where(F.col("filter")[c] == value)
    if not text:
        return places.where("slot = 0").select(*_AT)
    # written first, so that Spark knows how few they are
    names = materialise(names_with(spark, path, text), "names")
    return places.join(names, "name", "left_semi").select(*_AT).distinct()


def search(spark: SparkSession, path: str, text: str = "", equals: dict[str, str] | None = None) -> DataFrame:
    """All rows found. The mart's scan is limited to the parts that hold some."""
    hits = materialise(found(spark, path, text, equals), "hits")
    # as many values as the mart has parts at most
    parts = [r["part"] for r in hits.select("part").distinct().collect()]
    rows = spark.read.parquet(f"{path}/rows").where(F.col("part").isin(parts))
    return rows.join(hits, list(_AT), "left_semi").drop(*_AT)


def search_page(spark: SparkSession, path: str, size: int, after: int = 0, text: str = "", equals: dict[str, str] | None = None, out: str = "position") -> DataFrame:
    """The first ``size`` rows found whose position in the mart is larger than ``after``, with that position.

    The next page is asked for with the last position of this one, so that a late page
    costs no more than the first.
    """
    before = spark.read.parquet(f"{path}/parts").select("part", "before", "n").where(F.col("before") + F.col("n") > after)
    number = F.col("before") + F.col("place") + 1
    hits = found(spark, path, text, equals).join(before, "part").where(number > after)
    page = hits.select(*_AT, number.alias(out)).orderBy(out).limit(size).collect()
    by_part: dict[int, list[int]] = {}
    for r in page:
        by_part.setdefault(r["part"], []).append(r["place"])
    held, told = F.lit(False), F.lit(None).cast("long")
    first = {r["part"]: r[out] - r["place"] for r in page}
    for part, places in by_part.items():
        held = held | ((F.col("part") == part) & F.col("place").isin(places))
        told = F.when(F.col("part") == part, F.col("place") + first[part]).otherwise(told)
    return spark.read.parquet(f"{path}/rows").where(held).withColumn(out, told).drop(*_AT)
