"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node that can be reached, for links (a, b).

    Alternates two steps that hang nodes onto smaller neighbours until nothing moves;
    the number of rounds grows with the logarithm of the longest path. Only links are
    kept between rounds, each round is written, and a node with very many neighbours
    is split by adaptive execution, as each step is an aggregate and a join.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = _state(edges)
    while before[0]:
        # large star: every larger neighbour of u hangs onto the smallest node around u
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = materialise(large, "links")
        # small star: u and its smaller neighbours hang onto the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
