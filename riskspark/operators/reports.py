"""The tables behind the fraud report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.rules import by_risk

SEVERITY_ORDER = ["Critical", "High", "Medium", "Low"]  # fixed order of the report


def severity_distribution(flagged: DataFrame) -> DataFrame:
    """Flagged transactions by severity, worst first; absent severities are left out."""
    order = F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), F.col("severity"))
    return (
        flagged.groupBy("severity")
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .orderBy(order)
    )


def score_distribution(flagged: DataFrame) -> DataFrame:
    return (
        flagged.groupBy("fraud_score")
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .orderBy("fraud_score")
    )


def flagged_by_region(flagged: DataFrame) -> DataFrame:
    return (
        flagged.groupBy("customer_region")
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .orderBy(F.desc("txn_count"), "customer_region")
    )


def amount_histogram(flagged: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins from the smallest to the largest amount, empty ones included.

    The largest amount belongs to the last bin. When all amounts are equal the range
    is widened by half a unit to either side, as numpy does.
    """
    amounts = flagged.select(F.col("amount").cast("double").alias("x"))
    extent = amounts.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    same = F.col("lo") == F.col("hi")
    edges = extent.select(
        F.struct(
            F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    ).scalar()
    binned = amounts.select("x", edges.alias("e")).select(
        F.least(F.width_bucket("x", F.col("e.lo"), F.col("e.hi"), F.lit(bins)), F.lit(bins))
        .cast("int")
        .alias("bin")
    )
    counted = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    ranges = extent.where("lo is not null").select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
        F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        ((F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")) - F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo"))) / bins).alias("width"),
    )
    return (
        ranges.join(counted, "bin", "left")
        .withColumn("txn_count", F.coalesce("n", F.lit(0)))
        .select(
            "bin",
            (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_end"),
            "txn_count",
        )
        .orderBy("bin")
    )


def top_flagged(flagged: DataFrame, n: int = 20) -> DataFrame:
    """The n riskiest flagged transactions, amounts rounded to cents."""
    return (
        by_risk(flagged)
        .limit(n)
        .select(
            "transaction_id",
            "customer_name",
            "bank_name",
            F.round("amount", 2).alias("amount"),
            "fraud_score",
            "severity",
        )
    )
