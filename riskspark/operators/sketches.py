"""Approximate quartiles and distinct counts from stored sketches, an opt-in beside the exact ones.

Every load of transactions leaves one row per bank and month: row and value counts, a KLL
sketch of the amounts and an HLL sketch of the customers. Sketches merge, so any set of banks
and months is answered from those small rows and the fact is not read again; a repeated
load replaces its own rows. A rank from the KLL sketch is off by at most ``RANK_ERROR`` of the
values in 99 of 100 cases, a distinct count by ``DISTINCT_ERROR`` (one standard error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the KLL sketches, and the rank error that goes with it.
K, RANK_ERROR = 800, 0.0043
#: Log2 of the registers of the HLL sketches, and the relative error that goes with it.
LG_K, DISTINCT_ERROR = 12, 0.0163
QUARTILES = (0.25, 0.5, 0.75)


def partials(transactions: DataFrame) -> DataFrame:
    """One row per bank and month; rows without a date have a month of their own, NULL."""
    amount = F.col("amount").cast("double")
    return transactions.groupBy("bank_id", F.date_format("txn_date", "yyyy-MM").alias("txn_month")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("amount").alias("n_amount"),
        F.kll_sketch_agg_double(amount, F.lit(K)).alias("amounts"),
        F.hll_sketch_agg("customer_id", F.lit(LG_K)).alias("customers"),
    )


def add_load(transactions: DataFrame, path: str, load: int) -> None:
    """Store a load's sketches; a load that comes again replaces its own."""
    partials(transactions).write.mode("overwrite").parquet(f"{path}/load={load}")


def merged(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """The sketches of all loads, merged per ``by`` (bank_id, txn_month, both or none)."""
    return spark.read.parquet(path).groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_amount").alias("n_amount"),
        F.kll_merge_agg_double("amounts", F.lit(K)).alias("amounts"),
        F.hll_union_agg("customers").alias("customers"),
    )


def quantile(p: float) -> Column:
    """The p-quantile of the merged amounts, NULL without any."""
    return F.when(F.col("n_amount") > 0, F.kll_sketch_get_quantile_double("amounts", F.lit(p)))


def approx_features(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """Row count (exact), quartiles and distinct customers (approximate) per ``by``."""
    q1, q2, q3 = (quantile(p) for p in QUARTILES)
    return merged(spark, path, by).select(
        *by,
        "n_rows",
        q1.alias("q1_amount"),
        q2.alias("median_amount"),
        q3.alias("q3_amount"),
        F.hll_sketch_estimate("customers").alias("distinct_customers"),
    )


def approx_outliers(df: DataFrame, path: str, k: float = 1.5) -> DataFrame:
    """Rows whose amount lies outside the fences of the stored sketches' quartiles."""
    row = approx_features(df.sparkSession, path, []).first()
    if row is None or row["q1_amount"] is None:
        return df.where(F.lit(False))
    width = k * (row["q3_amount"] - row["q1_amount"])
    amount = F.col("amount").cast("double")
    return df.where((amount < row["q1_amount"] - width) | (amount > row["q3_amount"] + width))
