"""Feature snapshots that cost their own rows: partial aggregates per load, merged when read.

Every load of transactions leaves one row per customer (or bank) it touches: counts, sums,
extremes. Features come from merging those rows, so the fact is never read again. Loads are
numbered. A load that is repeated, corrected or not, replaces its own rows and nothing else.
``compact`` folds the loads up to a number into one; those can then not be replaced any more.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.config import DEFAULT, RiskConfig
from riskspark.functions.scalars import count_where, round_money, safe_pct
from riskspark.plans.workspace import delete, folders, make_folder, move, new_folder

KEYS = {"customers": "customer_id", "banks": "bank_id"}
_LOAD = re.compile(r"(load|upto)=(\d+)$")
#: How two partial aggregates of a column become one.
MERGE = {
    "n_rows": F.sum, "n": F.sum, "n_amount": F.sum, "amount": F.sum, "largest": F.max, "n_high": F.sum, "amount_high": F.sum,
    "n_large": F.sum, "first_date": F.min, "last_date": F.max,
}


def partials(transactions: DataFrame, key: str, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """One row per key: what features need of these transactions, in a form that can be merged."""
    high = F.col("is_high_risk") == 1
    return transactions.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("transaction_id").alias("n"),
        F.count("amount").alias("n_amount"),
        F.sum("amount").alias("amount"),
        F.max("amount").alias("largest"),
        count_where(high).alias("n_high"),
        F.sum(F.when(high, F.col("amount"))).alias("amount_high"),
        count_where(F.col("amount") > F.lit(cfg.large_amount)).alias("n_large"),
        F.min("txn_date").alias("first_date"),
        F.max("txn_date").alias("last_date"),
    )


def _parts(spark: SparkSession, path: str, side: str) -> tuple[int, dict[int, str]]:
    """(highest compacted load, the folders that count by number): the newest compaction and the loads after it."""
    found = [(m[1], int(m[2]), f) for f in folders(spark, f"{path}/{side}") if (m := _LOAD.search(f))]
    upto = max((n for kind, n, _ in found if kind == "upto"), default=-1)
    return upto, {n: f for kind, n, f in found if (kind == "upto" and n == upto) or (kind == "load" and n > upto)}


def _put(df: DataFrame, path: str, name: str) -> None:
    """Write aside, then move: a reader meets the old folder or the new one."""
    spark, work = df.sparkSession, f"{path}/_work-{new_folder(df.sparkSession, 'x').rsplit('-', 1)[1]}"
    df.write.parquet(work)
    delete(spark, f"{path}/{name}")
    move(spark, work, f"{path}/{name}")


def add_load(transactions: DataFrame, path: str, load: int, cfg: RiskConfig = DEFAULT) -> None:
    """Store the partial aggregates of one load, in place of those of an earlier try."""
    spark = transactions.sparkSession
    for side, key in KEYS.items():
        make_folder(spark, f"{path}/{side}")
        if load <= _parts(spark, path, side)[0]:
            raise ValueError(f"load {load} has been compacted")
        _put(partials(transactions, key, cfg), f"{path}/{side}", f"load={load}")


def merged(spark: SparkSession, path: str, side: str) -> DataFrame:
    """One row per key over all loads. Reads as many rows as loads touched keys, none of the transactions."""
    parts = _parts(spark, path, side)[1]
    if not parts:
        raise ValueError(f"no loads below {path}")
    rows = spark.read.parquet(*parts.values())
    return rows.groupBy(KEYS[side]).agg(*[how(c).cast(rows.schema[c].dataType).alias(c) for c, how in MERGE.items()])


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Fold the loads up to a number into one; a reader sees either the loads or what they became."""
    for side, key in KEYS.items():
        before, parts = _parts(spark, path, side)
        taken = {n: f for n, f in parts.items() if n <= upto}
        if upto <= before or not taken:
            continue
        rows = spark.read.parquet(*taken.values())
        whole = rows.groupBy(key).agg(*[how(c).cast(rows.schema[c].dataType).alias(c) for c, how in MERGE.items()])
        _put(whole, f"{path}/{side}", f"upto={upto}")
        for folder in taken.values():
            delete(spark, folder)


def _or_zero(name: str, alias: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(alias)


def _average() -> Column:
    return round_money(F.try_divide("amount", "n_amount"))


def _counted(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def customer_features(path: str, customers: DataFrame, sanctions: DataFrame) -> DataFrame:
    """The customer features over all loads."""
    totals = merged(customers.sparkSession, path, "customers")
    return (
        customers.join(totals, "customer_id", "left")
        .join(_counted(sanctions, "customer_id", "sanction_count"), "customer_id", "left")
        .select(
            "customer_id", "name", "region", F.col("risk_level").alias("stated_risk_level"), _or_zero("n", "txn_frequency"),
            _average().alias("avg_txn_amount"), F.coalesce(round_money(F.col("amount")), F.lit(0)).alias("total_txn_amount"),
            round_money(F.col("largest")).alias("max_txn_amount"), _or_zero("n_high", "high_risk_txn_count"),
            _or_zero("n_large", "large_txn_count"), _or_zero("sanction_count", "sanction_count"),
            F.col("first_date").alias("first_txn_date"), F.col("last_date").alias("last_txn_date"),
        )
    )


def bank_features(path: str, banks: DataFrame, sanctions: DataFrame) -> DataFrame:
    """The bank features over all loads."""
    listed = sanctions.groupBy("bank_id").agg(
        F.count(F.lit(1)).alias("sanctioned_account_count"), F.count_distinct("customer_id").alias("distinct_sanctioned_customers")
    )
    return (
        banks.join(merged(banks.sparkSession, path, "banks"), "bank_id", "left")
        .join(listed, "bank_id", "left")
        .select(
            "bank_id", "name", "region", "compliance_score", _or_zero("n", "txn_frequency"), _average().alias("avg_txn_amount"),
            F.coalesce(round_money(F.col("amount")), F.lit(0)).alias("total_txn_amount"), _or_zero("n_high", "high_risk_txn_count"),
            _or_zero("sanctioned_account_count", "sanctioned_account_count"), _or_zero("distinct_sanctioned_customers", "distinct_sanctioned_customers"),
        )
    )


def region_features(path: str, customers: DataFrame) -> DataFrame:
    """The region features over all loads, by the customer's region."""
    totals = merged(customers.sparkSession, path, "customers")
    by_region = customers.select("customer_id", "region").join(totals, "customer_id").groupBy("region")
    return by_region.agg(*[F.sum(c).alias(c) for c in ("n", "amount", "n_high")]).select(
        "region", F.col("n").alias("txn_count"), round_money(F.try_divide("amount", "n")).alias("avg_txn_amount"),
        F.col("n_high").alias("high_risk_txn_count"), safe_pct(F.col("n_high"), F.col("n")).alias("high_risk_txn_pct"),
    )
