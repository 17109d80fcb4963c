"""Customer, bank and region features, and per-transaction risk flags.

Transactions are always aggregated before they meet a dimension table: the
aggregate is computed partly before the shuffle, so a customer or bank that owns
a large share of all rows costs one row per map task, and the join that follows
is one row per key on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.config import DEFAULT, RiskConfig
from riskspark.functions.scalars import count_where, flag, round_half_up, round_money, safe_pct


def _high_risk() -> Column:
    return F.col("is_high_risk") == 1


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _row_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def customer_features(
    customers: DataFrame, transactions: DataFrame, sanctions: DataFrame, cfg: RiskConfig = DEFAULT
) -> DataFrame:
    """One row per customer, with or without transactions.

    Without transactions the counts and the total are 0, the average, the maximum
    and the dates NULL.
    """
    totals = transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("txn_frequency"),
        round_money(F.avg("amount")).alias("avg_txn_amount"),
        round_money(F.sum("amount")).alias("total_txn_amount"),
        round_money(F.max("amount")).alias("max_txn_amount"),
        count_where(_high_risk()).alias("high_risk_txn_count"),
        count_where(F.col("amount") > F.lit(cfg.large_amount)).alias("large_txn_count"),
        F.min("txn_date").alias("first_txn_date"),
        F.max("txn_date").alias("last_txn_date"),
    )
    return (
        customers.join(totals, "customer_id", "left")
        .join(_row_counts(sanctions, "customer_id", "sanction_count"), "customer_id", "left")
        .select(
            "customer_id",
            "name",
            "region",
            F.col("risk_level").alias("stated_risk_level"),
            _or_zero("txn_frequency"),
            "avg_txn_amount",
            _or_zero("total_txn_amount"),
            "max_txn_amount",
            _or_zero("high_risk_txn_count"),
            _or_zero("large_txn_count"),
            _or_zero("sanction_count"),
            "first_txn_date",
            "last_txn_date",
        )
    )


def bank_features(
    banks: DataFrame, transactions: DataFrame, sanctions: DataFrame
) -> DataFrame:
    """One row per bank, with or without transactions."""
    totals = transactions.groupBy("bank_id").agg(
        F.count("transaction_id").alias("txn_frequency"),
        round_money(F.avg("amount")).alias("avg_txn_amount"),
        round_money(F.sum("amount")).alias("total_txn_amount"),
        count_where(_high_risk()).alias("high_risk_txn_count"),
    )
    listed = sanctions.groupBy("bank_id").agg(
        F.count(F.lit(1)).alias("sanctioned_account_count"),
        F.count_distinct("customer_id").alias("distinct_sanctioned_customers"),
    )
    return (
        banks.join(totals, "bank_id", "left")
        .join(listed, "bank_id", "left")
        .select(
            "bank_id",
            "name",
            "region",
            "compliance_score",
            _or_zero("txn_frequency"),
            "avg_txn_amount",
            _or_zero("total_txn_amount"),
            _or_zero("high_risk_txn_count"),
            _or_zero("sanctioned_account_count"),
            _or_zero("distinct_sanctioned_customers"),
        )
    )


def region_totals(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Sums and counts per customer region; regions without transactions vanish.

    Two steps: per customer before the join, so that not the transactions but one
    row per customer is joined, then per region.
    """
    per_customer = transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("n"),
        F.sum("amount").alias("amount"),
        count_where(_high_risk()).alias("n_high"),
        F.sum(F.when(_high_risk(), F.col("amount"))).alias("amount_high"),
    )
    return (
        customers.select("customer_id", "region")
        .join(per_customer, "customer_id")
        .groupBy("region")
        .agg(*[F.sum(c).alias(c) for c in ("n", "amount", "n_high", "amount_high")])
    )


def region_features(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    return region_features_of(region_totals(customers, transactions))


def region_features_of(totals: DataFrame) -> DataFrame:
    """The region features from ``region_totals``, where those are stored already."""
    return totals.select(
        "region",
        F.col("n").alias("txn_count"),
        round_money(F.try_divide("amount", "n")).alias("avg_txn_amount"),
        F.col("n_high").alias("high_risk_txn_count"),
        safe_pct(F.col("n_high"), F.col("n")).alias("high_risk_txn_pct"),
    )


def region_risk_view(
    customers: DataFrame, transactions: DataFrame, cfg: RiskConfig = DEFAULT
) -> DataFrame:
    """Per region: average amount of high-risk against all transactions, and whether
    the region counts as high-risk (``cfg.high_risk_region_pct``, a threshold of ours)."""
    return region_risk_of(region_totals(customers, transactions), cfg)


def region_risk_of(totals: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The regional risk view from ``region_totals``, where those are stored already."""
    pct = safe_pct(F.col("n_high"), F.col("n"))
    return totals.select(
        "region",
        round_money(F.try_divide("amount", "n")).alias("avg_txn_amount"),
        round_money(F.try_divide("amount_high", "n_high")).alias("avg_high_risk_amount"),
        pct.alias("high_risk_txn_pct"),
        flag(pct >= cfg.high_risk_region_pct).alias("is_high_risk_region"),
    )


def high_risk_region_count(region_risk: DataFrame) -> DataFrame:
    return region_risk.agg(
        count_where(F.col("is_high_risk_region") == 1).alias("high_risk_region_count")
    )


def customer_signals(
    customers: DataFrame, transactions: DataFrame, sanctions: DataFrame
) -> DataFrame:
    """The part of the customer features that transaction flags depend on."""
    return (
        customers.select("customer_id", F.col("risk_level").alias("stated_risk_level"))
        .join(_row_counts(transactions, "customer_id", "txn_frequency"), "customer_id", "left")
        .join(_row_counts(sanctions, "customer_id", "sanction_count"), "customer_id", "left")
        .select("customer_id", "stated_risk_level", _or_zero("txn_frequency"), _or_zero("sanction_count"))
    )


def bank_signals(banks: DataFrame, sanctions: DataFrame) -> DataFrame:
    """The part of the bank features that transaction flags depend on."""
    return (
        banks.select("bank_id", "compliance_score")
        .join(_row_counts(sanctions, "bank_id", "sanctioned_account_count"), "bank_id", "left")
        .select("bank_id", "compliance_score", _or_zero("sanctioned_account_count"))
    )


def transaction_flags(
    transactions: DataFrame,
    customer_features: DataFrame,
    bank_features: DataFrame,
    cfg: RiskConfig = DEFAULT,
    how: str = "inner",
) -> DataFrame:
    """Six risk indicators per transaction.

    Either the full feature marts or the slim signal frames can be passed; the
    joined columns are reduced to flags of a few bytes before the join, because
    this join is the one place where the whole fact may be shuffled. With ``how="left"``
    transactions of unknown customers or banks stay, their indicators NULL.
    """
    customer_flags = customer_features.select(
        "customer_id",
        flag(F.col("txn_frequency") >= cfg.high_frequency_min).alias("flag_high_frequency_customer"),
        flag(F.col("stated_risk_level") == "High").alias("flag_high_risk_customer"),
        flag(F.col("sanction_count") > 0).alias("flag_sanctioned_customer"),
    )
    bank_flags = bank_features.select(
        "bank_id",
        flag(F.col("compliance_score") < cfg.low_compliance).alias("flag_low_compliance_bank"),
        flag(F.col("sanctioned_account_count") > 0).alias("flag_sanctioned_bank"),
    )
    return (
        transactions.join(customer_flags, "customer_id", how)
        .join(bank_flags, "bank_id", how)
        .select(
            "transaction_id",
            "customer_id",
            "bank_id",
            "amount",
            "txn_date",
            "location",
            "is_high_risk",
            flag(F.col("amount") > F.lit(cfg.large_amount)).alias("flag_large_amount"),
            "flag_high_frequency_customer",
            "flag_high_risk_customer",
            "flag_low_compliance_bank",
            "flag_sanctioned_customer",
            "flag_sanctioned_bank",
        )
    )
