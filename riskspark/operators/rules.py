"""The transaction rule engine: scores, severities, flagged transactions, indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark import schemas
from riskspark.config import DEFAULT, RiskConfig
from riskspark.functions.scalars import count_where, flag, safe_pct


def score_transactions(flags: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Score every flagged-or-not transaction.

    Behavioural score 0-4: large amount, frequent customer, high-risk location,
    low-compliance bank. One more point when customer or bank has any sanction.
    """
    return (
        flags.withColumn(
            "sanctions_flag",
            flag((F.col("flag_sanctioned_customer") == 1) | (F.col("flag_sanctioned_bank") == 1)),
        )
        .withColumn(
            "behavioural_score",
            F.col("flag_large_amount")
            + F.col("flag_high_frequency_customer")
            + F.col("is_high_risk")
            + F.col("flag_low_compliance_bank"),
        )
        .withColumn("fraud_score", F.col("behavioural_score") + F.col("sanctions_flag"))
        .withColumn(
            "severity",
            F.when(F.col("fraud_score") >= cfg.critical_min, "Critical")
            .when(F.col("fraud_score") >= cfg.review_min, "High")
            .otherwise("Medium"),
        )
        .withColumn("requires_analyst_review", flag(F.col("fraud_score") >= cfg.review_min))
    )


def flagged_transactions(
    scored: DataFrame, customers: DataFrame, banks: DataFrame, cfg: RiskConfig = DEFAULT
) -> DataFrame:
    """Transactions at or above the flag threshold, with customer and bank details.

    The threshold is applied first, so names travel only with flagged rows. The
    frame is not sorted; sort when reading (``by_risk``).
    """
    who = customers.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        F.col("region").alias("customer_region"),
        F.col("risk_level").alias("customer_stated_risk"),
    )
    where = banks.select("bank_id", F.col("name").alias("bank_name"), "compliance_score")
    return (
        scored.where(F.col("fraud_score") >= cfg.flag_min)
        .join(who, "customer_id")
        .join(where, "bank_id")
        .select(
            "transaction_id",
            "customer_id",
            "customer_name",
            "customer_region",
            "customer_stated_risk",
            "bank_id",
            "bank_name",
            "compliance_score",
            "amount",
            "txn_date",
            "location",
            "flag_large_amount",
            "flag_high_frequency_customer",
            F.col("is_high_risk").alias("flag_high_risk_location"),
            "flag_low_compliance_bank",
            "sanctions_flag",
            "behavioural_score",
            "fraud_score",
            "severity",
            "requires_analyst_review",
        )
    )


def by_risk(flagged: DataFrame) -> DataFrame:
    """Most risky first: score, then amount, then the id to settle ties."""
    return flagged.orderBy(F.desc("fraud_score"), F.desc("amount"), "transaction_id")


def fraud_kpis(scored: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Flag counts over all scored transactions, in one aggregate."""
    is_flagged = F.col("fraud_score") >= cfg.flag_min

    def flagged_as(severity: str):
        return count_where(is_flagged & (F.col("severity") == severity))

    return scored.agg(
        count_where(is_flagged).alias("flagged_transaction_count"),
        F.count(F.lit(1)).alias("total_transactions"),
        safe_pct(count_where(is_flagged), F.count(F.lit(1))).alias("flagged_rate_pct"),
        count_where(is_flagged & (F.col("requires_analyst_review") == 1)).alias(
            "requires_review_count"
        ),
        flagged_as("Critical").alias("critical_count"),
        flagged_as("High").alias("high_count"),
        flagged_as("Medium").alias("medium_count"),
    )


def disposition_template(flagged: DataFrame) -> DataFrame:
    """The sheet analysts fill in: one row per flagged transaction."""
    return flagged.select(
        "transaction_id",
        "customer_id",
        "bank_id",
        "amount",
        "fraud_score",
        "severity",
        *[F.lit("").alias(c) for c in ("reviewed_by", "review_date", "disposition")],
    )


def disposition_kpis(flagged: DataFrame, dispositions: DataFrame) -> DataFrame:
    """False-positive rate and detection accuracy from the analysts' decisions.

    Of several decisions on one transaction the latest counts (``review_date``, where
    the sheet has it, without a date first; then the last in alphabetical order, so that
    the choice is fixed). A blank disposition is no decision. Flagged transactions without
    a decision stay in the denominator.
    """
    date = F.nullif(F.trim(F.col("review_date").cast("string")), F.lit("")) if "review_date" in dispositions.columns else F.lit(None).cast("string")
    made = dispositions.select("transaction_id", F.nullif(F.trim("disposition"), F.lit("")).alias("disposition"), date.alias("on"))
    latest = made.where("disposition is not null").groupBy("transaction_id").agg(F.max(F.struct("on", "disposition")).alias("last"))
    decided = flagged.select("transaction_id").join(
        latest.select("transaction_id", "last.disposition"), "transaction_id", "left"
    )
    n = F.count(F.lit(1))
    cleared = count_where(F.col("disposition") == schemas.CLEARED)
    confirmed = count_where(F.col("disposition") == schemas.CONFIRMED)
    return decided.agg(
        n.alias("flagged_transaction_count"),
        confirmed.alias("confirmed_count"),
        cleared.alias("cleared_count"),
        count_where(F.col("disposition") == schemas.ESCALATED).alias("escalated_count"),
        count_where(F.col("disposition").isNull()).alias("open_count"),
        safe_pct(cleared, n).alias("false_positive_rate_pct"),
        safe_pct(confirmed, n).alias("detection_accuracy_pct"),
    )
