"""Bank risk comparison and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.config import DEFAULT, RiskConfig
from riskspark.functions.scalars import count_where, round_half_up, safe_pct


def bank_risk_comparison(features: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """High-risk share and composite risk score (0-100, one decimal) per bank.

    A bank without transactions has no share (NULL) and gets no points for it.
    """
    cap = F.lit(float(cfg.bank_component_cap))
    share = F.try_divide(
        F.lit(100.0) * F.col("high_risk_txn_count"), F.col("txn_frequency").cast("double")
    )
    sanctions = F.coalesce("sanctioned_account_count", F.lit(0)) * cfg.bank_sanction_points
    score = (
        (F.lit(1.0) - F.col("compliance_score")) * cfg.bank_compliance_weight
        + F.least(cap, sanctions.cast("double"))
        + F.least(cap, F.coalesce(share, F.lit(0.0)) * cfg.bank_high_risk_weight)
    )
    return features.select(
        "bank_id",
        "name",
        "region",
        "compliance_score",
        "txn_frequency",
        "avg_txn_amount",
        "total_txn_amount",
        "high_risk_txn_count",
        safe_pct(F.col("high_risk_txn_count"), F.col("txn_frequency")).alias("high_risk_txn_pct"),
        "sanctioned_account_count",
        round_half_up(score, 1).alias("bank_risk_score"),
    )


def rank_banks(comparison: DataFrame) -> DataFrame:
    """Rank by the rounded score, highest first; ties share a rank and leave a gap.

    The rank of a score is one more than the number of banks above it. It is found
    on the distinct scores, of which there are about a thousand at most whatever
    the number of banks (one decimal between 0 and 100). Spark broadcasts them by its
    own size threshold. A bank without a score ranks last.
    """
    above = Window.orderBy(F.desc_nulls_last("bank_risk_score")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = (
        comparison.groupBy("bank_risk_score")
        .agg(F.count(F.lit(1)).alias("banks"))
        .select(
            F.col("bank_risk_score").alias("score"),
            (F.coalesce(F.sum("banks").over(above), F.lit(0)) + 1).alias("risk_rank"),
        )
    )
    same_score = comparison["bank_risk_score"].eqNullSafe(ranks["score"])
    return comparison.join(ranks, same_score).drop("score")


def bank_kpis(comparison: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Number of high-risk banks, average score and the riskiest bank (lowest id on a tie)."""
    order = F.struct("bank_risk_score", -F.col("bank_id"))
    return comparison.agg(
        count_where(F.col("bank_risk_score") >= cfg.high_risk_bank_min).alias("high_risk_bank_count"),
        round_half_up(F.avg("bank_risk_score"), 2).alias("avg_bank_risk_score"),
        F.max_by("bank_id", order).alias("riskiest_bank_id"),
    )


def top_banks(ranked: DataFrame, n: int = 10) -> DataFrame:
    return (
        ranked.orderBy("risk_rank", "bank_id")
        .limit(n)
        .select(
            "bank_id",
            "name",
            "region",
            "compliance_score",
            "sanctioned_account_count",
            "high_risk_txn_pct",
            "bank_risk_score",
            "risk_rank",
        )
    )


def compliance_risk_points(ranked: DataFrame) -> DataFrame:
    """Compliance against risk score, sized by sanctions: one point per bank."""
    return ranked.select(
        "bank_id", "name", "compliance_score", "bank_risk_score", "sanctioned_account_count"
    )
