"""Customer risk profiles and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.config import DEFAULT, RiskConfig
from riskspark.functions.scalars import count_where, safe_pct

COMPONENTS = ("score_high_risk_txns", "score_large_txns", "score_sanctions", "score_stated_level")


def customer_risk_profiles(features: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Four capped component scores, their sum (0-100) and the computed segment."""

    def capped(count: str, points: int) -> Column:
        # least() would turn a NULL count into the cap, so NULL counts as 0
        weighted = F.coalesce(F.col(count), F.lit(0)) * points
        return F.least(F.lit(cfg.component_cap).cast("bigint"), weighted)

    stated = (
        F.when(F.col("stated_risk_level") == "High", cfg.stated_high_points)
        .when(F.col("stated_risk_level") == "Medium", cfg.stated_medium_points)
        .otherwise(0)
    )
    composite = sum((F.col(c) for c in COMPONENTS[1:]), F.col(COMPONENTS[0]))
    return (
        features.select(
            "customer_id",
            "name",
            "region",
            "stated_risk_level",
            "txn_frequency",
            "avg_txn_amount",
            "total_txn_amount",
            "high_risk_txn_count",
            "large_txn_count",
            "sanction_count",
            capped("high_risk_txn_count", cfg.high_risk_txn_points).alias("score_high_risk_txns"),
            capped("large_txn_count", cfg.large_txn_points).alias("score_large_txns"),
            capped("sanction_count", cfg.sanction_points).alias("score_sanctions"),
            stated.alias("score_stated_level"),
        )
        .withColumn("composite_risk_score", composite)
        .withColumn(
            "computed_segment",
            F.when(F.col("composite_risk_score") >= cfg.segment_high_min, "High")
            .when(F.col("composite_risk_score") >= cfg.segment_medium_min, "Medium")
            .otherwise("Low"),
        )
    )


def profiling_kpis(profiles: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return profiles.agg(
        count_where(F.col("computed_segment") == "High").alias("high_risk_customer_count"),
        safe_pct(count_where(F.col("computed_segment") == F.col("stated_risk_level")), n).alias(
            "segmentation_agreement_pct"
        ),
        safe_pct(count_where(F.col("txn_frequency") > 0), n).alias("profile_completeness_pct"),
    )
