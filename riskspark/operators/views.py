"""The tables behind the dashboard screens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.compliance import BELOW


def view_flagged(flagged: DataFrame) -> DataFrame:
    return flagged.select(
        "transaction_id",
        "customer_name",
        "bank_name",
        "customer_region",
        "customer_stated_risk",
        "amount",
        "txn_date",
        "fraud_score",
        "severity",
        "requires_analyst_review",
        "sanctions_flag",
    )


def view_customers(profiles: DataFrame) -> DataFrame:
    """Missing numbers shown as 0."""
    return profiles.select(
        "customer_id",
        "name",
        "region",
        "stated_risk_level",
        "computed_segment",
        "composite_risk_score",
        "txn_frequency",
        "avg_txn_amount",
        "sanction_count",
    ).fillna(0)


def view_banks(ranked: DataFrame) -> DataFrame:
    """Riskiest first, missing numbers shown as 0."""
    return (
        ranked.select(
            "bank_id",
            "name",
            "region",
            "compliance_score",
            "txn_frequency",
            "sanctioned_account_count",
            "high_risk_txn_pct",
            "bank_risk_score",
            "risk_rank",
        )
        .fillna(0)
        .orderBy("risk_rank", "bank_id")
    )


def view_bank_compliance(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        "bank_id",
        "name",
        "region",
        "compliance_score",
        "sanctioned_account_count",
        "ml_sanction_count",
        "fraud_sanction_count",
        "compliance_violation_count",
        "compliance_status",
    )


def dashboard_views(
    kpis: DataFrame,
    region: DataFrame,
    compliance_region: DataFrame,
    flagged: DataFrame,
    profiles: DataFrame,
    ranked: DataFrame,
    compliance_profiles: DataFrame,
    alerts: DataFrame,
) -> dict[str, DataFrame]:
    """The eight views by name, each still a distributed frame."""
    return {
        "kpis": kpis,
        "region": region,
        "complianceRegion": compliance_region,
        "flagged": view_flagged(flagged),
        "customers": view_customers(profiles),
        "banks": view_banks(ranked),
        "bankCompliance": view_bank_compliance(compliance_profiles),
        "alerts": alerts,
    }


# ---------------------------------------------------------------- search and filter


def _search(
    df: DataFrame,
    text: str,
    text_cols: list[str],
    equals: dict[str, str],
    sort: str | None,
    descending: bool,
    tiebreak: str,
) -> DataFrame:
    """Rows containing the text (any case) in one of the columns and matching every
    non-empty filter; sorted when asked to, ties settled by the key."""
    if text:
        needle = F.lower(F.lit(text))
        found: Column = F.lit(False)
        for c in text_cols:
            found = found | F.contains(F.lower(c), needle)
        df = df.where(found)
    for c, value in equals.items():
        if value:
            df = df.where(F.col(c) == value)
    if sort is None:
        return df
    return df.orderBy(F.desc(sort) if descending else F.asc(sort), tiebreak)


def search_flagged(
    flagged: DataFrame,
    text: str = "",
    severity: str = "",
    region: str = "",
    sort: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """Flagged transactions by customer or bank name, severity and customer region."""
    return _search(
        flagged,
        text,
        ["customer_name", "bank_name"],
        {"severity": severity, "customer_region": region},
        sort,
        descending,
        "transaction_id",
    )


def search_customers(
    profiles: DataFrame,
    text: str = "",
    segment: str = "",
    region: str = "",
    sort: str | None = None,
    descending: bool = True,
) -> DataFrame:
    equals = {"computed_segment": segment, "region": region}
    return _search(profiles, text, ["name"], equals, sort, descending, "customer_id")


def search_below_threshold_banks(
    compliance_profiles: DataFrame,
    text: str = "",
    sort: str | None = None,
    descending: bool = False,
) -> DataFrame:
    below = {"compliance_status": BELOW}
    return _search(compliance_profiles, text, ["name"], below, sort, descending, "bank_id")


def search_banks(
    ranked: DataFrame,
    text: str = "",
    region: str = "",
    sort: str | None = None,
    descending: bool = False,
) -> DataFrame:
    return _search(ranked, text, ["name"], {"region": region}, sort, descending, "bank_id")


# ------------------------------------------------------------------------ chart data


def segment_crosstab(profiles: DataFrame) -> DataFrame:
    """Customers per stated level and computed segment."""
    return profiles.groupBy("stated_risk_level", "computed_segment").agg(
        F.count(F.lit(1)).alias("customer_count")
    )


def frequency_amount_points(profiles: DataFrame) -> DataFrame:
    """Frequency against average amount, one point per customer with a transaction."""
    return profiles.where("txn_frequency >= 1").select(
        "customer_id", "name", "txn_frequency", "avg_txn_amount", "computed_segment"
    )
