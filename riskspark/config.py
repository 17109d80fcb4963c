"""Thresholds and weights of the risk rules."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class RiskConfig:
    """Every number a rule depends on. The defaults are fixed values.

    ``high_risk_region_pct`` is the one threshold of our own: the regional view
    counts high-risk regions, and no published number says where that begins.
    """

    # transaction rules
    large_amount: Decimal = Decimal("9000")
    high_frequency_min: int = 4
    low_compliance: float = 0.6
    flag_min: int = 2
    review_min: int = 3
    critical_min: int = 4

    # customer segments
    high_risk_txn_points: int = 10
    large_txn_points: int = 12
    sanction_points: int = 25
    stated_high_points: int = 25
    stated_medium_points: int = 12
    component_cap: int = 25
    segment_high_min: int = 60
    segment_medium_min: int = 30

    # bank compliance and ranking
    watch_compliance: float = 0.75
    bank_compliance_weight: float = 40.0
    bank_sanction_points: int = 10
    bank_high_risk_weight: float = 0.3
    bank_component_cap: int = 30
    high_risk_bank_min: float = 50.0

    # alerts and views
    critical_alert_min: int = 1
    high_risk_region_pct: float = 50.0


DEFAULT = RiskConfig()
