from datetime import datetime, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import banks as bank_ops
from riskspark.operators import compliance, kpis, profiles, views
from tests.helpers import banks, empty_tables, rows, sanctions

FEATURES = (
    "customer_id bigint, name string, region string, stated_risk_level string, txn_frequency bigint,"
    " avg_txn_amount decimal(18,2), total_txn_amount decimal(18,2), max_txn_amount decimal(18,2),"
    " high_risk_txn_count bigint, large_txn_count bigint, sanction_count bigint"
)


def _profile(spark, *cases):
    """(stated, high risk, large, sanctions) per customer"""
    data = [(i, f"C{i}", "North", c[0], 1, None, None, None, *c[1:]) for i, c in enumerate(cases)]
    return profiles.customer_risk_profiles(spark.createDataFrame(data, FEATURES))


def test_caps_and_segments(spark):
    got = rows(
        _profile(spark, ("High", 3, 3, 2), ("Low", 1, 2, 1), ("High", 1, 0, 1), ("Medium", 1, 0, 0), ("Low", 2, 1, 0), ("Low", None, None, None)),
        "customer_id", "score_high_risk_txns", "score_large_txns", "score_sanctions", "score_stated_level", "composite_risk_score", "computed_segment",
    )
    assert got == [
        (0, 25, 25, 25, 25, 100, "High"),
        (1, 10, 24, 25, 0, 59, "Medium"),
        (2, 10, 0, 25, 25, 60, "High"),
        (3, 10, 0, 0, 12, 22, "Low"),
        (4, 20, 12, 0, 0, 32, "Medium"),
        (5, 0, 0, 0, 0, 0, "Low"),
    ]


def test_profiling_kpis_and_views(spark):
    p = _profile(spark, ("High", 3, 3, 2), ("High", 0, 0, 0), ("Low", 0, 0, 0))
    assert rows(profiles.profiling_kpis(p)) == [(1, 66.67, 100.0)]
    assert rows(views.segment_crosstab(p)) == [("High", "High", 1), ("High", "Low", 1), ("Low", "Low", 1)]
    assert views.view_customers(p).first().avg_txn_amount == 0
    found = views.search_customers(p, text="c", segment="Low", sort="customer_id")
    assert [r.customer_id for r in found.collect()] == [2, 1]


def test_compliance_bounds_and_reasons(spark):
    p = compliance.bank_compliance_profiles(
        banks(spark, (1, 0.59), (2, 0.60), (3, 0.75)),
        sanctions(spark, (1, 1, 1, "Fraud"), (2, 1, 1, "Money Laundering"), (3, 1, 2, "Other"), (4, 2, 1, "Compliance Violation")),
    )
    assert rows(p, "bank_id", "sanctioned_account_count", "ml_sanction_count", "fraud_sanction_count", "compliance_violation_count", "compliance_status") == [
        (1, 3, 1, 1, 0, "Below Threshold"),
        (2, 1, 0, 0, 1, "Watch"),
        (3, 0, 0, 0, 0, "Adequate"),
    ]
    assert rows(compliance.compliance_kpis(p)) == [(4, 0.647, 33.33)]
    assert rows(compliance.sanction_reason_totals(p)) == [("Compliance Violation", 1), ("Fraud", 1), ("Money Laundering", 1)]
    assert rows(views.search_below_threshold_banks(p, text="b"), "bank_id") == [(1,)]


# Published regional results: region, banks, average score, banks below the threshold.
GOLDEN = [("West", 247, 0.737, 62), ("North", 269, 0.752, 55), ("South", 263, 0.757, 46), ("East", 231, 0.758, 36)]


def test_rollup_orders_by_average_and_golden_shares(spark):
    """Banks built to the published counts and averages give the published gap."""
    made, i = [], 0
    for region, n, avg, below in GOLDEN:
        rest = (n * avg - below * 0.55) / (n - below)
        for k in range(n):
            i += 1
            made.append((i, 0.55 if k < below else rest, region))
    p = compliance.bank_compliance_profiles(banks(spark, *made), sanctions(spark))
    rollup = compliance.compliance_region_rollup(p).collect()
    assert [(r.region, r.bank_count, r.avg_compliance_score, r.banks_below_threshold) for r in rollup] == GOLDEN
    kpi = compliance.compliance_kpis(p).first()
    assert (kpi.avg_compliance_score, kpi.compliance_gap_pct) == (0.751, 19.7)


BANK_FEATURES = (
    "bank_id bigint, name string, region string, compliance_score double, txn_frequency bigint,"
    " avg_txn_amount decimal(18,2), total_txn_amount decimal(18,2), high_risk_txn_count bigint,"
    " sanctioned_account_count bigint"
)


def _compared(spark, *cases):
    """(score, transactions, high-risk, sanctions) per bank, ids from 1"""
    data = [(i, f"B{i}", "West", float(c[0]), c[1], None, None, c[2], c[3]) for i, c in enumerate(cases, 1)]
    return bank_ops.bank_risk_comparison(spark.createDataFrame(data, BANK_FEATURES))


def test_bank_without_transactions_counts_as_high_risk(spark):
    c = _compared(spark, (0.5, 0, 0, 4))
    assert rows(c, "high_risk_txn_pct", "bank_risk_score") == [(None, 50.0)]
    assert rows(bank_ops.bank_kpis(c)) == [(1, 50.0, 1)]
    ranked = bank_ops.rank_banks(c)
    assert views.view_banks(ranked).first().high_risk_txn_pct == 0


def test_components_are_capped(spark):
    assert rows(_compared(spark, (0.0, 2, 2, 9)), "high_risk_txn_pct", "bank_risk_score") == [(100.0, 100.0)]


def test_rank_leaves_gaps_after_ties(spark):
    df = spark.createDataFrame([(1, 50.0), (2, 40.0), (3, 40.0), (4, 30.0), (5, None)], "bank_id bigint, bank_risk_score double")
    assert rows(bank_ops.rank_banks(df), "bank_id", "risk_rank") == [(1, 1), (2, 2), (3, 2), (4, 4), (5, 5)]


def test_rank_equals_the_window_function(spark):
    df = spark.range(5000).select(
        F.col("id").alias("bank_id"), (F.pmod(F.xxhash64("id"), F.lit(701)) / 10).alias("bank_risk_score")
    )
    expected = df.withColumn("risk_rank", F.rank().over(Window.orderBy(F.desc("bank_risk_score"))).cast("bigint"))
    ours = bank_ops.rank_banks(df)
    assert ours.exceptAll(expected).isEmpty() and expected.exceptAll(ours).isEmpty()


def test_riskiest_bank_ties_go_to_the_lowest_id(spark):
    c = _compared(spark, (0.9, 1, 0, 0), (0.5, 1, 0, 1), (0.5, 1, 0, 1))
    assert bank_ops.bank_kpis(c).first().riskiest_bank_id == 2
    assert [r.bank_id for r in bank_ops.top_banks(bank_ops.rank_banks(c), 2).collect()] == [2, 3]


TS = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def _kpi_row(spark, critical):
    return spark.createDataFrame([(critical, TS)], "critical_flags bigint, generated_at_utc timestamp")


@pytest.mark.parametrize("critical, scores, types", [
    (0, [0.9], []),
    (2, [0.9], ["CRITICAL_FRAUD_FLAGS"]),
    (0, [0.5], ["BANKS_BELOW_COMPLIANCE_THRESHOLD"]),
    (1, [0.5, 0.5], ["CRITICAL_FRAUD_FLAGS", "BANKS_BELOW_COMPLIANCE_THRESHOLD"]),
])
def test_alerts(spark, critical, scores, types):
    p = compliance.bank_compliance_profiles(banks(spark, *[(i, s) for i, s in enumerate(scores)]), sanctions(spark))
    got = kpis.alerts(_kpi_row(spark, critical), p).collect()
    assert [a.alert_type for a in got] == types
    texts = {
        "CRITICAL_FRAUD_FLAGS": f"{critical} transaction(s) reached Critical fraud severity.",
        "BANKS_BELOW_COMPLIANCE_THRESHOLD": f"{len(scores)} bank(s) below the 0.6 compliance-score threshold.",
    }
    assert all(a.message == texts[a.alert_type] for a in got)
    assert len({a.generated_at_utc for a in got}) <= 1


def test_empty_tables(spark):
    t = empty_tables(spark)
    p = compliance.bank_compliance_profiles(t.banks, t.sanctions)
    assert rows(compliance.compliance_kpis(p)) == [(None, None, None)]
    c = _compared(spark)
    assert rows(bank_ops.bank_kpis(c)) == [(0, None, None)]
    assert rows(bank_ops.rank_banks(c)) == []
    assert rows(profiles.profiling_kpis(_profile(spark))) == [(0, None, None)]
    assert kpis.alerts(_kpi_row(spark, 0), p).collect() == []
