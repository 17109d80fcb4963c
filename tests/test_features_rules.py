from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from riskspark.config import DEFAULT, RiskConfig
from riskspark.functions.scalars import merge_single_rows, round_half_up, safe_pct
from riskspark.operators import features, rules
from tests.helpers import DAY, banks, customers, empty_tables, rows, sanctions, txns


def test_rounding_ties_go_up(spark):
    df = spark.createDataFrame([(1.005,), (14.475,), (-1.005,), (2.5,)], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got == [1.01, 14.48, -1.01, 2.5]


def test_average_of_cents_rounds_up(spark):
    cf = features.customer_features(
        customers(spark, (1, "Low")), txns(spark, (1, 1, 1, "1.00"), (2, 1, 1, "1.01")), sanctions(spark)
    ).first()
    assert cf.avg_txn_amount == D("1.01") and cf.total_txn_amount == D("2.01")


def test_total_beyond_double_precision_keeps_its_cents(spark):
    big = "9999999999999999.99"
    cf = features.customer_features(
        customers(spark, (1, "Low")), txns(spark, (1, 1, 1, big), (2, 1, 1, big)), sanctions(spark)
    ).first()
    assert cf.total_txn_amount == D("19999999999999999.98")


def test_safe_pct_of_nothing(spark):
    df = spark.createDataFrame([(0, 0), (1, 3)], "a bigint, b bigint")
    assert [r[0] for r in df.select(safe_pct(F.col("a"), F.col("b"))).collect()] == [None, 33.33]


def test_merge_single_rows(spark):
    a = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows(merge_single_rows(a, spark.createDataFrame([(2.5,)], "c double"))) == [(1, None, 2.5)]


def test_customer_without_transactions(spark):
    cf = features.customer_features(customers(spark, (7, "Low")), txns(spark), sanctions(spark, (1, 1, 7))).first()
    assert (cf.txn_frequency, cf.total_txn_amount, cf.high_risk_txn_count, cf.large_txn_count) == (0, 0, 0, 0)
    assert cf.avg_txn_amount is None and cf.max_txn_amount is None and cf.first_txn_date is None
    assert cf.sanction_count == 1


def test_sanctions_do_not_multiply_transactions(spark):
    cf = features.customer_features(
        customers(spark, (1, "Low")),
        txns(spark, (1, 1, 1, 10), (2, 1, 1, 20)),
        sanctions(spark, (1, 1, 1), (2, 1, 1), (3, 2, 1)),
    ).first()
    assert (cf.txn_frequency, cf.total_txn_amount, cf.sanction_count) == (2, D("30.00"), 3)


def test_bank_features_count_distinct_customers(spark):
    bf = features.bank_features(
        banks(spark, (1, 0.5), (2, 0.5)), txns(spark, (1, 1, 1, 10, 1)), sanctions(spark, (1, 1, 5), (2, 1, 5), (3, 1, 6))
    )
    assert rows(bf, "bank_id", "txn_frequency", "high_risk_txn_count", "sanctioned_account_count", "distinct_sanctioned_customers") == [
        (1, 1, 1, 3, 2),
        (2, 0, 0, 0, 0),
    ]


def test_region_features_drop_silent_regions(spark):
    c = customers(spark, (1, "Low", "North"), (2, "Low", "North"), (3, "Low", "East"))
    rf = features.region_features(c, txns(spark, (1, 1, 1, 10, 1), (2, 2, 1, 20), (3, 2, 1, 30)))
    assert rows(rf) == [("North", 3, D("20.00"), 1, 33.33)]
    view = features.region_risk_view(c, txns(spark, (1, 1, 1, 10, 1), (2, 2, 1, 20, 0)))
    assert rows(view) == [("North", D("15.00"), D("10.00"), 50.0, 1)]
    assert features.high_risk_region_count(view).first()[0] == 1


def _scored(spark, t, c, b, s, cfg=DEFAULT):
    flags = features.transaction_flags(
        t, features.customer_features(c, t, s, cfg), features.bank_features(b, t, s), cfg
    )
    return rules.score_transactions(flags, cfg)


def test_bounds_of_the_flags(spark):
    c = customers(spark, (1, "High"), (2, "Low"))
    b = banks(spark, (1, 0.59), (2, 0.60))
    t = txns(
        spark,
        (1, 1, 1, "9000.00"), (2, 1, 2, "9000.01"), (3, 1, 2, 1), (4, 1, 2, 1),
        (5, 2, 2, 1), (6, 2, 2, 1), (7, 2, 2, 1),
    )
    got = rows(
        _scored(spark, t, c, b, sanctions(spark)),
        "transaction_id", "flag_large_amount", "flag_high_frequency_customer", "flag_high_risk_customer",
        "flag_low_compliance_bank",
    )
    assert got[:2] == [(1, 0, 1, 1, 1), (2, 1, 1, 1, 0)]
    assert got[4] == (5, 0, 0, 0, 0)


def test_scores_severities_and_flagging(spark):
    c, b = customers(spark, (1, "Low"), (2, "Low")), banks(spark, (1, 0.5), (2, 0.9))
    t = txns(spark, (1, 1, 1, 9500, 1), (2, 1, 1, 5, 1), (3, 1, 2, 5, 1), (4, 2, 2, 5, 0), (5, 2, 2, 9500, 1))
    s = sanctions(spark, (1, 99, 1))
    scored = _scored(spark, t, c, b, s)
    assert rows(scored, "transaction_id", "behavioural_score", "sanctions_flag", "fraud_score", "severity", "requires_analyst_review") == [
        (1, 3, 1, 4, "Critical", 1),
        (2, 2, 1, 3, "High", 1),
        (3, 1, 1, 2, "Medium", 0),
        (4, 0, 0, 0, "Medium", 0),
        (5, 2, 0, 2, "Medium", 0),
    ]
    flagged = rules.flagged_transactions(scored, c, b)
    assert len(flagged.columns) == 20
    assert [r.transaction_id for r in rules.by_risk(flagged).collect()] == [1, 2, 5, 3]
    assert rows(rules.fraud_kpis(scored)) == [(4, 5, 80.0, 2, 1, 1, 2)]
    template = rules.disposition_template(flagged).where("transaction_id = 1").first()
    assert (template.reviewed_by, template.review_date, template.disposition) == ("", "", "")
    decisions = spark.createDataFrame(
        [(1, "Confirmed Fraud"), (2, "Cleared"), (4, "Cleared")], "transaction_id bigint, disposition string"
    )
    assert rows(rules.disposition_kpis(flagged, decisions)) == [(4, 1, 1, 0, 2, 25.0, 25.0)]
    # several decisions on one transaction: the latest counts; a blank is none
    several = spark.createDataFrame(
        [(1, "2024-01-02", "Cleared"), (1, "2024-02-01", "Confirmed Fraud"), (1, "2024-03-01", " "), (2, "", "Cleared"), (3, "2024-01-01", "")],
        "transaction_id bigint, review_date string, disposition string",
    )
    assert rows(rules.disposition_kpis(flagged, several)) == [(4, 1, 1, 0, 2, 25.0, 25.0)]
    blank = rules.disposition_template(flagged)
    assert rows(rules.disposition_kpis(flagged, blank)) == [(4, 0, 0, 0, 4, 0.0, 0.0)]


def test_thresholds_are_configurable(spark):
    cfg = RiskConfig(large_amount=D("1"), high_frequency_min=1, flag_min=1, review_min=2, critical_min=3)
    scored = _scored(spark, txns(spark, (1, 1, 1, 2)), customers(spark, (1, "Low")), banks(spark, (1, 0.9)), sanctions(spark), cfg)
    assert rows(scored, "fraud_score", "severity", "requires_analyst_review") == [(2, "High", 1)]


def test_empty_tables(spark):
    t = empty_tables(spark)
    scored = _scored(spark, t.transactions, t.customers, t.banks, t.sanctions)
    assert rows(rules.fraud_kpis(scored)) == [(0, 0, None, 0, 0, 0, 0)]
    assert rows(features.region_features(t.customers, t.transactions)) == []


@pytest.mark.parametrize("slim", [True, False])
def test_slim_signals_give_the_same_flags(spark, slim):
    c, b = customers(spark, (1, "High")), banks(spark, (1, 0.5))
    t, s = txns(spark, *[(i, 1, 1, 10) for i in range(4)]), sanctions(spark, (1, 1, 1))
    if slim:
        sides = features.customer_signals(c, t, s), features.bank_signals(b, s)
    else:
        sides = features.customer_features(c, t, s), features.bank_features(b, t, s)
    flags = features.transaction_flags(t, *sides)
    assert rows(flags)[0] == (0, 1, 1, D("10.00"), DAY, "X", 0, 0, 1, 1, 1, 1, 1)
