"""Regression values of the small binding (about one transaction per customer)."""

import pytest
from pyspark.sql import functions as F

from bindings import tpch
from riskspark.config import DEFAULT
from riskspark.operators import banks, compliance, features, profiles, rules
from riskspark.operators.order_stats import iqr_outliers

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def small(spark):
    """First lines of every fourth order, with the default thresholds."""
    t = tpch.clean_tables(spark, SF)
    active = {"customers": t.customers.where(F.col("customer_id") < tpch.IDLE), "banks": t.banks.where(F.col("bank_id") < tpch.IDLE)}
    t = t._replace(**active)
    order, line = F.floor(F.col("transaction_id") / 10), F.col("transaction_id") % 10
    return t._replace(transactions=t.transactions.where((line == 1) & (order % 4 == 0)))


def counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_row_counts(small):
    assert [df.count() for df in small] == [1500, 100, 1604, 38]


def test_scores(small):
    flags = features.transaction_flags(
        small.transactions,
        features.customer_features(*_cts(small)),
        features.bank_features(small.banks, small.transactions, small.sanctions),
    )
    scored = rules.score_transactions(flags)
    assert counts(scored, "fraud_score") == {0: 425, 1: 686, 2: 385, 3: 96, 4: 11, 5: 1}
    flagged = rules.flagged_transactions(scored, small.customers, small.banks)
    assert counts(flagged, "severity") == {"Medium": 385, "High": 96, "Critical": 12}


def _cts(t):
    return t.customers, t.transactions, t.sanctions


def test_customers(small):
    f = features.customer_features(*_cts(small))
    assert f.where("txn_frequency = 0").count() == 521 and f.where("txn_frequency >= 4").count() == 34
    p = profiles.customer_risk_profiles(f)
    assert counts(p, "computed_segment") == {"Low": 1286, "Medium": 210, "High": 4}


def test_banks(small):
    p = compliance.bank_compliance_profiles(small.banks, small.sanctions)
    assert counts(p, "compliance_status") == {"Below Threshold": 21, "Watch": 30, "Adequate": 49}
    c = banks.bank_risk_comparison(features.bank_features(small.banks, small.transactions, small.sanctions))
    assert c.where(F.col("bank_risk_score") >= DEFAULT.high_risk_bank_min).count() == 1


def test_outliers_of_the_event_values(spark):
    events = tpch.table(spark, SF, "events")
    assert iqr_outliers(events, "value", "linear").count() == 463
    assert iqr_outliers(events, "value", "ntile").count() == 462


def test_defects_of_the_raw_tables_reach_every_report(spark):
    raw = tpch.raw_transactions(spark, SF)
    again = tpch.table(spark, SF, "lineitem").where("l_quantity = 5").count()
    assert again > 0 and raw.count() == 60000 + again and raw.select("transaction_id").distinct().count() > 40000


def test_dispositions_join_transactions_and_orders_once(spark):
    txns = tpch.transactions(spark, SF).select("transaction_id").localCheckpoint()
    plan = tpch.dispositions(spark, SF, txns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
