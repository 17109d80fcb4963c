import json
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from riskspark import schemas
from riskspark.functions.scalars import parse_date, parse_flag, parse_whole
from riskspark.operators import checks, cleaning, quality
from tests.helpers import banks, customers, raw, raw_sources, rows, txns


def test_dates_are_read_row_by_row(spark):
    df = spark.createDataFrame(
        [("2024-01-02",), ("03/04/2024",), ("13/45/2024",), ("",), (None,), (" 2024-05-06 ",), ("abcd-ef-gh",),
         ("2024-1-2",), ("2024-01-2T",), ("03/0412024",), ("03/04/2024x",), ("2024",), ("02/30/2024",),
         ("1/5/2024",), ("2024-01-05 10:00:00",), ("2024-01-05T00:00:00",), ("2024-01-05 99:00",), ("1/5/24",), ("1//2024",)], "d string"
    )
    assert [r[0] for r in df.select(parse_date(F.col("d"))).collect()] == [
        date(2024, 1, 2), date(2024, 3, 4), None, None, None, date(2024, 5, 6), None,
        None, None, None, None, None, None,
        date(2024, 1, 5), date(2024, 1, 5), date(2024, 1, 5), None, None, None,
    ]


def test_flags_are_read_by_word(spark):
    df = spark.createDataFrame([(w,) for w in ("True", "0", "no", None, " ", "x", " YES ", "1.0", "0.0", "2.0", "0.5")], "w string")
    assert [r[0] for r in df.select(parse_flag(F.col("w"))).collect()] == [1, 0, 0, None, None, -1, 1, 1, 0, -1, -1]


def test_whole_numbers_in_the_forms_of_other_tools(spark):
    df = spark.createDataFrame([(w,) for w in (" 12 ", "123.0", "1e3", "1.5", "x", "", None, "-7.00", "99999999999999999999")], "w string")
    assert [r[0] for r in df.select(parse_whole(F.col("w"))).collect()] == [12, 123, 1000, None, None, None, None, -7, None]


def test_coercion_keeps_bad_values_as_null(spark):
    df = raw(spark, "transactions", (" 1 ", "x", "2", "1e2", " EUR ", "01/31/2024", " L ", "y", None))
    got = cleaning.coerce_types(df, schemas.STAGING["transactions"]).first()
    assert tuple(got) == (1, None, 2, D("100.00"), "EUR", date(2024, 1, 31), "L", 1, None)


def test_coercion_passes_typed_columns(spark):
    df = txns(spark, (1, 2, 3, "4.50", 1)).withColumnRenamed("txn_date", "date")
    got = cleaning.coerce_types(df, schemas.STAGING["transactions"]).first()
    assert got.amount == D("4.50") and got.is_high_risk == 1 and got.date == date(2024, 1, 2)


def C(i, name="N", level="Low", region="North"):
    return (i, name, "e", "p", region, level)


def B(i, score="0.7"):
    return (i, "B", "West", score)


def T(i, c="1", b="1", amount="5", currency="USD", day="2024-01-02", high="0"):
    return (i, c, b, amount, currency, day, "L", high, "1")


def S(i, b="1", c="1", day="2024-01-02", reason="Fraud", valid="1"):
    return (i, b, c, day, reason, valid)


def _clean(spark, **tables):
    return cleaning.clean(cleaning.coerce_sources(raw_sources(spark, **tables)))


def test_every_broken_rule_has_its_reason(spark):
    clean, quarantine = _clean(
        spark,
        customers=[C("1"), C("1"), C("2", "A"), C("2", "Z"), C(None), C("3", level="Odd"), C("4", region=None)],
        banks=[B("1"), B("2", "1.5"), B("3", "n/a")],
        transactions=[
            T("1"), T("2", c=None), T("3", b=None), T("4", amount="n/a"), T("5", amount="-1"), T("6", day="13/45/2024"),
            T("7", high="maybe"), T("8", c="9"), T("9", b="2"), T(None), T("10", high=None, currency="  "),
            T("11"), T("11"), T("11", amount="77"),
        ],
        sanctions=[S("1"), S("1"), S("2", c="3"), S("3", b="7"), S("4", reason=None), S("5", valid=None), S("6", day="x")],
    )
    assert rows(clean.customers, "customer_id", "name") == [(1, "N"), (2, "A")]
    assert rows(clean.banks, "bank_id") == [(1,)]
    assert rows(clean.transactions, "transaction_id", "currency", "is_high_risk") == [(1, "USD", 0), (10, "USD", 0), (11, "USD", 0)]
    assert rows(clean.sanctions, "sanction_id", "is_valid_bank_id") == [(1, 1), (5, 1)]
    assert rows(quarantine, "table_name", "key", "reason") == sorted([
        ("customers", None, "missing_customer_id"), ("customers", 2, "duplicate_key"),
        ("customers", 3, "bad_risk_level"), ("customers", 4, "missing_region"),
        ("banks", 2, "bad_compliance_score"), ("banks", 3, "missing_compliance_score"),
        ("transactions", 2, "missing_customer_id"), ("transactions", 3, "missing_bank_id"),
        ("transactions", 4, "missing_amount"), ("transactions", 5, "bad_amount"),
        ("transactions", 6, "missing_date"), ("transactions", 7, "bad_is_high_risk"),
        ("transactions", 8, "unknown_customer_id"), ("transactions", 9, "unknown_bank_id"),
        ("transactions", None, "missing_transaction_id"), ("transactions", 11, "duplicate_key"),
        ("sanctions", 1, "duplicate_key"), ("sanctions", 2, "unknown_customer_id"),
        ("sanctions", 3, "unknown_bank_id"), ("sanctions", 4, "missing_reason"),
        ("sanctions", 6, "missing_sanction_date"),
    ], key=lambda t: tuple((v is not None, v) for v in t))


def test_quarantine_shows_the_row(spark):
    _, quarantine = _clean(spark, transactions=[T(None, amount="12.50"), T("3", amount="-7")])
    shown = {r.reason: json.loads(r.row) for r in quarantine.collect()}
    assert shown["missing_transaction_id"]["amount"] == "12.50" and shown["missing_transaction_id"]["transaction_id"] is None
    assert shown["bad_amount"]["amount"] == "-7.00"


def test_no_row_is_lost(spark):
    """Staged rows = clean rows + quarantined rows + repeated ids."""
    raw_txns = [T(str(i % 40), c=str(i % 3), amount=str(i % 7 - 1), day="2024-01-02" if i % 5 else "x") for i in range(200)]
    staged = cleaning.coerce_sources(raw_sources(spark, customers=[C("1"), C("2")], banks=[B("1")], transactions=raw_txns))
    parents = [cleaning.clean_parent(cleaning.check_parent(staged[t], t), t) for t in ("customers", "banks")]
    checked = cleaning.check_child(staged["transactions"], "transactions", *parents)
    assert checked.count() == 200
    good, bad = cleaning.good_rows(checked), cleaning.rejected_rows(checked, "transactions")
    assert good.count() + bad.count() == 200
    assert cleaning.clean_transactions(checked).count() == good.select("transaction_id").distinct().count()


def test_strict_raises(spark):
    staged = cleaning.coerce_sources(raw_sources(spark, customers=[C("1", level="Odd")]))
    with pytest.raises(ValueError, match="bad_risk_level"):
        cleaning.clean(staged, strict=True)
    cleaning.clean(cleaning.coerce_sources(raw_sources(spark, customers=[C("1")])), strict=True)


def test_dedupe_keeps_the_first_by_all_columns(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", 2), (1, "a", None), (2, "z", 1)], "k int, x string, y int")
    assert rows(cleaning.dedupe(df, "k", ["x", "y"])) == [(1, "a", None), (2, "z", 1)]


def test_semi_and_anti_join_split_the_rows(spark):
    t = txns(spark, *[(i, i % 4, i % 3, 1) for i in range(24)])
    c, b = customers(spark, (1, "Low"), (2, "Low")), banks(spark, (0, 1))
    kept = cleaning.enforce_fk(t, c, b)
    no_c = checks.orphans(t, c, "customer_id")
    no_b = checks.orphans(t, b, "bank_id")
    assert kept.count() + no_c.unionByName(no_b).distinct().count() == 24


def test_orphans_include_missing_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, bank_id bigint")
    assert rows(checks.orphans(child, banks(spark, (1, 0.5)), "bank_id")) == [(2, None), (3, 9)]
    lost = quality.orphan_counts(child, {"bank_id": banks(spark, (1, 0.5))}, {"bank_id": "n"})
    assert rows(lost) == [(2,)]
    several = spark.createDataFrame([(1, 1), (None, 1), (7, None), (7, 9)], "customer_id bigint, bank_id bigint")
    parents = {"bank_id": banks(spark, (1, 0.5)), "customer_id": customers(spark, (1, "Low"))}
    both = quality.orphan_counts(several, parents, {"bank_id": "b", "customer_id": "c"})
    assert rows(both, "b", "c") == [(2, 3)]


def test_checks_return_violations(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, None, 1.5), (2, "z", None)], "k int, s string, x double")
    assert rows(checks.check_unique(df, "k")) == [(1, 2)]
    assert rows(checks.check_not_null(df, ["s", "x"]), "k", "reject_reason") == [(1, "missing_s"), (2, "missing_x")]
    assert rows(checks.check_domain(df, "s", ["a"]), "s") == [("z",)]
    assert rows(checks.check_range(df, "x", 0, 1), "x") == [(1.5,)]


def test_null_report_counts_blank_text_and_null_numbers(spark):
    staged = cleaning.coerce_sources(raw_sources(
        spark, customers=[("1", " ", None, "p", "r", "Low")], transactions=[T("1", amount="n/a", day=" ")]
    ))
    report = {(r[0], r[1]): r[2] for r in quality.null_report(staged).collect()}
    assert len(report) == 19
    assert {k for k, v in report.items() if v} == {
        ("customers", "name"), ("customers", "email"), ("transactions", "amount"), ("transactions", "date"),
    }


def test_duplicate_rows_group_missing_values(spark):
    staged = cleaning.coerce_sources(raw_sources(spark, transactions=[T("1", b=None), T("2", b=None), T("3")]))
    assert rows(quality.duplicate_rows(staged["transactions"]), "bank_id", "dup_count") == [(None, 2)]


def test_quality_kpis(spark):
    clean, _ = _clean(
        spark,
        customers=[C("1"), ("2", "N", None, None, "North", "Low")],
        banks=[B("1")],
        transactions=[T("1"), T("1", amount="6"), T("2")],
        sanctions=[S("1")],
    )
    staged = cleaning.coerce_sources(raw_sources(
        spark, transactions=[T("1"), T("1", amount="6"), T("2")]))
    checked = cleaning.check_child(staged["transactions"], "transactions", clean.customers, clean.banks)
    got = quality.dq_kpis(cleaning.good_rows(checked), clean).first().asDict()
    assert got == {
        "data_completeness_pct": 95.0,  # 2 of 40 cells are empty
        "data_consistency_pct": 100.0,
        "orphan_transaction_bank_fk": 0,
        "orphan_transaction_customer_fk": 0,
        "amount_outliers_iqr": 0,
        "duplicate_transactions_removed": 1,
        "total_customers": 2,
        "total_banks": 1,
        "total_transactions": 2,
        "total_sanctions": 1,
    }


def test_quality_kpis_of_nothing(spark):
    clean, quarantine = _clean(spark)
    assert quarantine.isEmpty()
    kpi = quality.dq_kpis(clean.transactions, clean).first()
    assert kpi.data_completeness_pct is None and kpi.data_consistency_pct is None
    assert kpi.amount_outliers_iqr == 0 and kpi.total_transactions == 0
    assert rows(quality.dq_sql_kpis(clean.transactions)) == [(0, None, None)]
