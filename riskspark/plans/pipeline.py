"""The whole batch run: source folder in, marts, reports, exports and alerts out.

Every mart that another step reads is written first and read back. Each is thus
computed once, later joins are planned with its real size (small ones broadcast by
Spark's own threshold, large ones shuffled), and a lost executor costs no more than
the step it was in. ``out_dir`` must be a folder that all executors share.

Marts are written below a version of their own in ``out_dir/marts`` and published together
when the last is there (``sources/versions.py``): until then readers see the run before.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schemas
from riskspark.config import DEFAULT, RiskConfig
from riskspark.operators import banks, checks, cleaning, compliance, features, kpis
from riskspark.operators import profiles, quality, reports, rules, views
from riskspark.operators.order_stats import iqr_outliers
from riskspark.plans.workspace import shuffles_dropped
from riskspark.sources.readers import line_breaks, read_sources, read_unreadable
from riskspark.sources.sinks import append_alerts, export_mart, with_month, write_mart, write_views
from riskspark.sources.versions import new_version, publish

# Marts offered to other tools as CSV.
EXPORTED = [
    "data_quality_kpis",
    "customer_features",
    "bank_features",
    "region_features",
    "transaction_flags",
    "flagged_transactions",
    "customer_risk_profiles",
    "bank_compliance_profiles",
    "compliance_region_rollup",
    "bank_risk_comparison_ranked",
    "kpi_summary",
    "disposition_template",
]


def run(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    fmt: str = "csv",
    cfg: RiskConfig = DEFAULT,
    run_ts: datetime | None = None,
    export: bool = True,
    compression: str | None = None,
) -> dict[str, DataFrame]:
    """Run every step and return the marts by name.

    Exports and views are text and take several times the disk of the marts; with
    ``compression`` (such as ``gzip``) the same text is written compressed. Shuffle files go
    at the end of each step, as the next one starts from stored marts.
    """
    with shuffles_dropped(spark):
        return _run(spark, source_dir, out_dir, fmt, cfg, run_ts, export, compression)


def _run(spark, source_dir, out_dir, fmt, cfg, run_ts, export, compression) -> dict[str, DataFrame]:
    run_ts = (run_ts or datetime.now(timezone.utc)).replace(microsecond=0)
    marts: dict[str, DataFrame] = {}
    version = new_version(f"{out_dir}/marts")

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{version}/{name}"
        if name == "transactions":
            stored = write_mart(with_month(df), path, partition_by=["txn_month"])
            marts[name] = stored.drop("txn_month")
        else:
            marts[name] = write_mart(df, path)
        return marts[name]

    breaks = line_breaks(spark, source_dir) if fmt == "csv" else None
    staged = cleaning.coerce_sources(read_sources(spark, source_dir, fmt, breaks))
    clean, quarantine = cleaning.clean(staged, keep=keep)
    if fmt == "csv":
        quarantine = quarantine.unionByName(read_unreadable(spark, source_dir, breaks))
    keep(quarantine, "quarantine")
    _quality(staged, clean, marts, keep)
    _features(clean, keep, cfg)
    _scores(clean, marts, keep, cfg)
    _rankings(clean, marts, keep, cfg)
    _summary(marts, keep, cfg, run_ts)
    publish(spark, f"{out_dir}/marts", version)

    append_alerts(marts["alerts"], f"{out_dir}/alerts_log", run_ts.strftime("%Y%m%dT%H%M%SZ"))
    if export:
        export_marts(marts, out_dir, compression)
    return marts


def export_marts(marts: dict[str, DataFrame], out_dir: str, compression: str | None = None) -> None:
    """Exports and views of a run's marts, which are stored: the source is not needed any more."""
    with shuffles_dropped(marts["kpi_summary"].sparkSession):
        for name in EXPORTED:
            export_mart(marts[name], f"{out_dir}/export/{name}", compression=compression)
        export_mart(marts["kpi_summary"], f"{out_dir}/export/kpi_summary_json", fmt="json", compression=compression)
        write_views(_views(marts), f"{out_dir}/views", compression)


def _quality(staged, clean, marts, keep) -> None:
    # the checked children hold all staged rows, typed: the source is not parsed again
    typed = staged | {t: marts[f"checked_{t}"] for t in ("transactions", "sanctions")}
    keep(quality.null_report(typed), "null_report")
    duplicates = [
        quality.duplicate_keys(typed[t], key).select(
            F.lit(t).alias("table_name"), F.col(key).alias("key"), "copies"
        )
        for t, key in schemas.PRIMARY_KEYS.items()
    ]
    keep(reduce(DataFrame.unionByName, duplicates), "duplicate_keys")
    keep(quality.duplicate_rows(typed["transactions"]), "duplicate_rows")
    for key, parent in (("bank_id", clean.banks), ("customer_id", clean.customers)):
        rows = typed["transactions"].select("transaction_id", key)
        keep(checks.orphans(rows, parent, key), f"orphans_{key}")
    amounts = clean.transactions.select("transaction_id", "amount")
    keep(iqr_outliers(amounts, "amount", "ntile"), "amount_outliers")
    keep(quality.dq_sql_kpis(clean.transactions), "transaction_quality_kpis")
    valid = cleaning.good_rows(marts["checked_transactions"])
    keep(quality.dq_kpis(valid, clean), "data_quality_kpis")


def _features(clean, keep, cfg) -> None:
    customers = keep(
        features.customer_features(clean.customers, clean.transactions, clean.sanctions, cfg),
        "customer_features",
    )
    keep(
        features.bank_features(clean.banks, clean.transactions, clean.sanctions), "bank_features"
    )
    totals = keep(features.region_totals(clean.customers, clean.transactions), "region_totals")
    keep(features.region_features_of(totals), "region_features")
    region_risk = keep(features.region_risk_of(totals, cfg), "region_risk")
    keep(features.high_risk_region_count(region_risk), "high_risk_region_count")
    keep(quality.feature_coverage(customers), "feature_coverage")


def _scores(clean, marts, keep, cfg) -> None:
    flags = keep(
        features.transaction_flags(
            clean.transactions, marts["customer_features"], marts["bank_features"], cfg
        ),
        "transaction_flags",
    )
    scored = rules.score_transactions(flags, cfg)  # arithmetic on the stored flags
    flagged = keep(
        rules.flagged_transactions(scored, clean.customers, clean.banks, cfg),
        "flagged_transactions",
    )
    keep(rules.fraud_kpis(scored, cfg), "fraud_kpis")
    keep(rules.disposition_template(flagged), "disposition_template")
    keep(reports.severity_distribution(flagged), "severity_distribution")
    keep(reports.score_distribution(flagged), "score_distribution")
    keep(reports.flagged_by_region(flagged), "flagged_by_region")
    keep(reports.amount_histogram(flagged), "amount_histogram")
    keep(reports.top_flagged(flagged), "top_flagged")


def _rankings(clean, marts, keep, cfg) -> None:
    customer_profiles = keep(
        profiles.customer_risk_profiles(marts["customer_features"], cfg), "customer_risk_profiles"
    )
    keep(profiles.profiling_kpis(customer_profiles), "profiling_kpis")
    keep(views.segment_crosstab(customer_profiles), "segment_crosstab")

    bank_profiles = keep(
        compliance.bank_compliance_profiles(clean.banks, clean.sanctions, cfg),
        "bank_compliance_profiles",
    )
    keep(compliance.compliance_kpis(bank_profiles), "compliance_kpis")
    keep(compliance.compliance_region_rollup(bank_profiles), "compliance_region_rollup")
    keep(compliance.sanction_reason_totals(bank_profiles), "sanction_reason_totals")

    compared = keep(banks.bank_risk_comparison(marts["bank_features"], cfg), "bank_risk_comparison")
    ranked = keep(banks.rank_banks(compared), "bank_risk_comparison_ranked")
    keep(banks.bank_kpis(compared, cfg), "bank_kpis")
    keep(banks.top_banks(ranked), "top_banks")


def _summary(marts, keep, cfg, run_ts) -> None:
    summary = keep(
        kpis.kpi_summary(
            marts["data_quality_kpis"],
            marts["fraud_kpis"],
            marts["profiling_kpis"],
            marts["compliance_kpis"],
            marts["bank_kpis"],
            run_ts,
        ),
        "kpi_summary",
    )
    keep(kpis.alerts(summary, marts["bank_compliance_profiles"], cfg), "alerts")


def _views(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return views.dashboard_views(
        marts["kpi_summary"],
        marts["region_features"],
        marts["compliance_region_rollup"],
        marts["flagged_transactions"],
        marts["customer_risk_profiles"],
        marts["bank_risk_comparison_ranked"],
        marts["bank_compliance_profiles"],
        marts["alerts"],
    )
