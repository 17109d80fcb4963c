"""The registered queries: each operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import tpch
from riskspark import schemas
from riskspark.operators import banks as bank_ops
from riskspark.operators import checks, cleaning, compliance, features, kpis, profiles
from riskspark.functions.scalars import count_where, literal_row, merge_single_rows
from riskspark.operators import quality, ranked, reports, rules, search_index, sketches, snapshots, views
from riskspark.operators.order_stats import iqr_outliers
from riskspark.plans import pipeline
from riskspark.plans.workspace import delete, materialise, new_folder, shuffles_dropped
from riskspark.sources.readers import read_sources, read_unreadable
from riskspark.sources.sinks import export_mart
from riskspark.sources.versions import read_published
from riskspark.streaming import monitoring, scoring

CFG = tpch.CONFIG
RUN_TS = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]


def presentable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as double, dates as ISO text."""

    def shown(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            col = F.date_format(F.to_utc_timestamp(col, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
        return col.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


# ------------------------------------------------------------------- shared frames
#
# A frame that one query reads several times is written once (``materialise``). The
# joins on it are then planned with its real size: Spark broadcasts a dimension only
# when that is below its threshold, and shuffles both sides otherwise.


def _staged(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return cleaning.coerce_sources(tpch.raw_tables(spark, sf))


def _parents(staged: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Cleaned customers and banks."""

    def parent(table: str) -> DataFrame:
        return cleaning.clean_parent(cleaning.check_parent(staged[table], table), table)

    return materialise(parent("customers"), "customers"), materialise(parent("banks"), "banks")


def _checked(staged: dict[str, DataFrame], table: str) -> DataFrame:
    return cleaning.check_child(staged[table], table, *_parents(staged))


def _shared(spark: SparkSession, sf: str) -> cleaning.CleanTables:
    """The well-formed tables, with the two that are costly to derive written once."""
    t = tpch.clean_tables(spark, sf)
    return t._replace(
        transactions=materialise(t.transactions, "transactions"),
        sanctions=materialise(t.sanctions, "sanctions"),
    )


def _customer_features(t: cleaning.CleanTables) -> DataFrame:
    return features.customer_features(t.customers, t.transactions, t.sanctions, CFG)


def _bank_features(t: cleaning.CleanTables) -> DataFrame:
    return features.bank_features(t.banks, t.transactions, t.sanctions)


def _signals(t: cleaning.CleanTables) -> tuple[DataFrame, DataFrame]:
    return (
        materialise(
            features.customer_signals(t.customers, t.transactions, t.sanctions), "customer_signals"
        ),
        materialise(features.bank_signals(t.banks, t.sanctions), "bank_signals"),
    )


def _flags(t: cleaning.CleanTables) -> DataFrame:
    return features.transaction_flags(t.transactions, *_signals(t), CFG)


def _scored(t: cleaning.CleanTables) -> DataFrame:
    return rules.score_transactions(_flags(t), CFG)


def _flagged(t: cleaning.CleanTables) -> DataFrame:
    return rules.flagged_transactions(_scored(t), t.customers, t.banks, CFG)


def _flagged_only(t: cleaning.CleanTables) -> DataFrame:
    """The flagged rows where names are not needed."""
    return _scored(t).where(F.col("fraud_score") >= CFG.flag_min)


def _profiles(t: cleaning.CleanTables) -> DataFrame:
    return profiles.customer_risk_profiles(_customer_features(t), CFG)


def _compliance(t: cleaning.CleanTables) -> DataFrame:
    return compliance.bank_compliance_profiles(t.banks, t.sanctions, CFG)


def _comparison(t: cleaning.CleanTables) -> DataFrame:
    return bank_ops.bank_risk_comparison(_bank_features(t), CFG)


def _ranked(t: cleaning.CleanTables) -> DataFrame:
    return bank_ops.rank_banks(materialise(_comparison(t), "bank_risk"))


def over_clean(make: Callable[[cleaning.CleanTables], DataFrame]) -> Query:
    """A query that reads each well-formed table once."""
    return lambda spark, sf: make(tpch.clean_tables(spark, sf))


def over_shared(make: Callable[[cleaning.CleanTables], DataFrame]) -> Query:
    """A query that reads the transactions several times."""
    return lambda spark, sf: make(_shared(spark, sf))


# ----------------------------------------------------------------- quality, cleaning


def q_null_report(spark, sf):
    return quality.null_report(_staged(spark, sf))


def q_duplicate_keys(spark, sf):
    parts = []
    for table, df in _staged(spark, sf).items():
        key = schemas.PRIMARY_KEYS[table]
        found = quality.duplicate_keys(df, key)
        parts.append(found.select(F.lit(table).alias("table_name"), F.col(key).alias("key"), "copies"))
    return reduce(DataFrame.unionByName, parts)


def q_duplicate_rows(spark, sf):
    return quality.duplicate_rows(_staged(spark, sf)["transactions"])


def q_constraint_violations(spark, sf):
    staged = _staged(spark, sf)
    cust, bank, txn = staged["customers"], staged["banks"], staged["transactions"]

    def found(df: DataFrame, table: str) -> DataFrame:
        return df.groupBy(checks.REJECT).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), F.col(checks.REJECT).alias("reason"), "row_count"
        )

    parts = [
        found(checks.check_not_null(cust, schemas.REQUIRED["customers"]), "customers"),
        found(checks.check_domain(cust, "risk_level", schemas.RISK_LEVELS), "customers"),
        found(checks.check_range(bank, "compliance_score", 0.0, 1.0), "banks"),
        found(checks.check_range(txn, "amount", low=0), "transactions"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _orphans(spark, sf, parent: int, key: str) -> DataFrame:
    staged = _staged(spark, sf)
    rows = materialise(staged["transactions"].select("transaction_id", key), "transaction_keys")
    return checks.orphans(rows, _parents(staged)[parent], key)


def q_orphans_customer(spark, sf):
    return _orphans(spark, sf, 0, "customer_id")


def q_orphans_bank(spark, sf):
    return _orphans(spark, sf, 1, "bank_id")


def q_staged_transactions(spark, sf):
    raw = tpch.raw_transactions(spark, sf)
    return cleaning.coerce_types(raw, schemas.STAGING["transactions"])


def q_clean_customers(spark, sf):
    checked = cleaning.check_parent(_staged(spark, sf)["customers"], "customers")
    return cleaning.clean_parent(checked, "customers")


def q_clean_banks(spark, sf):
    checked = cleaning.check_parent(_staged(spark, sf)["banks"], "banks")
    return cleaning.clean_parent(checked, "banks")


def q_clean_transactions(spark, sf):
    return cleaning.clean_transactions(_checked(_staged(spark, sf), "transactions"))


def q_enforce_fk(spark, sf):
    staged = _staged(spark, sf)
    rows = staged["transactions"].select("transaction_id", "customer_id", "bank_id", "amount")
    return cleaning.enforce_fk(rows, *_parents(staged))


def q_clean_sanctions(spark, sf):
    checked = _checked(_staged(spark, sf), "sanctions")
    return cleaning.one_per_key(cleaning.fill_sanctions(checked), "sanctions")


def q_quarantine(spark, sf):
    return cleaning.clean(_staged(spark, sf), keep=_keep_but_transactions)[1]


def _keep_but_transactions(df: DataFrame, name: str) -> DataFrame:
    """The clean transactions are read once here, so they need not be stored."""
    return df if name == "transactions" else materialise(df, name)


def _outliers(spark, sf, method):
    events = tpch.table(spark, sf, "events").select("event_id", "value")
    return iqr_outliers(events, "value", method)


def q_iqr_outliers_ntile(spark, sf):
    return _outliers(spark, sf, "ntile")


def q_iqr_outliers_linear(spark, sf):
    return _outliers(spark, sf, "linear")


def q_dq_kpis(spark, sf):
    """Cells, extent and valid rows are counted while the tables are written."""
    observed = {"checked_transactions": Observation("valid"), "transactions": Observation("cells")}

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name == "checked_transactions":
            df = df.observe(observed[name], count_where(F.col(checks.REJECT).isNull()).alias("valid"))
        elif name == "transactions":
            df = df.observe(observed[name], *quality.transaction_aggregates(df))
        return materialise(df, name)

    tables, _ = cleaning.clean(_staged(spark, sf), keep=keep)
    return quality.dq_kpis(observed["checked_transactions"].get["valid"], tables, seen=observed["transactions"].get)


# ------------------------------------------------------------- features to reporting


def _region_risk(t: cleaning.CleanTables) -> DataFrame:
    return features.region_risk_view(t.customers, t.transactions, CFG)


def _fraud_kpis(t: cleaning.CleanTables) -> DataFrame:
    return rules.fraud_kpis(_scored(t), CFG)


def _loaded(spark, sf) -> tuple[str, cleaning.CleanTables]:
    """Five loads of the transactions: the second first with a third of its rows, then corrected; three are compacted."""
    t = _shared(spark, sf)
    path = new_folder(spark, "snapshot")
    load = F.pmod(F.xxhash64("transaction_id", F.lit(5)), F.lit(5))
    part = lambda k: t.transactions.where(load == k)
    for k, rows in ((0, part(0)), (1, part(1).where("transaction_id % 3 = 0")), (2, part(2)), (1, part(1)), (3, part(3))):
        snapshots.add_load(rows, path, k, CFG)
    snapshots.compact(spark, path, 2)
    for _ in range(2):  # the last load comes twice
        snapshots.add_load(part(4), path, 4, CFG)
    return path, t


def q_customer_features_by_load(spark, sf):
    path, t = _loaded(spark, sf)
    return snapshots.customer_features(path, t.customers, t.sanctions)


def q_bank_features_by_load(spark, sf):
    path, t = _loaded(spark, sf)
    return snapshots.bank_features(path, t.banks, t.sanctions)


def q_region_features_by_load(spark, sf):
    path, t = _loaded(spark, sf)
    return snapshots.region_features(path, t.customers)


def _ranked_flagged(spark, sf) -> str:
    """The flagged transactions, most risky first, in numbered parts."""
    path = new_folder(spark, "ranked")
    flagged = _flagged(_shared(spark, sf))
    ranked.write_ranked(flagged, path, [F.desc("fraud_score"), F.desc("amount"), F.col("transaction_id")])
    return path


def q_flagged_ranked(spark, sf):
    return ranked.numbered(spark, _ranked_flagged(spark, sf)).select("position", "transaction_id", "fraud_score", "amount")


def q_flagged_page(spark, sf):
    """The third page of fifty."""
    found = ranked.page(spark, _ranked_flagged(spark, sf), 101, 50)
    return found.select("position", "transaction_id", "customer_name", "fraud_score", "amount")


def q_sketched_banks(spark, sf):
    """Per bank, from sketches of five loads: rows, and whether quartiles and distinct customers keep to four times their error.

    A quartile's rank may lie anywhere among the amounts equal to it, so its distance is that to the nearest of them.
    """
    t = _shared(spark, sf)
    path = new_folder(spark, "sketches")
    load = F.pmod(F.xxhash64("transaction_id", F.lit(5)), F.lit(5))
    for k in (0, 1, 2, 3, 4, 1):  # one load comes twice
        sketches.add_load(t.transactions.where(load == k), path, k)
    found = materialise(sketches.approx_features(spark, path, ["bank_id"]), "sketched")
    told = t.transactions.join(found, "bank_id")
    amount = F.col("amount").cast("double")
    places = [count_where(x) for c in _SKETCHED for x in (amount < F.col(c), amount <= F.col(c))]
    names = [f"{c}_{side}" for c in _SKETCHED for side in ("below", "upto")]
    counted = told.groupBy("bank_id").agg(
        F.first("n_rows").alias("n_rows"),
        F.first("distinct_customers").alias("estimate"),
        F.count("amount").alias("n"),
        F.count_distinct("customer_id").alias("exact"),
        *[c.alias(name) for c, name in zip(places, names, strict=True)],
    )
    slack = 4 * sketches.RANK_ERROR * F.col("n") + 1
    close = F.lit(True)
    for c, p in zip(_SKETCHED, sketches.QUARTILES, strict=True):
        close = close & (F.col(f"{c}_below") <= p * F.col("n") + slack) & (F.col(f"{c}_upto") >= p * F.col("n") - slack)
    distinct = F.abs(F.col("estimate") - F.col("exact")) <= 4 * sketches.DISTINCT_ERROR * F.col("exact") + 1
    return counted.select("bank_id", "n_rows", close.alias("quartiles_close"), distinct.alias("distinct_close"))


_SKETCHED = ("q1_amount", "median_amount", "q3_amount")

#: Thresholds on the share of risky transactions, around what the regions have.
REGION_PCTS = (0.0, 33.0, 33.2, 33.4, 33.6, 33.8, 34.0, 50.0)


def _regions_by_threshold(t: cleaning.CleanTables) -> DataFrame:
    totals = materialise(features.region_totals(t.customers, t.transactions), "region_totals")
    counts = [
        features.high_risk_region_count(features.region_risk_of(totals, replace(CFG, high_risk_region_pct=p))).select(F.lit(p).alias("threshold_pct"), "*")
        for p in REGION_PCTS
    ]
    return reduce(DataFrame.unionByName, counts)


def q_disposition_kpis(spark, sf):
    t = _shared(spark, sf)
    decisions = tpch.dispositions(spark, sf, t.transactions)
    return rules.disposition_kpis(_flagged_only(t), decisions)


def _bank_kpis(t: cleaning.CleanTables) -> DataFrame:
    return bank_ops.bank_kpis(_comparison(t), CFG)


def q_dq_sql_kpis_raw(spark, sf):
    return quality.dq_sql_kpis(tpch.raw_transactions(spark, sf).withColumnRenamed("date", "txn_date"))


def q_raw_completeness(spark, sf):
    """Cells and date forms of the raw text, where both can be wrong."""
    dated = {"transactions": "date", "sanctions": "sanction_date"}
    row = merge_single_rows(
        *[df.agg(*quality.cell_aggregates(df, t, dated.get(t))) for t, df in tpch.raw_tables(spark, sf).items()]
    )
    return row.select(*quality.completeness(row))


def q_orphan_counts(spark, sf):
    staged = _staged(spark, sf)
    customers, banks = _parents(staged)
    names = {"bank_id": "orphan_bank", "customer_id": "orphan_customer"}
    return quality.orphan_counts(staged["transactions"], {"bank_id": banks, "customer_id": customers}, names)


def _written_source(spark, sf) -> str:
    """The raw tables as a folder of compressed CSV files."""
    folder = new_folder(spark, "source")
    with shuffles_dropped(spark):
        for name, df in tpch.raw_tables(spark, sf).items():
            export_mart(df, f"{folder}/{schemas.SOURCE_FILES[name]}", compression="gzip")
    return folder


def q_batch_run(spark, sf):
    """The whole run from CSV files to marts, exports, views and alerts: rows per mart."""
    out, source = new_folder(spark, "run"), _written_source(spark, sf)
    marts = pipeline.run(spark, source, out, cfg=CFG, run_ts=RUN_TS, export=False)
    delete(spark, source)  # written above for this run alone; its marts are stored
    pipeline.export_marts(marts, out, compression="gzip")
    told = [
        "customers", "banks", "transactions", "sanctions", "quarantine", "customer_features", "bank_features", "transaction_flags",
        "customer_risk_profiles", "bank_risk_comparison_ranked", "duplicate_rows", "kpi_summary",
    ]
    counts = [read_published(spark, f"{out}/marts", m).agg(F.lit(m).alias("mart"), F.count(F.lit(1)).alias("row_count")) for m in told]
    return reduce(DataFrame.unionByName, counts)


def q_unreadable_records(spark, sf):
    """Customers with a field too many or two too few among the others: the quarantine, and how many were read."""
    folder = _written_source(spark, sf)
    raw = tpch.raw_customers(spark, sf)
    line = lambda cols: F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cols])
    fields = [F.col(c) for c in raw.columns]
    kind = F.pmod(F.col("customer_id").cast("bigint"), F.lit(7))
    spoilt = F.when(kind == 0, line([*fields, F.lit("surplus")])).when(kind == 1, line(fields[:-2])).alias(",".join(raw.columns))
    writer = raw.select(spoilt).where(F.col(f"`{','.join(raw.columns)}`").isNotNull()).write.mode("append").option("header", True)
    # Lines as they are: nothing in them is a separator or a quote to this writer.
    writer = writer.option("sep", "\u0001").option("quote", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(f"{folder}/{schemas.SOURCE_FILES['customers']}")
    read = read_sources(spark, folder)["customers"].agg(F.count(F.lit(1)).cast("string").alias("row"))
    empty = F.lit(None).cast("bigint")
    told = read.select(F.lit("customers").alias("table_name"), empty.alias("key"), F.lit("read").alias("reason"), "row")
    return read_unreadable(spark, folder).unionByName(told)


def q_exported_customers(spark, sf):
    """A mart exported as text and read back; text has no empty value, so that comes back as NULL."""
    path = new_folder(spark, "export")
    found = q_clean_customers(spark, sf)
    export_mart(found, path)
    back = spark.read.schema(found.schema).option("header", True).option("escape", '"').option("multiLine", True)
    return back.csv(path)


def q_kpi_summary(spark, sf):
    """Three scans of the stored transactions: customer features, bank features, flags.

    Their cells are counted while they are written. All else comes from the features.
    """
    t = tpch.clean_tables(spark, sf)
    seen = Observation("cells")
    cells = quality.cell_aggregates(t.transactions, "transactions", "txn_date")
    t = t._replace(
        transactions=materialise(t.transactions.observe(seen, *cells), "transactions"),
        sanctions=materialise(t.sanctions, "sanctions"),
    )
    customer_side = materialise(_customer_features(t), "customer_features")
    bank_side = materialise(_bank_features(t), "bank_features")
    scored = rules.score_transactions(features.transaction_flags(t.transactions, customer_side, bank_side, CFG), CFG)
    counted = literal_row(spark, seen.get)
    quality_row = merge_single_rows(quality.small_table_cells(t), counted)
    return kpis.kpi_summary(
        quality_row.select(*quality.completeness(quality_row)),
        rules.fraud_kpis(scored, CFG),
        profiles.profiling_kpis(profiles.customer_risk_profiles(customer_side, CFG)),
        compliance.compliance_kpis(_compliance(t)),
        bank_ops.bank_kpis(bank_ops.bank_risk_comparison(bank_side, CFG), CFG),
        RUN_TS,
    )


def _alerts(t: cleaning.CleanTables) -> DataFrame:
    critical = _fraud_kpis(t).select(
        F.col("critical_count").alias("critical_flags"), F.lit(RUN_TS).alias("generated_at_utc")
    )
    return kpis.alerts(critical, _compliance(t), CFG)


def _amount_histogram(t: cleaning.CleanTables) -> DataFrame:
    amounts = materialise(_flagged_only(t).select("amount"), "flagged_amounts")
    return reports.amount_histogram(amounts)


def _search_flagged(t: cleaning.CleanTables) -> DataFrame:
    found = views.search_flagged(
        _flagged(t), text="customer#00000001", severity="High", sort="amount"
    )
    return views.view_flagged(found)


def _search_customers(t: cleaning.CleanTables) -> DataFrame:
    return views.search_customers(
        _profiles(t), text="#000", segment="Medium", region="ASIA", sort="composite_risk_score"
    )


def _search_below(t: cleaning.CleanTables) -> DataFrame:
    return views.search_below_threshold_banks(
        _compliance(t), text="SUPPLIER", sort="compliance_score"
    )


def _flagged_index(spark, sf) -> str:
    path = new_folder(spark, "flagged-index")
    order = [F.desc("fraud_score"), F.desc("amount"), F.col("transaction_id")]
    search_index.write_index(_flagged(_shared(spark, sf)), path, order, ["customer_name", "bank_name"], ["severity", "customer_region"])
    return path


def q_search_flagged_index(spark, sf):
    found = search_index.search(spark, _flagged_index(spark, sf), "customer#00000001", {"severity": "High"})
    return views.view_flagged(found)


def q_search_flagged_page(spark, sf):
    """The second page of twenty of what one region's customers, or banks, of such names have."""
    path, asked = _flagged_index(spark, sf), {"text": "R#00000000", "equals": {"customer_region": "ASIA"}}
    last = search_index.search_page(spark, path, 20, **asked).agg(F.max("position")).first()[0]
    found = search_index.search_page(spark, path, 20, last or 0, **asked)
    return found.select("position", "transaction_id", "customer_name", "bank_name", "fraud_score", "amount")


def q_search_customers_index(spark, sf):
    path = new_folder(spark, "customer-index")
    order = [F.desc("composite_risk_score"), F.col("customer_id")]
    search_index.write_index(_profiles(tpch.clean_tables(spark, sf)), path, order, ["name"], ["computed_segment", "region"])
    return search_index.search(spark, path, "#000", {"computed_segment": "Medium", "region": "ASIA"})


# ------------------------------------------------------------------------- streaming


#: Rows of a file of a feed, on average.
FEED_ROWS = 1_000_000


def _feed(spark: SparkSession, df: DataFrame, key: str, files: int = 6) -> DataFrame:
    """The rows as a file stream, as many files per micro-batch as a part is written to.

    A part has the rows of one hash of the key, so dates are in no order; a seventh part
    sends a third of the rows again. Parts are written by more tasks the more rows there are.
    """
    path = new_folder(spark, "feed")
    part = F.pmod(F.xxhash64(key), F.lit(files)).cast("int")
    again = df.where(F.pmod(F.xxhash64(key, F.lit(1)), F.lit(3)) == 0).withColumn("part", F.lit(files))
    sent = df.withColumn("part", part).unionByName(again) if key == "transaction_id" else df.withColumn("part", part)
    each = max(1, -(-sent.count() // (FEED_ROWS * (files + 1))))
    share = F.pmod(F.xxhash64(*df.columns), F.lit(each)).cast("int")
    sent.repartition((files + 1) * each, "part", share).write.partitionBy("part").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", each).option("recursiveFileLookup", True).parquet(path)


def _arriving(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame, cleaning.CleanTables]:
    """The transactions as a file stream, and the features of the same rows."""
    t = _shared(spark, sf)
    return (_feed(spark, t.transactions, "transaction_id"), *_signals(t), t)


def q_score_stream(spark, sf):
    feed, customer_side, bank_side, _ = _arriving(spark, sf)
    out = new_folder(spark, "scored")
    state = new_folder(spark, "scored-state")
    scoring.score_stream(feed, customer_side, bank_side, out, state, CFG).awaitTermination()
    return spark.read.parquet(out).drop("feed", "batch_id")


def q_alert_stream(spark, sf):
    """What was alerted in all: critical flags over the batches, the standing alert once."""
    feed, customer_side, bank_side, t = _arriving(spark, sf)
    out = new_folder(spark, "alerts")
    raiser = scoring.alert_raiser(materialise(_compliance(t), "compliance"), out, CFG, RUN_TS)
    scoring.score_stream(
        feed, customer_side, bank_side, new_folder(spark, "scored"), new_folder(spark, "alerts-state"), CFG, raiser
    ).awaitTermination()
    told = F.split("message", " ")[0].cast("bigint")
    return spark.read.parquet(out).groupBy("alert_type", "severity").agg(F.sum(told).alias("affected"))


def _payments(spark, sf) -> DataFrame:
    return tpch.payment_events(tpch.table(spark, sf, "events"))


def q_region_monitor_stream(spark, sf):
    schema = tpch.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out = new_folder(spark, "monitor")
    monitoring.region_monitor_stream(
        tpch.payment_events(events), tpch.customers(spark, sf), out, new_folder(spark, "monitor-state")
    ).awaitTermination()
    return monitoring.region_counts(spark, out)


def q_region_monitor_accounts(spark, sf):
    """Every event of a feed in no order is counted, open, late or set apart."""
    feed, out = _feed(spark, _payments(spark, sf), "customer_id"), new_folder(spark, "monitor")
    monitoring.region_monitor_stream(
        feed, tpch.customers(spark, sf), out, new_folder(spark, "monitor-state")
    ).awaitTermination()
    accounts = monitoring.monitor_accounts(spark, out)
    unmatched = F.sum(F.when(F.col("status") == "unmatched", F.col("txn_count")).otherwise(0))
    return accounts.agg(F.sum("txn_count").alias("accounted"), unmatched.alias("unmatched"))


# -------------------------------------------------------------------------- registry

QUERIES: dict[str, Query] = {
    # quality and cleaning, on the tables with defects
    "null_report": q_null_report,
    "duplicate_keys": q_duplicate_keys,
    "duplicate_rows": q_duplicate_rows,
    "constraint_violations": q_constraint_violations,
    "orphans_bank": q_orphans_bank,
    "orphans_customer": q_orphans_customer,
    "staged_transactions": q_staged_transactions,
    "enforce_fk": q_enforce_fk,
    "clean_customers": q_clean_customers,
    "clean_banks": q_clean_banks,
    "clean_transactions": q_clean_transactions,
    "clean_sanctions": q_clean_sanctions,
    "quarantine": q_quarantine,
    "iqr_outliers_ntile": q_iqr_outliers_ntile,
    "iqr_outliers_linear": q_iqr_outliers_linear,
    "dq_kpis": q_dq_kpis,
    # the well-formed tables
    "dq_sql_kpis": over_clean(lambda t: quality.dq_sql_kpis(t.transactions)),
    "dq_sql_kpis_raw": q_dq_sql_kpis_raw,
    "raw_completeness": q_raw_completeness,
    "orphan_counts": q_orphan_counts,
    # sources and sinks
    "batch_run": q_batch_run,
    "exported_customers": q_exported_customers,
    "unreadable_records": q_unreadable_records,
    "feature_coverage": over_clean(lambda t: quality.feature_coverage(_customer_features(t))),
    "customer_features_by_load": q_customer_features_by_load,
    "bank_features_by_load": q_bank_features_by_load,
    "region_features_by_load": q_region_features_by_load,
    "customer_features": over_clean(_customer_features),
    "bank_features": over_clean(_bank_features),
    "region_features": over_clean(lambda t: features.region_features(t.customers, t.transactions)),
    "transaction_flags": over_shared(_flags),
    "scored_transactions": over_shared(_scored),
    "flagged_transactions": over_shared(_flagged),
    "fraud_kpis": over_shared(_fraud_kpis),
    "disposition_template": over_shared(lambda t: rules.disposition_template(_flagged_only(t))),
    "disposition_kpis": q_disposition_kpis,
    "customer_risk_profiles": over_clean(_profiles),
    "profiling_kpis": over_clean(lambda t: profiles.profiling_kpis(_profiles(t))),
    "bank_compliance_profiles": over_clean(_compliance),
    "compliance_kpis": over_clean(lambda t: compliance.compliance_kpis(_compliance(t))),
    "compliance_region_rollup": over_clean(
        lambda t: compliance.compliance_region_rollup(_compliance(t))
    ),
    "bank_risk_comparison_ranked": over_clean(_ranked),
    "bank_kpis": over_clean(_bank_kpis),
    "top_banks": over_clean(lambda t: bank_ops.top_banks(_ranked(t))),
    "kpi_summary": q_kpi_summary,
    "alerts": over_shared(_alerts),
    # report tables
    "severity_distribution": over_shared(lambda t: reports.severity_distribution(_flagged_only(t))),
    "score_distribution": over_shared(lambda t: reports.score_distribution(_flagged_only(t))),
    "amount_histogram": over_shared(_amount_histogram),
    "flagged_by_region": over_shared(lambda t: reports.flagged_by_region(_flagged(t))),
    "top_flagged": over_shared(lambda t: reports.top_flagged(_flagged(t))),
    # screen tables
    "segment_crosstab": over_clean(lambda t: views.segment_crosstab(_profiles(t))),
    "frequency_amount_points": over_clean(lambda t: views.frequency_amount_points(_profiles(t))),
    "sanction_reason_totals": over_clean(
        lambda t: compliance.sanction_reason_totals(_compliance(t))
    ),
    "compliance_risk_points": over_clean(lambda t: bank_ops.compliance_risk_points(_ranked(t))),
    "region_risk_view": over_clean(_region_risk),
    "high_risk_region_count": over_clean(
        lambda t: features.high_risk_region_count(_region_risk(t))
    ),
    "high_risk_regions_by_threshold": over_clean(_regions_by_threshold),
    "flagged_ranked": q_flagged_ranked,
    "flagged_page": q_flagged_page,
    "sketched_banks": q_sketched_banks,
    "search_flagged": over_shared(_search_flagged),
    "search_customers": over_clean(_search_customers),
    "search_below_threshold_banks": over_clean(_search_below),
    "search_flagged_index": q_search_flagged_index,
    "search_flagged_page": q_search_flagged_page,
    "search_customers_index": q_search_customers_index,
    "search_banks": over_clean(
        lambda t: views.search_banks(_ranked(t), region="EUROPE", sort="risk_rank")
    ),
    "view_flagged": over_shared(lambda t: views.view_flagged(_flagged(t))),
    "view_customers": over_clean(lambda t: views.view_customers(_profiles(t))),
    "view_banks": over_clean(lambda t: views.view_banks(_ranked(t))),
    "view_bank_compliance": over_clean(lambda t: views.view_bank_compliance(_compliance(t))),
    # streams
    "score_stream": q_score_stream,
    "alert_stream": q_alert_stream,
    "region_monitor_stream": q_region_monitor_stream,
    "region_monitor_accounts": q_region_monitor_accounts,
}


def registered() -> dict[str, Query]:
    def shown(query: Query) -> Query:
        return lambda spark, sf_dir: presentable(query(spark, sf_dir))

    return {name: shown(query) for name, query in QUERIES.items()}
