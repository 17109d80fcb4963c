"""Data-quality reports and indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import schemas
from riskspark.functions.scalars import (
    ISO_DATE,
    count_where,
    is_blank,
    literal_row,
    merge_single_rows,
    round_half_up,
    safe_pct,
)
from riskspark.operators.checks import check_unique
from riskspark.operators.cleaning import CleanTables
from riskspark.operators.order_stats import extent_aggregates, iqr_outliers

ISO_DATE_LIKE = "____-__-__"


def null_report(staged: dict[str, DataFrame]) -> DataFrame:
    """Missing values per (table, column): text counts NULL or blank, others NULL.

    One pass per table: all its counts in one aggregate, turned into rows after.
    """

    def missing(df: DataFrame, name: str) -> Column:
        col = F.col(name)
        text = isinstance(df.schema[name].dataType, T.StringType)
        return count_where(is_blank(col) if text else col.isNull()).alias(name)

    reports = []
    for table, cols in schemas.NULL_CHECKED.items():
        df = staged[table]
        counts = df.agg(*[missing(df, c) for c in cols])
        rows = counts.unpivot([], cols, "column_name", "null_count")
        reports.append(rows.select(F.lit(table).alias("table_name"), "column_name", "null_count"))
    return reduce(DataFrame.unionByName, reports)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values on more than one row; NULL counts as one value."""
    return check_unique(df, key)


def duplicate_rows(
    df: DataFrame,
    cols: tuple[str, ...] = ("customer_id", "bank_id", "amount", "date", "location"),
) -> DataFrame:
    """Combinations of business columns on more than one row; reported, not removed."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count > 1")


def dq_sql_kpis(transactions: DataFrame) -> DataFrame:
    """Row completeness and date-format consistency of the clean transactions."""
    complete = reduce(
        lambda a, b: a & b,
        [F.col(c).isNotNull() for c in ("amount", "txn_date", "customer_id", "bank_id")],
    )
    n = F.count(F.lit(1))
    iso = F.col("txn_date").cast("string").like(ISO_DATE_LIKE)
    return transactions.agg(
        n.alias("total_transactions"),
        safe_pct(count_where(complete), n).alias("data_completeness_pct"),
        safe_pct(count_where(iso), n).alias("date_format_consistency_pct"),
    )


def cell_aggregates(df: DataFrame, table: str, date_col: str | None = None) -> list[Column]:
    """Row count, missing cells, cells and (for dated tables) the ISO-date share, as aggregates.

    They can also be observed while the table is written, which saves a scan.
    """
    n = F.count(F.lit(1))
    filled = reduce(lambda a, b: a + b, [F.count(F.col(c)) for c in df.columns])
    cells = n * len(df.columns)
    aggs = [
        n.alias(f"total_{table}"),
        (cells - filled).alias(f"missing_{table}"),
        cells.alias(f"cells_{table}"),
    ]
    if date_col:
        iso = F.col(date_col).cast("string").rlike(ISO_DATE)
        share = F.try_divide(F.lit(100.0) * count_where(iso), n.cast("double"))
        aggs.append(share.alias(f"iso_{table}"))
    return aggs


def orphan_counts(child: DataFrame, parents: dict[str, DataFrame], names: dict[str, str]) -> DataFrame:
    """Number of child rows without a parent, for several keys in one pass over the child.

    Rows are counted per value of each key before the lookup; all keys' values are then
    looked up together. A NULL key has no parent.
    """
    keys = list(parents)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in keys]))
    per_key = child.select(each.alias("k")).groupBy("k.kind", "k.key").agg(F.count(F.lit(1)).alias("n"))
    on_file = reduce(
        DataFrame.unionByName,
        [p.select(F.lit(k).alias("kind"), F.col(k).alias("key")) for k, p in parents.items()],
    )
    lost = per_key.join(on_file, ["kind", "key"], "left_anti")
    return lost.agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(names[k]) for k in keys]
    )


def completeness(row: DataFrame) -> tuple[Column, Column]:
    """data_completeness_pct and data_consistency_pct from the cell aggregates of all tables."""

    def total(prefix: str) -> Column:
        return reduce(lambda a, b: a + b, [F.col(f"{prefix}_{t}") for t in schemas.STAGING])

    missing_share = F.try_divide(total("missing").cast("double"), total("cells").cast("double"))
    return (
        round_half_up(F.lit(100.0) * (F.lit(1.0) - missing_share), 2).alias("data_completeness_pct"),
        round_half_up((F.col("iso_transactions") + F.col("iso_sanctions")) / 2, 2).alias("data_consistency_pct"),
    )


def small_table_cells(clean: CleanTables) -> DataFrame:
    """The cell aggregates of all tables but the transactions, in one row."""
    return merge_single_rows(
        clean.customers.agg(*cell_aggregates(clean.customers, "customers")),
        clean.banks.agg(*cell_aggregates(clean.banks, "banks")),
        clean.sanctions.agg(*cell_aggregates(clean.sanctions, "sanctions", "sanction_date")),
    )


def transaction_aggregates(txns: DataFrame, outlier_column: str = "amount") -> list[Column]:
    """What ``dq_kpis`` counts in a scan of the transactions; can be observed while they are written."""
    extent = zip(("_n", "_least"), extent_aggregates(txns, outlier_column), strict=True)
    return [*cell_aggregates(txns, "transactions", "txn_date"), *[c.alias(n) for n, c in extent]]


def dq_kpis(
    valid_transactions: DataFrame | int, clean: CleanTables, outlier_column: str = "amount", seen: dict | None = None
) -> DataFrame:
    """The ten data-quality indicators in one row.

    Cell completeness covers all four tables. Consistency is the unweighted mean of
    the ISO-date share of transactions and of sanctions. ``valid_transactions`` are
    the rows that passed every rule, or their number; those beyond the one kept per id
    count as duplicates removed.

    The transactions are scanned once for cells, count and extent (unless ``seen`` has what
    ``transaction_aggregates`` counts), once for the orphans, once for the outliers, and
    once per round of the quartile search.
    """
    txns = clean.transactions
    seen = seen or txns.agg(*transaction_aggregates(txns, outlier_column)).first().asDict()
    known = (seen["_n"], seen["_least"])
    cells = literal_row(txns.sparkSession, {k: v for k, v in seen.items() if not k.startswith("_")})

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    row = merge_single_rows(
        small_table_cells(clean),
        cells,
        orphan_counts(
            txns,
            {"bank_id": clean.banks, "customer_id": clean.customers},
            {"bank_id": "orphan_transaction_bank_fk", "customer_id": "orphan_transaction_customer_fk"},
        ),
        counted(iqr_outliers(txns, outlier_column, "linear", known=known), "amount_outliers_iqr"),
        literal_row(txns.sparkSession, {"valid_transactions": valid_transactions})
        if isinstance(valid_transactions, int)
        else counted(valid_transactions, "valid_transactions"),
    )

    return row.select(
        *completeness(row),
        "orphan_transaction_bank_fk",
        "orphan_transaction_customer_fk",
        "amount_outliers_iqr",
        (F.col("valid_transactions") - F.col("total_transactions")).alias(
            "duplicate_transactions_removed"
        ),
        "total_customers",
        "total_banks",
        "total_transactions",
        "total_sanctions",
    )


def feature_coverage(customer_features: DataFrame) -> DataFrame:
    """Share of customers with at least one transaction."""
    return customer_features.agg(
        safe_pct(count_where(F.col("txn_frequency") > 0), F.count(F.lit(1))).alias(
            "feature_coverage_pct"
        )
    )
