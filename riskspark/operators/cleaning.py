"""From raw text rows to typed, deduplicated, reference-checked tables.

A row that breaks a rule is not lost and does not stop the load: it goes to the
quarantine with the first reason that applies.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import schemas
from riskspark.functions.scalars import default_if_blank, parse_date, parse_flag, parse_whole
from riskspark.operators.checks import REJECT, in_range, missing_reasons, violation


class CleanTables(NamedTuple):
    customers: DataFrame
    banks: DataFrame
    transactions: DataFrame
    sanctions: DataFrame


# --------------------------------------------------------------------------- typing


def coerce_types(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Type the columns of a raw table; a value that does not parse becomes NULL.

    Text is trimmed. Columns that already have the wanted type pass through.
    """
    have = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(*[_typed(f, have[f.name]).alias(f.name) for f in schema.fields])


def _typed(field: T.StructField, have: T.DataType) -> Column:
    col = F.col(field.name)
    text = col if isinstance(have, T.StringType) else col.cast("string")
    if isinstance(field.dataType, T.StringType):
        return F.trim(text)
    if have == field.dataType:
        return col
    if field.metadata.get("flag"):
        return parse_flag(text)
    if isinstance(field.dataType, T.DateType):
        return parse_date(text) if isinstance(have, T.StringType) else col.cast("date")
    if isinstance(field.dataType, T.IntegralType):
        return parse_whole(text).cast(field.dataType)
    return F.trim(text).try_cast(field.dataType)


def coerce_sources(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: coerce_types(raw[name], schema) for name, schema in schemas.STAGING.items()}


# ------------------------------------------------------------------------- row rules

Keep = Callable[[DataFrame, str], DataFrame]  # stores a frame under a name, returns it


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


def _row_reason(table: str) -> Column:
    """First broken rule of a staging row, NULL for a good row."""
    rules = missing_reasons(schemas.REQUIRED[table])
    if table == "customers":
        rules.append(violation(F.col("risk_level").isin(schemas.RISK_LEVELS), "bad_risk_level"))
    if table == "banks":
        rules.append(violation(in_range("compliance_score", 0.0, 1.0), "bad_compliance_score"))
    if table == "transactions":
        rules.append(violation(in_range("amount", low=0), "bad_amount"))
        rules.append(violation(F.col("is_high_risk").isin(0, 1), "bad_is_high_risk"))
    if table in ("transactions", "sanctions"):
        rules.append(violation(F.col("is_valid_bank_id").isin(0, 1), "bad_is_valid_bank_id"))
    return F.coalesce(*rules)


def check_parent(staged: DataFrame, table: str) -> DataFrame:
    """The distinct staging rows, each with the reason it is rejected for (``reject_reason``), or NULL."""
    return staged.dropDuplicates().withColumn(REJECT, _row_reason(table))


def check_child(
    staged: DataFrame, table: str, customers: DataFrame, banks: DataFrame
) -> DataFrame:
    """All staging rows, each with the reason it is rejected for (``reject_reason``), or NULL.

    One pass finds broken row rules and keys not on file, so that good rows and
    quarantine can both be read from the result.
    """
    looked_up = _look_up(_look_up(staged, customers, "customer_id"), banks, "bank_id")
    reason = F.coalesce(
        _row_reason(table),
        F.when(F.col("_customer_id_known").isNull(), "unknown_customer_id"),
        F.when(F.col("_bank_id_known").isNull(), "unknown_bank_id"),
    )
    return looked_up.withColumn(REJECT, reason).select(*staged.columns, REJECT)


def _look_up(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Mark the rows whose key is on file.

    Rows without a key would all be shuffled to one task, so each gets a made-up key:
    a hash of the row, which comes out the same when a lost task is run again. Whether
    it meets a parent is irrelevant: such a row is rejected for the missing key before,
    and a parent key is unique, so no row is multiplied. A key that very many rows
    share is split by Spark's skew join, as the rows are on the outer side.
    """
    known = parent.select(F.col(key).alias("_on_file"), F.lit(1).alias(f"_{key}_known"))
    return (
        rows.withColumn("_lookup", F.coalesce(key, F.xxhash64(*rows.columns)))
        .join(known, F.col("_lookup") == F.col("_on_file"), "left")
        .drop("_lookup", "_on_file")
    )


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REJECT).isNull()).drop(REJECT)


def rejected_rows(checked: DataFrame, table: str) -> DataFrame:
    return _quarantined(checked.where(F.col(REJECT).isNotNull()), table, F.col(REJECT))


def _quarantined(rows: DataFrame, table: str, reason: Column) -> DataFrame:
    return rows.select(
        F.lit(table).alias("table_name"),
        F.col(schemas.PRIMARY_KEYS[table]).alias("key"),
        reason.alias("reason"),
        F.to_json(
            F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns if c != REJECT]),
            {"ignoreNullFields": "false"},
        ).alias("row"),
    )


# ---------------------------------------------------------------------------- dedupe


def dedupe(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """One row per key: the first in ``order_by``, NULLs first.

    Spark applies the ``== 1`` limit before the shuffle too (WindowGroupLimit), so
    a key with very many copies leaves each map task as one row.
    """
    first = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def one_per_key(rows: DataFrame, table: str) -> DataFrame:
    key = schemas.PRIMARY_KEYS[table]
    return dedupe(rows, key, [c for c in rows.columns if c != key])


def repeated_rows(rows: DataFrame, table: str, copies: bool = True) -> DataFrame:
    """The rows that lose against another row of their key, as quarantine rows.

    With ``copies`` exact copies of the kept row lose too, otherwise each different row is told
    once. The keys concerned come from one aggregate over hashes of the rows, three numbers a
    row after a partial one in each map task; whole rows move for those keys only, and then
    as an aggregation, so that a key with very many rows is no hot spot.
    """
    key = schemas.PRIMARY_KEYS[table]
    content = F.xxhash64(*rows.columns)
    seen = rows.groupBy(key).agg(F.min(content).alias("_low"), F.max(content).alias("_high"), F.count(F.lit(1)).alias("_rows"))
    lost = (F.col("_rows") > 1) if copies else (F.col("_low") != F.col("_high"))
    keys = seen.where(lost & F.col(key).isNotNull()).select(key)
    concerned = rows.join(keys, key, "left_semi")
    concerned = concerned if copies else concerned.dropDuplicates()
    return _quarantined(concerned.exceptAll(one_per_key(concerned, table)), table, F.lit("duplicate_key"))


def enforce_fk(rows: DataFrame, customers: DataFrame, banks: DataFrame) -> DataFrame:
    """Rows with a customer id, a bank id and (where it exists) an amount, on file."""
    required = [c for c in ("customer_id", "bank_id", "amount") if c in rows.columns]
    return (
        rows.dropna(subset=required)
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .join(banks.select("bank_id"), "bank_id", "left_semi")
        .select(*rows.columns)
    )


# ----------------------------------------------------------------------------- clean


def clean_parent(checked: DataFrame, table: str) -> DataFrame:
    """Good rows, one per key."""
    return one_per_key(good_rows(checked), table)


def fill_transactions(checked: DataFrame) -> DataFrame:
    """Good transactions with defaults filled, before ids are made unique."""
    return good_rows(checked).select(
        "transaction_id",
        "customer_id",
        "bank_id",
        "amount",
        default_if_blank(F.col("currency"), schemas.DEFAULT_CURRENCY).alias("currency"),
        F.col("date").alias("txn_date"),
        "location",
        F.coalesce("is_high_risk", F.lit(schemas.DEFAULT_HIGH_RISK)).alias("is_high_risk"),
        F.coalesce("is_valid_bank_id", F.lit(schemas.DEFAULT_VALID_BANK)).alias("is_valid_bank_id"),
    )


def clean_transactions(checked: DataFrame) -> DataFrame:
    """Good transactions with defaults filled, one per id."""
    return one_per_key(fill_transactions(checked), "transactions")


def fill_sanctions(checked: DataFrame) -> DataFrame:
    """Good sanctions with the default filled, before ids are made unique."""
    valid_bank = F.coalesce("is_valid_bank_id", F.lit(schemas.DEFAULT_VALID_BANK))
    return good_rows(checked).withColumn("is_valid_bank_id", valid_bank)


def clean(
    staged: dict[str, DataFrame], strict: bool = False, keep: Keep = _lazy
) -> tuple[CleanTables, DataFrame]:
    """Clean tables and the quarantine (table_name, key, reason, and the row as JSON).

    Parents come first: children are checked against the cleaned parents. Several
    results share the checked rows and the parents; pass ``keep`` to store those once
    instead of computing them for each (it gets a frame and a name, and returns the
    stored frame). With ``strict`` a non-empty quarantine raises. Exact copies of a
    transaction are dropped, and counted by the quality indicators; of transactions with
    one id but different content one is kept and the others are quarantined.
    """
    checked, parents, rejected = {}, {}, []
    for table in ("customers", "banks"):
        checked[table] = keep(check_parent(staged[table], table), f"checked_{table}")
        parents[table] = keep(clean_parent(checked[table], table), table)
        rejected.append(rejected_rows(checked[table], table))
        rejected.append(repeated_rows(good_rows(checked[table]), table))
    for table in ("transactions", "sanctions"):
        checked[table] = keep(
            check_child(staged[table], table, parents["customers"], parents["banks"]),
            f"checked_{table}",
        )
        rejected.append(rejected_rows(checked[table], table))
    filled = fill_sanctions(checked["sanctions"])
    sanctions = keep(one_per_key(filled, "sanctions"), "sanctions")
    rejected.append(repeated_rows(filled, "sanctions"))
    transactions = keep(clean_transactions(checked["transactions"]), "transactions")
    rejected.append(repeated_rows(fill_transactions(checked["transactions"]), "transactions", copies=False))
    quarantine = reduce(DataFrame.unionByName, rejected)
    if strict and not quarantine.isEmpty():
        raise ValueError(f"rows broke a constraint, e.g. {quarantine.first()}")
    tables = CleanTables(parents["customers"], parents["banks"], transactions, sanctions)
    return tables, quarantine
