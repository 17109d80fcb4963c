"""Column names, types and row rules of the four source tables.

The names, file names and value lists below are fixed values: they are the
interface of the source files.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

FLAG = {"flag": True}  # integer 0/1 read from a yes/no text


def _fields(*specs: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(s[0], s[1], True, s[2] if len(s) > 2 else None) for s in specs]
    )


# Staging types: source column names, typed, every column nullable.
STAGING = {
    "customers": _fields(
        ("customer_id", T.LongType()),
        ("name", T.StringType()),
        ("email", T.StringType()),
        ("phone", T.StringType()),
        ("region", T.StringType()),
        ("risk_level", T.StringType()),
    ),
    "banks": _fields(
        ("bank_id", T.LongType()),
        ("name", T.StringType()),
        ("region", T.StringType()),
        ("compliance_score", T.DoubleType()),
    ),
    "transactions": _fields(
        ("transaction_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("bank_id", T.LongType()),
        ("amount", MONEY),
        ("currency", T.StringType()),
        ("date", T.DateType()),
        ("location", T.StringType()),
        ("is_high_risk", T.IntegerType(), FLAG),
        ("is_valid_bank_id", T.IntegerType(), FLAG),
    ),
    "sanctions": _fields(
        ("sanction_id", T.LongType()),
        ("bank_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("sanction_date", T.DateType()),
        ("reason", T.StringType()),
        ("is_valid_bank_id", T.IntegerType(), FLAG),
    ),
}

SOURCE_FILES = {
    "customers": "customers_.csv",
    "banks": "banks.csv",
    "transactions": "transactions.csv",
    "sanctions": "sanctions.csv",
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "banks": "bank_id",
    "transactions": "transaction_id",
    "sanctions": "sanction_id",
}

# Columns of the missing-value report, in report order.
NULL_CHECKED = {
    "customers": ["customer_id", "name", "email", "phone", "region", "risk_level"],
    "banks": ["bank_id", "name", "region", "compliance_score"],
    "transactions": ["transaction_id", "customer_id", "bank_id", "amount", "date"],
    "sanctions": ["sanction_id", "bank_id", "customer_id", "sanction_date"],
}

REQUIRED = {
    "customers": ["customer_id", "name", "region", "risk_level"],
    "banks": ["bank_id", "name", "region", "compliance_score"],
    "transactions": ["transaction_id", "customer_id", "bank_id", "amount", "date"],
    "sanctions": ["sanction_id", "bank_id", "customer_id", "sanction_date", "reason"],
}

RISK_LEVELS = ["Low", "Medium", "High"]
DEFAULT_CURRENCY = "USD"
DEFAULT_HIGH_RISK = 0
DEFAULT_VALID_BANK = 1

# What an analyst may decide on a flagged transaction.
CONFIRMED, CLEARED, ESCALATED = "Confirmed Fraud", "Cleared", "Escalated"
