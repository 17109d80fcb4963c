"""Small hand-written tables."""

from datetime import date
from decimal import Decimal

from riskspark import schemas
from riskspark.operators.cleaning import CleanTables
from riskspark.sources.readers import text_schema

CUSTOMERS = "customer_id bigint, name string, email string, phone string, region string, risk_level string"
BANKS = "bank_id bigint, name string, region string, compliance_score double"
TXNS = (
    "transaction_id bigint, customer_id bigint, bank_id bigint, amount decimal(18,2), currency string,"
    " txn_date date, location string, is_high_risk int, is_valid_bank_id int"
)
SANCTIONS = (
    "sanction_id bigint, bank_id bigint, customer_id bigint, sanction_date date, reason string,"
    " is_valid_bank_id int"
)
DAY = date(2024, 1, 2)


def customers(spark, *rows):
    """(id, level) or (id, level, region)"""
    return spark.createDataFrame(
        [(r[0], f"C{r[0]}", None, None, r[2] if len(r) > 2 else "North", r[1]) for r in rows], CUSTOMERS
    )


def banks(spark, *rows):
    """(id, score) or (id, score, region)"""
    return spark.createDataFrame(
        [(r[0], f"B{r[0]}", r[2] if len(r) > 2 else "South", float(r[1])) for r in rows], BANKS
    )


def txns(spark, *rows):
    """(id, customer, bank, amount) and optionally high-risk flag and date"""
    full = [
        (r[0], r[1], r[2], Decimal(str(r[3])), "USD", r[5] if len(r) > 5 else DAY, "X", r[4] if len(r) > 4 else 0, 1)
        for r in rows
    ]
    return spark.createDataFrame(full, TXNS)


def sanctions(spark, *rows):
    """(id, bank, customer) and optionally the reason"""
    return spark.createDataFrame(
        [(r[0], r[1], r[2], DAY, r[3] if len(r) > 3 else "Fraud", 1) for r in rows], SANCTIONS
    )


def empty_tables(spark) -> CleanTables:
    return CleanTables(customers(spark), banks(spark), txns(spark), sanctions(spark))


def raw(spark, table, *rows):
    """Rows of text in the column order of the source."""
    return spark.createDataFrame(list(rows), text_schema(table))


def raw_sources(spark, **tables):
    return {t: raw(spark, t, *tables.get(t, [])) for t in schemas.STAGING}


def rows(df, *cols):
    """Sorted tuples of the given columns, or of all."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, v) for v in t))
