"""Constraint checks. Each returns the offending rows instead of failing a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


REJECT = "reject_reason"


def violation(holds: Column, reason: str) -> Column:
    """The reason when the rule does not hold; NULL when it holds or is unknown."""
    return F.when(~holds, F.lit(reason))


def missing_reasons(cols: list[str]) -> list[Column]:
    return [violation(F.col(c).isNotNull(), f"missing_{c}") for c in cols]


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows lacking a required value; ``reject_reason`` names the first one missing."""
    return _violations(df, F.coalesce(*missing_reasons(cols)))


def check_domain(df: DataFrame, col: str, allowed: list) -> DataFrame:
    """Rows whose value is outside the list; NULL is not a violation."""
    return _violations(df, violation(F.col(col).isin(allowed), f"bad_{col}"))


def check_range(df: DataFrame, col: str, low=None, high=None) -> DataFrame:
    """Rows whose value is below ``low`` or above ``high``; NULL is not a violation."""
    return _violations(df, violation(in_range(col, low, high), f"bad_{col}"))


def in_range(col: str, low=None, high=None) -> Column:
    holds = F.lit(True)
    if low is not None:
        holds = holds & (F.col(col) >= F.lit(low))
    if high is not None:
        holds = holds & (F.col(col) <= F.lit(high))
    return holds


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent; a NULL key has no parent.

    NULL-key rows are set apart before the join: none of them can match, and
    shuffling them would send all to one task.
    """
    keyed = child.where(F.col(key).isNotNull())
    unkeyed = child.where(F.col(key).isNull())
    return keyed.join(parent.select(key), key, "left_anti").select(*child.columns).unionByName(unkeyed)


def _violations(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn(REJECT, reason).where(F.col(REJECT).isNotNull())
