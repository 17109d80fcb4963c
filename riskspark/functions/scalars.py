"""Column helpers shared by the operators. All are native Spark expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted spellings of a yes/no flag.
TRUE_WORDS = ["true", "1", "yes", "y", "t"]
FALSE_WORDS = ["false", "0", "no", "n", "f"]
BAD_FLAG = -1

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def round_half_up(col: Column, digits: int) -> Column:
    """Round a double half away from zero on its decimal digits.

    Rounding the binary value directly would turn ties such as 1.005 into 1.00 or
    1.01 depending on the engine, so the value becomes a decimal first.
    """
    return F.round(col.cast("decimal(38,6)"), digits).cast("double")


def round_money(col: Column) -> Column:
    """Round a decimal amount to cents, staying decimal (no overflow of a double)."""
    return F.round(col, 2)


def safe_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """100 * num / den, NULL when den is zero."""
    return round_half_up(F.try_divide(F.lit(100.0) * num, den.cast("double")), digits)


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.trim(col) == "")


def default_if_blank(col: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(default))


def parse_flag(col: Column) -> Column:
    """Yes/no text to 1/0; blank to NULL; any other text to BAD_FLAG. ``1.0`` is 1, ``0.0`` is 0.

    The words come first: trying to read a word as a number costs many times more than to find it.
    """
    word = F.lower(F.trim(col))
    number = word.try_cast("decimal(20,6)")
    return (
        F.when(word.isin(TRUE_WORDS), 1)
        .when(word.isin(FALSE_WORDS), 0)
        .when(word.isNull() | (word == ""), F.lit(None))
        .when(number == 1, 1)
        .when(number == 0, 0)
        .otherwise(BAD_FLAG)
        .cast("int")
    )


def parse_whole(col: Column) -> Column:
    """Text of a whole number to a long, also as ``123.0`` or ``1e3``; anything else is NULL."""
    number = F.trim(col).try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("long"))


def parse_date(col: Column) -> Column:
    """ISO or M/D/YYYY text, or an ISO date with a time, to a date, decided per row; else NULL.

    The cast alone would also take short or trailing forms, so the date must read
    back as the text it came from. (Formatters and patterns cost several times more.)
    """
    text = F.trim(col)
    parts = F.split(text, "/")
    padded = [F.lpad(F.get(parts, k), 2, "0") for k in (0, 1)]
    fits = (F.size(parts) == 3) & (F.length(F.get(parts, 0)) <= 2) & (F.length(F.get(parts, 1)) <= 2)
    timed = (F.length(text) > 10) & text.substr(11, 1).isin(" ", "T") & text.try_cast("timestamp_ntz").isNotNull()
    iso = (
        F.when(fits, F.concat_ws("-", F.get(parts, 2), *padded))
        .when(timed, text.substr(1, 10))
        .otherwise(text)
    )
    date = iso.try_cast("date")
    return F.when(date.cast("string") == iso, date)


def count_where(predicate: Column) -> Column:
    """Number of rows for which the predicate holds (0, never NULL, on empty input)."""
    return F.count(F.when(predicate, 1))


def flag(predicate: Column) -> Column:
    """1 when the predicate holds, otherwise 0 (NULL counts as not holding)."""
    return F.when(predicate, 1).otherwise(0)


def literal_row(spark: SparkSession, values: dict) -> DataFrame:
    """One row of known values; whole numbers as long, NULL as double."""
    return spark.range(1).select(
        *[F.lit(v).cast("long" if isinstance(v, int) else "double").alias(k) for k, v in values.items()]
    )


def merge_single_rows(*frames: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames whose names do not overlap.

    Stacking the frames and keeping the only non-NULL value of each column needs
    neither a cross join nor a collect.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
