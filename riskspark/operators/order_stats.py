"""Exact order statistics of a column of any size, and the quartiles built on them.

A global sort window or an exact percentile aggregate would hold the column (or
all its distinct values) in one task. Here a mergeable quantile sketch proposes a
narrow bracket around the wanted rank, exact counts tell where the rank lies, and
the search goes on strictly inside. Each round shrinks the candidates by a factor
of about a thousand, is one or two scans of one column without a shuffle, and is
exact whatever the sketch says. Many copies of one value do no harm, since the
bracket ends are counted separately and leave the search.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """Looking for the k-th of ``size`` values strictly between ``low`` and ``high``."""

    k: int
    size: int
    base: Any  # a value below or at all candidates
    low: Any = None
    high: Any = None
    answer: Any = None

    @property
    def done(self) -> bool:
        return self.answer is not None

    def inside(self) -> Column:
        cond = F.lit(True)
        if self.low is not None:
            cond = cond & (F.col("v") > F.lit(self.low))
        if self.high is not None:
            cond = cond & (F.col("v") < F.lit(self.high))
        return cond

    def candidate(self) -> Column:
        return F.when(self.inside(), F.col("v"))


def column_values(df: DataFrame, column: str) -> DataFrame:
    """The column alone, as ``v``, without NULL and NaN."""
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    if dict(values.dtypes)["v"] in ("double", "float"):
        values = values.where(~F.isnan("v"))
    return values


def extent_aggregates(df: DataFrame, column: str) -> tuple[Column, Column]:
    """``extent`` as two aggregates, to be taken along in another pass over the frame."""
    value = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    return F.count(value), F.min(value)


def extent(df: DataFrame, column: str) -> tuple[int, Any]:
    """Number of values and the smallest one."""
    return tuple(column_values(df, column).agg(F.count("v"), F.min("v")).first())


def order_statistics(
    df: DataFrame,
    column: str,
    ranks: list[int],
    total: int,
    smallest: Any,
) -> dict[int, Any]:
    """The values at the given 1-based ranks, from the column's ``extent``."""
    values = column_values(df, column)
    searches = {rank: _Search(rank, total, smallest) for rank in set(ranks)}
    while open_ := [s for s in searches.values() if not s.done]:
        _narrow(values, open_)
    return {rank: s.answer for rank, s in searches.items()}


def _limited(values: DataFrame, searches: list[_Search]) -> DataFrame:
    """Only rows some search still considers; simple bounds, so the scan can skip."""
    cond = F.lit(False)
    for s in searches:
        cond = cond | s.inside()
    return values.where(cond)


def _narrow(values: DataFrame, searches: list[_Search]) -> None:
    rows = _limited(values, searches)
    kind = values.schema["v"].dataType
    brackets = rows.agg(
        *[_bracket(s, kind, _asked(s, searches)).alias(str(i)) for i, s in enumerate(searches)]
    ).first()
    counts = rows.agg(
        *[_position(s, b["low"], b["high"]).alias(str(i)) for i, (s, b) in enumerate(zip(searches, brackets))]
    ).first()
    for s, b, c in zip(searches, brackets, counts):
        _step(s, b["low"], b["high"], c)


def _ends(s: _Search) -> tuple[float, float]:
    """The shares of the candidates between which the k-th lies, by what the sketch can tell."""
    target, slack = (s.k - 0.5) / s.size, 2.0 / SKETCH_ACCURACY
    return max(target - slack, 0.0), min(target + slack, 1.0)


def _asked(s: _Search, searches: list[_Search]) -> list[float]:
    """What all searches among the same candidates ask of their one sketch."""
    same = [t for t in searches if (t.low, t.high, t.base) == (s.low, s.high, s.base)]
    return sorted({p for t in same for p in _ends(t)})


def _bracket(s: _Search, kind: T.DataType, asked: list[float]) -> Column:
    """Two values close around the k-th candidate, never outside the candidates.

    The sketch works on doubles. Decimals and integers enter it as the distance from
    a lower bound, so that neighbours stay apart however many digits they have. Searches
    among the same candidates ask the same of it (``asked``), so Spark keeps one for all.
    """
    value, base = s.candidate(), F.lit(s.base)
    exact_double = isinstance(kind, (T.DoubleType, T.FloatType))

    def quantile(p: float) -> Column:
        sketched = value if exact_double else (value - base).cast("double")
        found = F.get(F.percentile_approx(sketched, asked, SKETCH_ACCURACY), asked.index(p))
        return found if exact_double else (base + found.cast(kind)).cast(kind)

    low, high = _ends(s)
    return F.struct(
        F.greatest(quantile(low), F.min(value)).alias("low"),
        F.least(quantile(high), F.max(value)).alias("high"),
    )


def _position(s: _Search, low: Any, high: Any) -> Column:
    value = s.candidate()
    return F.struct(
        F.count(F.when(value < F.lit(low), 1)).alias("below"),
        F.count(F.when(value == F.lit(low), 1)).alias("at_low"),
        F.count(F.when((value > F.lit(low)) & (value < F.lit(high)), 1)).alias("between"),
        F.count(F.when((value == F.lit(high)) & (value > F.lit(low)), 1)).alias("at_high"),
    )


def _step(s: _Search, low: Any, high: Any, n) -> None:
    k = s.k
    if k <= n["below"]:
        s.high, s.size = low, n["below"]
        return
    k -= n["below"]
    if k <= n["at_low"]:
        s.answer = low
        return
    k -= n["at_low"]
    if k <= n["between"]:
        s.low, s.high, s.base, s.k, s.size = low, high, low, k, n["between"]
        return
    k -= n["between"]
    if k <= n["at_high"]:
        s.answer = high
        return
    s.low, s.base, s.k = high, high, k - n["at_high"]
    s.size -= n["below"] + n["at_low"] + n["between"] + n["at_high"]


def quartiles(
    df: DataFrame, column: str, method: str = "ntile", known: tuple[int, Any] | None = None
) -> tuple[Any, Any] | None:
    """(q1, q3), or None when the method has none for so few values.

    ``ntile``: the largest value of the first and the smallest of the last of four
    equal tiles. ``linear``: interpolated between the two nearest ranks.
    """
    n, smallest = known or extent(df, column)
    if method == "ntile":
        if n < 4:
            return None
        first, last = (n + 3) // 4, n - n // 4 + 1
        at = order_statistics(df, column, [first, last], n, smallest)
        return at[first], at[last]
    if method != "linear":
        raise ValueError(f"unknown quartile method: {method}")
    if n == 0:
        return None
    positions = [divmod((n - 1) * q, 4) for q in (1, 3)]
    wanted = [min(i + d, n) for i, _ in positions for d in (1, 2)]
    at = order_statistics(df, column, wanted, n, smallest)
    return tuple(_between(at[i + 1], at[min(i + 2, n)], part) for i, part in positions)


def _between(low: Any, high: Any, quarters: int) -> Any:
    part = Decimal(quarters) / 4 if isinstance(low, Decimal) else quarters / 4
    return low + (high - low) * part


def iqr_outliers(
    df: DataFrame,
    column: str,
    method: str = "ntile",
    k: float = 1.5,
    known: tuple[int, Any] | None = None,
) -> DataFrame:
    """Rows outside q1 - k*IQR .. q3 + k*IQR; ``known`` is the column's extent, if at hand.

    The bounds are literals in the returned plan, so they reach the Parquet scan.
    """
    found = quartiles(df, column, method, known)
    if found is None:
        return df.where(F.lit(False))
    q1, q3 = found
    width = (q3 - q1) * (Decimal(str(k)) if isinstance(q1, Decimal) else k)
    col = F.col(column)
    outside = (col < F.lit(q1 - width)) | (col > F.lit(q3 + width))
    if isinstance(q1, float):
        outside = outside & ~F.isnan(col)
    return df.where(outside)
